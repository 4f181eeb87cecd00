"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased runs of letters and digits. A seed is the hash of the words that a
mask's ones select from a window; its zeros are positions that may differ. Documents whose
seeds meet seeds of a benchmark item are verified around the hit: on the hit's alignment,
some run of ``window`` item words (the whole item if it is shorter) must agree with the
document in ``min_match`` of its words, so substituted words are tolerated. One of the
masks has a hit in every window of 13 words with up to two substitutions, as
``min_match`` 0.8 allows, wherever they are. Items of lengths for which the masks promise
no hit have seeds of runs instead, as long as the longest run that the substitutions allowed
must leave whole: an item of one to four words is such a run itself, so it is found if it is
there word for word. Documents are searched for the run lengths that the benchmark needs.

Neither side is collected: documents are thinned by a Bloom filter of the benchmark's seeds
whose size is fixed (``BLOOM_BITS``, 1 MB, so it may be sent to every task; a benchmark too
large for it only thins less), and what passes joins the seeds by value, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm._common import schema, small_batches, stage, text_or_empty

#: Positions that a mask reads, from its window's first word.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 6, 7), (0, 1, 4, 6, 7))
WINDOW = 13
MIN_MATCH = 0.8
#: Item length to run length, for items that MASKS may miss: with 0, 1 or 2 words substituted a run of so many stays whole.
RUNS = {1: 1, 2: 2, 3: 3, 4: 4, 5: 2, 6: 3, 7: 3, 10: 3, 11: 3}
#: Word hashes that a worker keeps at hand.
KNOWN_WORDS = 1 << 17
BLOOM_BITS = 1 << 23
#: A document is hashed in slices of so many words.
SLICE = 1 << 16

_MIX = np.uint64(0x9E3779B97F4A7C15)
_known: dict[str, int] = {}


def _words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+", text.lower())


def _word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word; frequent words are kept at hand."""
    import xxhash

    get, out = _known.get, []
    for w in words:
        h = get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            if len(_known) < KNOWN_WORDS:
                _known[w] = h
        out.append(h)
    return np.array(out, np.uint64)


def seed_hashes(hashes: np.ndarray, mask: int) -> np.ndarray:
    """The seed at each start of ``mask``'s window (a negative one is a run's length); empty if there are too few words."""
    offsets = MASKS[mask] if mask >= 0 else range(-mask)
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, mask + 1 if mask >= 0 else 1 << 32 | -mask, np.uint64)
    for o in offsets:
        out = (out ^ hashes[o : o + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _bloom_places(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(BLOOM_BITS - 1)
    return (seeds & low).astype(np.int64), ((seeds >> np.uint64(32)) & low).astype(np.int64)


def best_window(doc: list[str], item: list[str], shift: int, window: int = WINDOW) -> tuple[int, int, int]:
    """(matches, length, first document word) of the best run on alignment ``shift``.

    Item word k faces document word k + shift; words beyond the document don't match.
    """
    n = min(window, len(item))
    same = np.array([0 <= k + shift < len(doc) and doc[k + shift] == w for k, w in enumerate(item)], np.int64)
    total = np.concatenate([[0], np.cumsum(same)])
    runs = total[n:] - total[:-n]
    at = int(np.argmax(runs))
    return int(runs[at]), n, at + shift


def _test_seeds(benchmark: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seeds, at, runs = [], [], [], []
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                hashes = _word_hashes(_words(text.as_py()))
                for mask in [-RUNS[len(hashes)]] if len(hashes) in RUNS else range(len(MASKS)):
                    found = seed_hashes(hashes, mask)
                    ids += [item.as_py()] * len(found)
                    seeds += found.view(np.int64).tolist()
                    at += range(len(found))
                    runs += [max(0, -mask)] * len(found)
            columns = [pa.array(ids, pa.int64()), pa.array(seeds, pa.int64()), pa.array(at, pa.int32()), pa.array(runs, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["item_key", "seed", "item_at", "run"])

    return benchmark.mapInArrow(run, schema("item_key long, seed long, item_at int, run int")).distinct()


def _bloom(seeds: DataFrame) -> np.ndarray:
    """The filter's bits; Spark sets them, the driver gets BLOOM_BITS / 64 words at most."""
    low = F.lit(BLOOM_BITS - 1).cast("long")
    places = F.array(F.col("seed").bitwiseAND(low), F.shiftrightunsigned("seed", 32).bitwiseAND(low))
    bits = seeds.select(F.explode(places).alias("p")).select(
        F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p & 63L AS INT))").alias("bit")
    )
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    for word, bit in bits.groupBy("word").agg(F.bit_or("bit")).collect():
        out[word] = bit
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _regions(docs: DataFrame, bloom: np.ndarray, reach: int, runs: list[int]) -> DataFrame:
    """Stretches of documents around seeds that pass the filter, ``reach`` words to each side."""
    masks = [*range(len(MASKS)), *(-n for n in runs)]
    packed = np.packbits(bloom, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                words = _words(text.as_py())
                at, seeds = [], []
                for begin in range(0, max(1, len(words)), SLICE):
                    hashes = _word_hashes(words[begin : begin + SLICE + 8])
                    for mask in masks:
                        found = seed_hashes(hashes, mask)[:SLICE]
                        one, two = _bloom_places(found)
                        hit = np.nonzero(bits[one] & bits[two])[0]
                        at.append(hit + begin)
                        seeds.append(found[hit])
                place, seed = np.concatenate(at), np.concatenate(seeds)
                if not len(place):
                    continue
                order = np.argsort(place, kind="stable")
                place, seed = place[order], seed[order]
                for part in np.split(np.arange(len(place)), np.nonzero(np.diff(place) > 2 * reach)[0] + 1):
                    first = max(0, int(place[part[0]]) - reach)
                    out[0].append(doc.as_py())
                    out[1].append(first)
                    out[2].append(" ".join(words[first : int(place[part[-1]]) + reach + 1]))
                    out[3].append(seed[part].view(np.int64).tolist())
                    out[4].append((place[part] - first).tolist())
            types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "first", "words", "seeds", "places"])

    return small_batches(docs).mapInArrow(run, schema("doc_id long, first long, words string, seeds array<long>, places array<long>"))


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_match: float = MIN_MATCH) -> DataFrame:
    """(doc_id, item_id, doc_word, matched, compared): each document with each item in it.

    The row tells the best window: its first word in the document, how many words were
    compared and how many agreed. Items of one to four words count if they are there whole, items
    without a word never; null texts are empty; equal item texts are searched once and reported for each
    id; a null id is reported as null; rows that repeat an id give one row per item.
    """
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
    items = stage(texts.withColumn("item_key", F.xxhash64("text")), "items")
    unique = items.groupBy("item_key", "text").count().select("item_key", "text")
    seeds = stage(_test_seeds(unique), "seeds")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    runs = sorted(r["run"] for r in seeds.select("run").distinct().collect() if r["run"])  # four lengths at most
    seeds = seeds.drop("run")
    regions = stage(
        _regions(rows, _bloom(seeds), max(window, 1 + max(m[-1] for m in MASKS)) + window, runs).withColumn(
            "region", F.xxhash64("doc_id", "first", "words")
        ),
        "regions",
    )
    hits = (
        regions.select("region", F.explode(F.arrays_zip("seeds", "places")).alias("hit"))
        .select("region", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("place"))
        .join(seeds, "seed")
        .select("region", "item_key", (F.col("place") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    aligned = (
        hits.join(regions.select("region", "doc_id", "first", "words").dropDuplicates(["region"]), "region")
        .join(unique, "item_key")
        .select("doc_id", "item_key", "first", "shift", "words", "text")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, item, first, shift, words, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                matched, compared, at = best_window(words.split(" "), _words(text), shift, window)
                if matched >= min_match * compared - 1e-9:
                    for column, value in zip(out, (doc, item, first + at, matched, compared), strict=True):
                        column.append(value)
            types = (pa.int64(),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "item_key", "doc_word", "matched", "compared"])

    found = aligned.mapInArrow(verify, schema("doc_id long, item_key long, doc_word long, matched long, compared long"))
    best = found.groupBy("doc_id", "item_key").agg(
        F.max(F.struct("matched", (-F.col("doc_word")).alias("before"), "compared")).alias("b")
    )
    return best.join(items.select("item_key", "item_id").distinct(), "item_key").select(
        "doc_id", "item_id", (-F.col("b.before")).alias("doc_word"), F.col("b.matched").alias("matched"), F.col("b.compared").alias("compared")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark passage; columns as they are."""
    leaks = overlaps(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, F.col("doc_id").cast("long").eqNullSafe(F.col("_leak")), "left_anti")
