"""Quality rules: plain text rules, then an n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed n-grams of UTF-8 bytes: that of trusted
target documents (labelled quality 1 and not toxic) and that of the whole corpus. A
document's score is the mean over its n-grams of log(p_target / p_corpus); it is kept if
the base rules pass and the score reaches the threshold. The corpus counts cover every
document; target counts and the threshold cover every labelled one. Labels meet documents by
a join, and the threshold is found by sums over ranges of scores, so the driver sees bucket
counts and a row for each range only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm._common import schema, small_batches, stage, text_or_empty, unstage

NGRAM = 4
BUCKET_BITS = 16
#: Added to the count of each bucket of either multinomial.
SMOOTHING = 0.5
#: Of labelled good documents that pass the base rules, the share that the threshold may reject.
MAX_LOSS = 0.01
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Long texts are hashed in slices of so many bytes.
SLICE = 1 << 18

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_SPACES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)


def ngram_buckets(raw: bytes) -> Iterator[np.ndarray]:
    """The buckets of all byte n-grams, slice by slice; a shorter text is one n-gram."""
    if not raw:
        return
    raw = raw.ljust(NGRAM, b"\0")
    for at in range(0, len(raw) - NGRAM + 1, SLICE):
        part = np.frombuffer(raw[at : at + SLICE + NGRAM - 1], np.uint8).astype(np.uint32)
        key = part[: len(part) - NGRAM + 1].copy()
        for k in range(1, NGRAM):
            key = (key << np.uint32(8)) | part[k : len(part) - NGRAM + 1 + k]
        yield (key * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)


def base_stats(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    bytes_at = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeat = 0
    if len(words) > 3:
        ids: dict[bytes, int] = {}
        seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
        base = len(ids)
        key = seq[:-2] * base + seq[1:-1]
        if base > 2_000_000:  # else the product of three fits in 63 bits
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * base + seq[2:]
        order = np.sort(key)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            window = np.isin(key, np.unique(twice))
            covered = np.zeros(len(words), bool)
            for k in range(3):
                covered[k : k + len(window)] |= window
            repeat = int(covered.sum())
    return (
        len(words),
        len(text) - int(bytes_at[_SPACES].sum()),
        int(bytes_at[_SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeat,
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


@dataclass(frozen=True)
class Model:
    """log(p_target / p_corpus) by bucket, and the score that a kept document reaches."""

    ratios: np.ndarray
    threshold: float = float("-inf")

    def score(self, text: str) -> float:
        """The mean ratio over the text's n-grams, rounded to 9 digits; 0 where it has none."""
        total, n = 0.0, 0
        for buckets in ngram_buckets(text.encode("utf-8", "surrogatepass")):
            total += float(self.ratios[buckets].sum())
            n += len(buckets)
        return round(total / n, 9) if n else 0.0


def ratios_of(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    t, c = target + SMOOTHING, corpus + SMOOTHING
    return np.log(t / t.sum()) - np.log(c / c.sum())


def choose_threshold(scores: np.ndarray, good: np.ndarray, max_loss: float = MAX_LOSS) -> float:
    """The score that best separates good from bad, keeping all but ``max_loss`` of the good.

    Candidates are midpoints between neighbouring scores; of equal sums of rates the lowest
    wins. Without both kinds nothing is rejected.
    """
    if not good.any() or good.all():
        return float("-inf")
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    lost, caught = np.cumsum(g) / g.sum(), np.cumsum(~g) / (~g).sum()
    gain = np.where((lost <= max_loss) & (np.append(s[1:] > s[:-1], True)), caught - lost, -1.0)
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return float("-inf")
    return float((s[best] + s[min(best + 1, len(s) - 1)]) / 2)


def threshold_of(scored: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """:func:`choose_threshold` of any number of rows (score, good): running sums by ranges of scores."""
    n = lambda kind: F.sum(F.when(kind, 1).otherwise(0))
    sums = scored.groupBy("score").agg(n(F.col("good")).alias("good"), n(~F.col("good")).alias("bad"))
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stage(sums.repartitionByRange(parts, "score").withColumn("range", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("range").agg(F.min("score").alias("low"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    totals.sort(key=lambda r: r["low"])
    all_good, all_bad = sum(r["good"] for r in totals), sum(r["bad"] for r in totals)
    if not all_good or not all_bad:
        unstage(ranges)
        return float("-inf")
    before, good, bad = [], 0, 0
    for k, r in enumerate(totals):
        before.append((r["range"], good, bad, totals[k + 1]["low"] if k + 1 < len(totals) else None))
        good, bad = good + r["good"], bad + r["bad"]
    starts = scored.sparkSession.createDataFrame(before, "range int, good_before long, bad_before long, next_low double")
    in_order = Window.partitionBy("range").orderBy("score")
    lost = (F.sum("good").over(in_order) + F.col("good_before")) / F.lit(float(all_good))
    caught = (F.sum("bad").over(in_order) + F.col("bad_before")) / F.lit(float(all_bad))
    above = F.coalesce(F.lead("score").over(in_order), "next_low", "score")
    cuts = ranges.join(F.broadcast(starts), "range").select("score", lost.alias("lost"), caught.alias("caught"), above.alias("above"))
    best = cuts.where((F.col("lost") <= max_loss) & (F.col("caught") > F.col("lost"))).agg(
        F.max(F.struct((F.col("caught") - F.col("lost")).alias("gain"), (-F.col("score")).alias("at"), "above")).alias("cut")
    ).first()["cut"]
    unstage(ranges)
    return float("-inf") if best is None else float((best["above"] - best["at"]) / 2)


def _counts(texts: DataFrame) -> np.ndarray:
    """The n-grams of ``text`` by bucket: tasks count their rows, buckets are summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for buckets in ngram_buckets(text.as_py().encode("utf-8", "surrogatepass")):
                    found += np.bincount(buckets, minlength=1 << BUCKET_BITS)
        at = np.nonzero(found)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["bucket", "n"])

    rows = small_batches(texts).select("text").mapInArrow(run, schema("bucket long, n long"))
    out = np.zeros(1 << BUCKET_BITS)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # 65,536 rows at most
        out[bucket] = n
    return out


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of every labelled id.

    An id labelled twice counts as good only if all its rows are; null labels are left out.
    """
    rows = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"),
        (F.col("quality") == 0).alias("bad"),
    ).where("doc_id is not null and (good or bad)")
    return rows.groupBy("doc_id").agg(F.every("good").alias("good"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The ratios over all documents, and the threshold from all labelled ones."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # a table of labels on each task, which needs no sort of the texts; the same plan at any size
    held = stage(rows.join(labelled(labels).hint("shuffle_hash"), "doc_id").select("text", "doc_id", "good"), "labelled")
    model = Model(ratios_of(_counts(held.where("good")), _counts(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(0)]
            stats = [base_stats(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([model.score(t) for t in texts]), pa.array([base_failed(s[0], s[4]) for s in stats])],
                names=["doc_id", "good", "score", "failed"],
            )

    passed = small_batches(held).mapInArrow(run, schema("doc_id long, good boolean, score double, failed boolean")).where("not failed")
    # rows that repeat an id count once, by the lowest score
    threshold = threshold_of(passed.groupBy("doc_id", "good").agg(F.min("score").alias("score")))
    unstage(held)
    return Model(model.ratios, threshold)


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """A row of :data:`RESULT` for each document, in one pass without a shuffle.

    A null or empty text has no words, so the base rules reject it; repeated rows are
    judged alike; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            stats = np.array([base_stats(t) for t in texts], np.int64).reshape(-1, 5)
            failed = (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT_PERCENT * stats[:, 0])
            scores = np.array([model.score(t) for t in texts], float)
            columns = [batch.column(0), *(pa.array(stats[:, k]) for k in range(5)), pa.array(failed), pa.array(scores), pa.array(~failed & (scores >= model.threshold))]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in RESULT.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return small_batches(rows).mapInArrow(run, schema(RESULT))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the rules reject; columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            good = []
            for t in texts:
                s = base_stats(t)
                good.append(not base_failed(s[0], s[4]) and model.score(t) >= model.threshold)
            yield batch.filter(pa.array(good, pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)
