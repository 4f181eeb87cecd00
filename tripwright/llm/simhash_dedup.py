"""SimHash near-duplicates of documents, found by multi-index hashing.

Every document has a 64-bit SimHash of its word shingles. Two fingerprints link at a
Hamming distance of at most ``max_bits`` (3). The fingerprint is cut into two 32-bit
segments: of two linked fingerprints, one segment differs by at most one bit. So each
fingerprint stores its two segments in a table and looks up, by segment, the Hamming ball
of radius one around its own; matches are verified by their complete distance.

Only distinct fingerprints take part, so a group of copies of any size is one row, and a
fingerprint has at most 43,744 possible partners, whatever the number of documents. Of two
segments that differ by one bit, one has a 0 there: only flips from 0 to 1 are looked up,
which finds every pair once and halves the lookups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm._common import connected_components, schema, small_batches, stage, text_or_empty

SEGMENTS = 2
SEGMENT_BITS = 32
#: Shingles are hashed and counted in slices of this many, so one text of any length is bounded.
SLICE = 1 << 15

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of one text as an unsigned integer; 0 where it has no word."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    ends -= 1
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]).tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        part = [hashed(joined[a:b], 42) for a, b in zip(first[at : at + SLICE], last[at : at + SLICE], strict=True)]
        packed = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(packed, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp: signed 64-bit SimHash) for each row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, schema("doc_id long, fp long"))


def _segment(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT_BITS * k).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (src, dst) of distinct fingerprints at most ``max_bits`` (3 or fewer) apart.

    Every such pair is found; one may come more than once, by either segment.
    """
    if not 0 <= max_bits < 2 * SEGMENTS:
        raise ValueError("two segments with balls of radius one find up to 3 differing bits")
    fp = F.col("fp")
    segments = [F.struct(F.lit(k).alias("k"), _segment(fp, k).alias("seg")) for k in range(SEGMENTS)]
    table = fps.select("fp", F.explode(F.array(*segments)).alias("s")).select(
        F.col("s.k").alias("k"), F.col("s.seg").alias("seg"), F.col("fp").alias("dst")
    )
    bit = lambda i: F.lit(1).cast("long") * F.expr(f"shiftleft(1L, {i})")
    ball = F.array(F.lit(0).cast("long"), *[bit(i) for i in range(SEGMENT_BITS)])
    probes = (
        table.select("k", "seg", F.col("dst").alias("src"), F.explode(ball).alias("flip"))
        .where(F.col("seg").bitwiseAND(F.col("flip")) == 0)
        .select("k", F.col("seg").bitwiseOR(F.col("flip")).alias("seg"), "src", "flip")
    )
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits
    once = (F.col("flip") != 0) | (F.col("src") < F.col("dst"))
    return probes.join(table, ["k", "seg"]).where(near & once & (F.col("src") != F.col("dst"))).select("src", "dst")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest id that it reaches).

    Edge cases: null or empty texts have fingerprint 0 and link like any other; repeated
    rows keep a row each; a null id is never a representative unless all of a group are
    null, which gives a null component; an empty table gives no row. Other columns of
    ``docs`` are not read.
    """
    prints = stage(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    found = connected_components(links(classes, max_bits))
    # the fingerprint that names a component is arbitrary; the id is the smallest of all its classes
    members = classes.join(found, classes.fp == found.node, "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")
    )
    lowest = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = members.join(lowest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group left: the one whose id names the component.

    Of rows that repeat that id, the one of the smallest hash of its text stays. Columns and
    their order are those of ``docs``; a group of null ids only leaves one row of them.
    """
    groups = near_duplicates(docs, id_col, text_col)
    none = F.lit(-(1 << 63)).cast("long")  # stands for a null id, so that the join has a plain key
    key = F.coalesce(F.col(id_col).cast("long"), none)
    keep = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.coalesce("doc_id", none).alias("_key")).distinct()
    kept = docs.withColumn("_key", key).join(keep, "_key", "left_semi")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(text_or_empty(text_col))))
    return kept.withColumn("_nth", nth).where("_nth = 1").select(*docs.columns)
