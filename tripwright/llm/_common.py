"""Shared pieces: written tables that cut lineage, text defaults, connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of every operator: runs of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_written: list[tuple[SparkSession, str]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a temporary folder on a local master, whose executor is this machine; on
    a cluster, which must not use one, a folder in the warehouse.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        found = tempfile.mkdtemp(prefix="tripwright-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tripwright"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows that a Python worker holds at once, unless the session says less.
ARROW_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session passes rows to Python in batches that stay small with long texts."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df


#: The driver collects what it no longer needs after so many staged statements, before its heap has grown by them.
RELEASE_EVERY = 4
_statements = count(1)
#: While it is on, Spark drops the shuffle files of a statement at its end.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, **options: int) -> DataFrame:
    """``df`` written to the shared folder and read back: the plan before it is done with.

    Parquet files there outlive any executor, so a lost executor costs its running
    tasks only. The files go at the end of the process, or by :func:`unstage`.
    """
    return stage_all([df], name, **options)


def stage_all(frames: Iterable[DataFrame], name: str, **options: int) -> DataFrame:
    """The union of ``frames`` of one schema, written one after the other to one staged table.

    Nothing reads the shuffle files of a statement after its rows are written, so they go with
    it: the disk holds those of one of ``frames`` at a time.
    """
    path = types = None
    for df in frames:
        spark = df.sparkSession
        if path is None:
            path, types = f"{shared_dir(spark)}/tripwright/{name}-{uuid.uuid4().hex}", df.schema
            if not _written:
                atexit.register(_sweep)
            _written.append((spark, path))
        before = spark.conf.get(_DROP_SHUFFLES, None)
        spark.conf.set(_DROP_SHUFFLES, "true")
        try:
            df.write.mode("append").options(compression="zstd", **options).parquet(path)
        finally:
            spark.conf.set(_DROP_SHUFFLES, before) if before else spark.conf.unset(_DROP_SHUFFLES)
        if next(_statements) % RELEASE_EVERY == 0:
            release(spark)
    out = spark.read.schema(types).parquet(path)
    out._tripwright_path = path
    return out


def unstage(*staged: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    for df in staged:
        path = getattr(df, "_tripwright_path", None)
        if path:
            _delete(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]


def release(spark: SparkSession) -> None:
    """Lets Spark drop what earlier statements left: it removes their shuffle files and broadcasts when the driver collects them."""
    spark._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def _sweep() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001, S110  the session may be gone at exit
            pass


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The smallest node that each node reaches, for undirected ``edges`` (src, dst: long).

    Returns (node, component) for every node of an edge; self-loops and repeated edges are
    allowed. Alternating large-star and small-star rounds: each links neighbours to the
    smallest node around, until the edge set stays as it is. The minimum of a node's
    neighbours is a partial aggregate, and a hub's edges join it by a plain equi-join
    that adaptive execution may split, so a hub does not need one task. Rounds are
    written to the shared folder; of them the driver sees a row count and a checksum only.
    """
    spark = edges.sparkSession

    def both_ways(df: DataFrame) -> DataFrame:
        return df.select("src", "dst").unionByName(
            df.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        )

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("src").agg(F.min("dst").alias("low"))

    def large_star(df: DataFrame) -> DataFrame:
        pairs = both_ways(df)
        low = smallest(pairs).select(F.col("src").alias("hub"), F.least("src", "low").alias("low"))
        return (
            pairs.join(low, pairs.src == low.hub)
            .where("dst > src")
            .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        )

    def small_star(df: DataFrame) -> DataFrame:
        pairs = df.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        low = smallest(pairs).select(F.col("src").alias("hub"), "low")
        moved = pairs.join(low, pairs.src == low.hub)
        return moved.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(
            low.select(F.col("hub").alias("src"), F.col("low").alias("dst"))
        )

    def proper(df: DataFrame) -> DataFrame:
        return df.where("src <> dst").distinct()

    def seal(df: DataFrame) -> tuple[int, object]:
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("s"),
        ).first()
        return row["n"], row["s"]

    now = stage(proper(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))), "edges")
    before = seal(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        grown = stage(proper(small_star(proper(large_star(now)))), "edges")
        unstage(now)
        now, after = grown, seal(grown)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)
