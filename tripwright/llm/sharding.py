"""Sharding by a permutation-filled lookup table.

A table of ``size`` slots, a prime, is filled once on the driver: shards take turns, and
at its turn each claims the first free slot of its own preference order (an arithmetic
progression of the slots, whose start and step are hashes of the shard's name). Shares of
slots differ by one at most, and a change of the shard list moves few slots besides those
of the shards that come or go. A row's slot is its key's hash modulo ``size``; the table is
broadcast, so placement is one hash and one look-up per row and no row is shuffled.

The broadcast has ``size`` rows, a parameter that :data:`MAX_SIZE` bounds; it doesn't grow
with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 65_537
MAX_SIZE = 1 << 21
SHARDS = tuple(f"shard-{i:04d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _preference(name: str, size: int) -> tuple[int, int]:
    """Start and step of a shard's preference order."""
    digest = hashlib.md5(name.encode(), usedforsecurity=False).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1


def lookup_table(shards: Sequence[str] = SHARDS, size: int = SIZE) -> list[int]:
    """The index of the owning shard for each slot."""
    if not _is_prime(size) or size > MAX_SIZE:
        raise ValueError(f"the table size must be a prime of at most {MAX_SIZE}")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be named, distinct and no more than slots")
    orders = [_preference(s, size) for s in shards]
    at = [start for start, _ in orders]
    owner = [-1] * size
    left = size
    while left:
        for k, (_, step) in enumerate(orders):
            slot = at[k]
            while owner[slot] >= 0:
                slot = (slot + step) % size
            owner[slot] = k
            at[k] = (slot + step) % size
            left -= 1
            if not left:
                break
    return owner


def slot_of(key: Column, size: int = SIZE) -> Column:
    """60 bits of the key's MD5 modulo ``size``; a null key counts as the empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size).cast("long"))


def assign_shards(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = SIZE) -> DataFrame:
    """``df`` with ``slot`` (long) and ``shard`` (string) added.

    Equal keys go to the same shard; null keys all go to that of the empty string. Columns
    of ``df`` that have these two names already are replaced. An empty table stays empty.
    """
    spark = df.sparkSession
    owners = ",".join(map(str, lookup_table(shards, size)))
    one = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("_slot", "_owner"))
    names = F.array(*[F.lit(s) for s in shards])
    table = one.select(
        F.col("_slot").cast("long").alias("_slot"), F.get(names, F.col("_owner").cast("int")).alias("_shard")
    )
    placed = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), size))
    return placed.join(F.broadcast(table), placed.slot == table._slot).drop("_slot").withColumnRenamed("_shard", "shard")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, files: int = 1) -> None:
    """Writes ``df`` below ``path``, a folder for each shard, each of about ``files`` files.

    Rows of a shard are dealt out by a hash of their key, so that no task writes a whole
    shard where ``files`` is larger.
    """
    placed = assign_shards(df, key, shards)
    salt = F.pmod(F.xxhash64(F.col(key)), F.lit(files))
    placed.repartition(len(shards) * files, "shard", salt).write.partitionBy("shard").mode("overwrite").parquet(path)


def oracle() -> str:
    owners = ",".join(f"{k}" for k in lookup_table())
    return f"""
WITH owners AS (SELECT string_split('{owners}', ',') AS list),
placed AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SIZE} AS slot
           FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(list[slot + 1], 4, '0') AS shard FROM placed, owners"""
