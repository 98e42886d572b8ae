"""Sharding by a Feistel permutation with cycle walking, in DataFrame functions only.

Rows get global numbers 0..N-1 in the order of (id, size, checksum): the rows
are range-partitioned and sorted, each partition's count is taken, and a row's
number is its partition's offset plus its place there.  Only the key columns
move, never the texts.

The number is then permuted.  The domain is a x b, the smallest near-square
product that holds N; a balanced pair of halves (left < a, right < b) goes
through keyed Feistel rounds, and a result of N or more walks on along its
cycle until it falls below N.  At most a - 1 numbers lie outside, so almost
every row needs no walk; walking goes on until no row is outside.

The permuted place p gives shard = p mod shards and slot = p div shards: shard
sizes differ by at most one (law ``rows``), slots have no gaps, and anyone who
knows N, the key and a row's number can compute both.

Defined results: a null text has size 1 and checksum 0; null ids come first;
equal rows get adjacent numbers, so the result is the same multiset on every
run; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import drop_stage, stage

ROUNDS = 6
WALKS = 3


def feistel(x: Column, a: int, b: int, key: int, rounds: int = ROUNDS) -> Column:
    """Permutation of 0..a*b-1: alternate halves each take the keyed hash of the other, modulo their size."""
    halves = F.struct(((x - F.pmod(x, F.lit(b))) / F.lit(b)).cast("long").alias("left"),
                      F.pmod(x, F.lit(b)).alias("right"))

    def one(acc: Column, k: Column) -> Column:
        left, right = acc["left"], acc["right"]
        new_left = F.pmod(left + F.pmod(F.xxhash64(right, k, F.lit(key)), F.lit(a)), F.lit(a))
        new_right = F.pmod(right + F.pmod(F.xxhash64(left, k, F.lit(key)), F.lit(b)), F.lit(b))
        even = k % 2 == 0
        return F.struct(F.when(even, new_left).otherwise(left).alias("left"),
                        F.when(even, right).otherwise(new_right).alias("right"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), halves, one,
                       lambda acc: acc["left"] * F.lit(b) + acc["right"])


def numbered(df: DataFrame, order: list[str], number: str = "row_number") -> tuple[DataFrame, int]:
    """Add global numbers 0..N-1 in the given order; returns the numbered rows and N.

    The partition counts (one row for each partition) are summed on a window
    and joined back by broadcast: their number is bounded by the number of
    partitions, not by the rows.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = stage(df.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")))
    counts = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    firsts = df.sparkSession.createDataFrame(offsets, "_part int, _first long")
    out = placed.join(F.broadcast(firsts), "_part").withColumn(
        number, F.col("_first") + F.col("_place")).drop("_part", "_place", "_first")
    return out, total


def permuted(df: DataFrame, number: str, total: int, key: int = 42, place: str = "place") -> DataFrame:
    """Add the permuted place (0..total-1) of each row's number."""
    a = max(1, math.isqrt(max(0, total - 1)) + 1)
    b = max(1, -(-total // a))

    def walk(x: Column) -> Column:
        return F.when(x >= total, feistel(x, a, b, key)).otherwise(x)

    out = df.withColumn(place, feistel(F.col(number), a, b, key))
    if a * b == total or not total:
        return out
    for _ in range(WALKS):
        out = out.withColumn(place, walk(F.col(place)))
    out = stage(out)
    while out.where(F.col(place) >= total).take(1):
        after = stage(out.withColumn(place, walk(F.col(place))))
        drop_stage(out)
        out = after
    return out


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8,
          key: int = 42) -> DataFrame:
    """Deal all rows into ``shards`` shards of equal counts.

    Returns (doc_id, size long, text_crc32 long, law string, shard int, slot
    long, grown_shard int, row_number long).
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    counted, total = numbered(rows, ["doc_id", "size", "text_crc32"])
    return permuted(counted, "row_number", total, key).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        ((F.col("place") - F.pmod("place", F.lit(shards))) / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
