"""A cache table in buckets of a key hash, with a MERGE that touches only its own buckets.

The rows lie in folders ``bucket=<n>``, ``n`` a hash of the keys.  Readers that
know their keys read only those buckets (partition pruning), and an upsert
merges and rewrites only the buckets that its updates fall into (dynamic
partition overwrite); the rest of the table is neither read nor written.

Beside the rows lie Bloom filters, one a bucket and size: ``HASHES`` bits for
each key in pages of 32,768 bits, built with Spark's bitmap aggregates.  A key
with a bit missing is certainly not in the cache, so a lookup sends only the
others through the join.  Filters are rewritten with their buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from airwave.operators import merge
from airwave.operators.dictionary import broadcast_if_small
from airwave.schemas import path_exists
from airwave.session import durable, release

HASHES = 3
BITS = 32_768


class CacheTable:
    """The cache at ``path``: rows of ``schema``, unique by ``keys``.  Keys may be NULL; NULL is a key like any other."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int = 64,
                 pages: int = 1):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys
        self.buckets, self.pages = buckets, pages

    def bucket(self, keys: list[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def bits(self, keys: list[str]) -> Column:
        """The key's bit numbers, one for each hash."""
        return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda h: F.pmod(
            F.xxhash64(F.lit(41) + h, *keys), F.lit(BITS * self.pages)))

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or only some of its buckets, without the bucket column."""
        if not path_exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], self.schema)
        stored = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        read = self.spark.read.schema(stored).parquet(f"{self.path}/rows")
        return (read if buckets is None else read.where(F.col("bucket").isin(buckets))).select(*self.schema.names)

    def touched(self, keyed: DataFrame) -> list[int]:
        """Buckets in which the keys of a table fall: at most ``buckets`` numbers."""
        return sorted(r[0] for r in keyed.select(self.bucket(self.keys)).distinct().collect())

    def replace(self, rows: DataFrame) -> None:
        """Write the buckets of ``rows`` anew, whole, with their filters; other buckets stay."""
        placed = rows.select(*self.schema.names).withColumn("bucket", self.bucket(self.keys))
        self._overwrite(placed.repartition("bucket"), "rows")
        bit = placed.select("bucket", F.explode(self.bits(self.keys)).alias("bit"))
        filters = bit.groupBy("bucket", (F.col("bit") / BITS).cast("int").alias("page")).agg(
            F.bitmap_construct_agg(F.pmod("bit", F.lit(BITS))).alias("bitmap"))
        self._overwrite(filters.repartition("bucket"), "filters")

    def _overwrite(self, df: DataFrame, part: str) -> None:
        df.write.option("partitionOverwriteMode", "dynamic").partitionBy("bucket").mode("overwrite").parquet(
            f"{self.path}/{part}")

    def upsert(self, updates: DataFrame, action_col: str | None = None) -> DataFrame:
        """MERGE ``updates``, one row a key, into the table, rewriting only the buckets they fall into.

        Returns the table afterwards, with what happened to each row if
        ``action_col`` is given (updated, inserted or kept).
        """
        values = [c for c in self.schema.names if c not in [*self.keys, "created_at", "updated_at"]]
        given = durable(updates.select(*self.keys, *values))
        buckets = self.touched(given)
        merged = durable(merge.merge_by_key(self.rows(buckets), given, self.keys, values, action_col=action_col))
        if buckets:
            self.replace(merged)
        release(given)
        others = self.rows([b for b in range(self.buckets) if b not in set(buckets)])
        if action_col:
            others = others.withColumn(action_col, F.lit("kept"))
        return merged.select(*others.columns).unionByName(others)

    def maybe(self, keyed: DataFrame) -> DataFrame:
        """``keyed`` (with the table's key columns) and ``maybe``: false if a key is certainly not in the table."""
        if not path_exists(self.spark, f"{self.path}/filters"):
            return keyed.withColumn("maybe", F.lit(False))
        read = self.spark.read.schema("page int, bitmap binary, bucket int").parquet(f"{self.path}/filters")
        pages = read.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("page", "bitmap"))).alias("pages"))
        small, _ = broadcast_if_small(pages.withColumnRenamed("bucket", "of"))

        def held(bit: Column) -> Column:
            page = F.element_at("pages", (bit / BITS).cast("int"))
            byte = F.conv(F.hex(F.substring(page, (F.pmod(bit, F.lit(BITS)) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.coalesce(F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(1) == 1,
                              F.lit(False))

        probed = keyed.join(small, self.bucket(self.keys) == F.col("of"), "left")
        return probed.withColumn("maybe", F.forall(self.bits(self.keys), held)).drop("of", "pages")

    def lookup(self, keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(hits, misses): keys with a successful row, and the others (J3).  Only keys that may be there are joined."""
        probed = durable(self.maybe(keyed.select(*self.keys)))
        likely = probed.where("maybe").drop("maybe")
        found = self.rows(self.touched(likely)).where("fetch_success")
        hits = likely.join(found, self.keys)
        misses = probed.where("NOT maybe").drop("maybe").unionByName(likely.join(found, self.keys, "left_anti"))
        return hits, misses
