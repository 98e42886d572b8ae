"""Writes: append, CSV exports, the sorted artist roll-up."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from airwave.operators import stats
from airwave.schemas import path_exists

log = logging.getLogger(__name__)


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
         partition_by: list[str] | None = None) -> dict:
    """Write ``df`` to the table at ``path`` (K1) and measure what arrived.

    The rows attempted are observed as they enter the write, the rows saved are
    counted in the table before and after it.  An empty input is reported; an
    append of it changes nothing.  Spark's writer commits per job, so a failed
    write leaves no partial batch behind.
    """
    spark = df.sparkSession
    before = 0 if mode == "overwrite" else _rows(spark, path, fmt)
    obs = Observation("save")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    attempted = int(obs.get["rows"])
    saved = _rows(spark, path, fmt) - before
    if not attempted:
        log.warning("empty DataFrame, nothing to save")
    return {"saved": saved > 0, "total_records": attempted, "saved_records": saved,
            "success_rate": round(100.0 * saved / attempted, 1) if attempted else 0.0}


def _rows(spark: SparkSession, path: str, fmt: str) -> int:
    """Rows of the table at ``path``; 0 if there is none."""
    return spark.read.format(fmt).load(path).count() if path_exists(spark, path) else 0


def save_checked(df: DataFrame, path: str, reason: str = "reason") -> dict:
    """Split write: rows without a ``reason`` are kept, the others quarantined with it (K1).

    One pass writes both, into folders by status; returns the rows of each,
    counted as they are written.
    """
    obs = Observation("checked")
    kept = F.col(reason).isNull()
    counted = df.observe(obs, F.count_if(kept).alias("kept"), F.count_if(~kept).alias("quarantined"))
    counted.withColumn("status", F.when(kept, "kept").otherwise("quarantined")).write.partitionBy("status").parquet(path)
    return {"kept": int(obs.get["kept"]), "quarantined": int(obs.get["quarantined"])}


def read_checked(spark: SparkSession, path: str, schema, status: str) -> DataFrame:
    """The ``kept`` or ``quarantined`` rows of a split write; only that folder is read."""
    stored = StructType([*schema.fields, StructField("status", StringType())])
    return spark.read.schema(stored).parquet(path).where(F.col("status") == status).drop("status")


def export_csv(tables: dict[str, DataFrame], out_dir: str) -> list[str]:
    """Each table to ``out_dir/<name>`` as CSV with a header row (K2)."""
    paths = []
    for name, df in tables.items():
        path = f"{out_dir}/{name}"
        df.write.mode("overwrite").option("header", True).csv(path)
        paths.append(path)
    return paths


def export_rollup(records: DataFrame, out_dir: str) -> str:
    """Distinct-artist roll-up, ordered count desc then name, as CSV.

    The global sort range-partitions the output; part files read in name
    order give the full ordering without funnelling it through one task.
    """
    path = f"{out_dir}/distinct_artists"
    stats.distinct_artist_rollup(records).select("artist_name", "play_count", "artist_clean", "artist_lastfm") \
        .write.mode("overwrite").option("header", True).csv(path)
    return path
