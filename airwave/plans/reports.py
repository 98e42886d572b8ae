"""Exploration and statistics reports.

``exploration_report`` and ``statistics_report`` are long tables (section,
rank, item, metric, value).  All their counts over the records come from one
aggregate over grouping sets, so the records are scanned once: the sets are the
whole table, the callsign, the raw artist and the artist's spellings.  That
aggregate combines map-side; its result, a row for each distinct value, is
written once, and lists and totals are taken from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.functions.text import display_name, status_label
from airwave.operators import stats
from airwave.session import durable
from airwave.sources.tables import describe, list_tables

LONG = ["section", "rank", "item", "metric", "value"]


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Temp views so ad-hoc SQL runs over the tables (C7); use ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def explore(spark: SparkSession, records: DataFrame, artist_cache: DataFrame, sample: int = 10) -> dict:
    """Catalog, layouts, counts, samples, distinct raw artists, per-callsign and fetch status."""
    return {
        "tables": list_tables(spark),
        "records_columns": describe(spark, records),
        "artist_cache_columns": describe(spark, artist_cache),
        "records_count": records.agg(stats.F.count(stats.F.lit(1)).alias("total_records")),
        "records_sample": stats.first_rows(records, sample, ["unique_id"] if "unique_id" in records.columns else records.columns[:1]),
        "artist_cache": artist_cache,
        "distinct_raw_artists": stats.distinct_raw_artists(records),
        "records_per_callsign": stats.records_per_callsign(records),
        "fetch_status": stats.fetch_status(artist_cache),
    }


def statistics(records: DataFrame, artist_cache: DataFrame, track_cache: DataFrame) -> dict:
    """Summary, duration counts, samples, top listening time, bottom artists, top artists."""
    return {
        "summary": stats.database_stats(records, artist_cache, track_cache),
        "duration_counts": stats.duration_counts(records, track_cache),
        "cached_artists_sample": stats.artist_cache_preview(artist_cache, 5),
        "tracks_sample": stats.track_sample(track_cache),
        "top_listening_time": stats.top_listening_time(records),
        "bottom_artists": stats.bottom_artists(records),
        "top_artists": stats.top_artists(records),
    }


def counted_once(records: DataFrame) -> DataFrame:
    """Counts of the records over all grouping sets of the reports, written once; ``of`` names the set of a row."""
    timed = (F.col("track_duration") > 0) & F.col("artist_clean").isNotNull()
    sets = [["all"], ["callsign"], ["raw_artist"], ["artist_clean", "artist_lastfm"]]
    columns = ["callsign", "raw_artist", "artist_clean", "artist_lastfm"]
    source = records.select(*columns, "time_unix", "track_duration")
    grouped = source.groupingSets([[F.col(c) for c in s if c != "all"] for s in sets], *columns).agg(
        F.grouping_id(*columns).alias("absent"), F.count(F.lit(1)).alias("records"),
        F.count("time_unix").alias("records_with_timestamps"), F.count("track_duration").alias("records_with_duration"),
        F.coalesce(F.sum(F.when(timed, F.col("track_duration"))), F.lit(0)).cast("long").alias("seconds"),
        F.count_if(timed).alias("timed"))
    of = F.when(F.col("absent") == 15, "all").when(F.col("absent") == 7, "callsign").when(
        F.col("absent") == 11, "raw_artist").otherwise("spelling")
    return durable(grouped.withColumn("of", of).drop("absent"))


def long_rows(df: DataFrame, section: str, item: Column | None, metrics: list[str], rank: Column | None = None) -> DataFrame:
    """One row for each metric of each row of ``df``."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value")) for m in metrics]))
    return df.select(F.lit(section).alias("section"), (F.lit(None) if rank is None else rank).cast("int").alias("rank"),
                     (F.lit(None) if item is None else item).cast("string").alias("item"), values.alias("m")).select(
        "section", "rank", "item", "m.*")


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).select(*LONG)


def exploration_report(records: DataFrame, artist_cache: DataFrame) -> DataFrame:
    """Records, distinct raw artists, records per callsign, and cache rows per fetch outcome."""
    counts = counted_once(records)
    raw = counts.where("of = 'raw_artist'").agg(F.count(F.lit(1)).alias("distinct_raw_artists"))
    status = artist_cache.groupBy(status_label(F.col("fetch_success")).alias("status")).agg(
        F.count(F.lit(1)).alias("entries"))
    return _together([
        long_rows(counts.where("of = 'all'"), "summary", None, ["records"]),
        long_rows(raw, "summary", None, ["distinct_raw_artists"]),
        long_rows(counts.where("of = 'callsign'"), "callsign", F.col("callsign"), ["records"]),
        long_rows(status, "fetch_status", F.col("status"), ["entries"])])


def statistics_report(records: DataFrame, artist_cache: DataFrame, track_cache: DataFrame, n: int = 10) -> DataFrame:
    """Summary and duration counts, top listening time, most and least played artists."""
    counts = counted_once(records)
    spelt = counts.where("of = 'spelling' AND artist_clean IS NOT NULL")
    shown = spelt.groupBy(display_name(F.col("artist_lastfm"), F.col("artist_clean")).alias("name")).agg(
        F.sum("seconds").alias("seconds"), F.sum("timed").alias("timed"), F.sum("records").alias("plays"))
    clean = spelt.groupBy(F.col("artist_clean").alias("name")).agg(F.sum("records").alias("plays"))
    listened = stats.numbered(shown.where("timed > 0"), [F.desc("seconds"), F.asc("name")], n)
    fewest = stats.numbered(shown, [F.asc("plays"), F.asc("name")], n)
    most = stats.numbered(clean, [F.desc("plays"), F.asc("name")], n)
    artists = artist_cache.agg(F.count(F.lit(1)).alias("cached_artists"), F.count_if("fetch_success").alias("successful_images"))
    tracks = track_cache.agg(F.count(F.lit(1)).alias("cached_tracks"), F.count("duration").alias("tracks_with_duration"))
    name, rank = F.col("name"), F.col("rank")
    return _together([
        long_rows(counts.where("of = 'all'"), "summary", None,
                  ["records", "records_with_timestamps", "records_with_duration"]),
        long_rows(artists, "summary", None, ["cached_artists", "successful_images"]),
        long_rows(tracks, "summary", None, ["cached_tracks", "tracks_with_duration"]),
        long_rows(listened, "top_listening_time", name, ["seconds", "timed"], rank),
        long_rows(fewest, "bottom_artists", name, ["plays"], rank),
        long_rows(most, "top_artists", name, ["plays"], rank)])
