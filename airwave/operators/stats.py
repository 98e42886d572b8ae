"""Counts, roll-ups, top/bottom lists and samples over the records table.

Aggregations over the plays are partial + final hash aggregates of counts and
sums (map-side combine), so a hot artist or callsign never lands whole in one
task; ``min`` of names, which Spark can only sort for, runs on the small result
of such an aggregate.  Top/bottom lists are ``orderBy(...).limit(n)`` which
Spark plans as TakeOrderedAndProject (per-partition top-n, no full sort); ranks
are numbered after the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airwave.functions.text import (bucketed_duration, display_name, export_display_name, mmss,
                                    preview, status_label)


def numbered(df: DataFrame, order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Top ``n`` rows in ``order`` with a 1-based rank (T1, T2, W1); the rank window sees ``n`` rows."""
    return df.orderBy(*order).limit(n).withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def _spellings(df: DataFrame, name: Column, *sums: Column) -> DataFrame:
    """Counts and sums per (name, artist_clean, artist_lastfm): the hash aggregate over the plays."""
    return df.groupBy(name.alias("name"), "artist_clean", "artist_lastfm").agg(
        F.count(F.lit(1)).alias("play_count"), *sums)


def listening_time(records: DataFrame) -> DataFrame:
    """Per display artist: plays, average and total seconds, formatted."""
    df = records.where(F.col("track_duration").isNotNull() & (F.col("track_duration") > 0)
                       & F.col("artist_clean").isNotNull())
    per_spelling = _spellings(df, display_name(F.col("artist_lastfm"), F.col("artist_clean")),
                              F.sum("track_duration").cast("bigint").alias("seconds"))
    g = per_spelling.groupBy(F.col("name").alias("display_name")).agg(
        F.min("artist_clean").alias("artist_clean"),
        F.min("artist_lastfm").alias("artist_lastfm"),
        F.sum("play_count").alias("play_count"),
        F.sum("seconds").alias("total_listening_seconds"),
    ).withColumn("avg_duration_seconds", F.col("total_listening_seconds").cast("double") / F.col("play_count"))
    return g.withColumns({
        "total_listening_time": bucketed_duration(F.col("total_listening_seconds")),
        "avg_duration": mmss(F.col("avg_duration_seconds")),
    })


def top_listening_time(records: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` artists by total listening time, ranked."""
    return numbered(listening_time(records),
                    [F.desc("total_listening_seconds"), F.asc("display_name")], n)


def plays_by_display(records: DataFrame) -> DataFrame:
    """Plays per display artist (A8 body)."""
    named = records.where(F.col("artist_clean").isNotNull())
    return _spellings(named, display_name(F.col("artist_lastfm"), F.col("artist_clean"))).groupBy(
        F.col("name").alias("display_name")).agg(
        F.min("artist_clean").alias("artist_clean"),
        F.min("artist_lastfm").alias("artist_lastfm"),
        F.sum("play_count").alias("play_count"))


def bottom_artists(records: DataFrame, n: int = 10) -> DataFrame:
    """Fewest plays per display artist, ranked."""
    return numbered(plays_by_display(records), [F.asc("play_count"), F.asc("display_name")], n)


def artist_play_counts(records: DataFrame, drop_blank: bool = True) -> DataFrame:
    """Plays per clean artist (A4); ``drop_blank=False`` keeps '' (A14 body)."""
    df = records.where(F.col("artist_clean").isNotNull())
    if drop_blank:
        df = df.where(F.col("artist_clean") != "")
    return df.groupBy("artist_clean").agg(F.count(F.lit(1)).alias("play_count"))


def top_artists(records: DataFrame, n: int = 10) -> DataFrame:
    """Most played clean artists, ranked."""
    return numbered(artist_play_counts(records, drop_blank=False),
                    [F.desc("play_count"), F.asc("artist_clean")], n)


def distinct_artist_rollup(records: DataFrame) -> DataFrame:
    """Distinct display artists with plays, ordered count desc, name asc."""
    df = records.where(F.col("artist_clean").isNotNull() & (F.col("artist_clean") != "")
                       & (F.trim(F.col("artist_clean")) != ""))
    per_spelling = _spellings(df, export_display_name(F.col("artist_lastfm"), F.col("artist_clean")))
    g = per_spelling.groupBy(F.col("name").alias("artist_name")).agg(
        F.sum("play_count").alias("play_count"),
        F.min("artist_clean").alias("artist_clean"),
        F.min("artist_lastfm").alias("artist_lastfm"))
    return g.orderBy(F.desc("play_count"), F.asc("artist_name"))


def records_per_callsign(records: DataFrame) -> DataFrame:
    """Records per callsign, NULL callsign kept as a group (A5)."""
    return records.groupBy("callsign").agg(F.count(F.lit(1)).alias("record_count")).orderBy(
        F.desc("record_count"), F.asc_nulls_first("callsign"))


def fetch_status(cache: DataFrame) -> DataFrame:
    """Cache rows per fetch outcome, labelled."""
    return cache.groupBy(status_label(F.col("fetch_success")).alias("status")).agg(
        F.count(F.lit(1)).alias("entries"))


def distinct_raw_artists(records: DataFrame) -> DataFrame:
    """Distinct raw artist values; NULL counts as one value."""
    return records.select("raw_artist").distinct()


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """One row: the number of distinct values, NULL being one (A10)."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("distinct_count"))


def parse_coverage(records: DataFrame) -> DataFrame:
    """Parsed vs total time values."""
    return records.agg(F.count("time_unix").alias("parsed_count"), F.count(F.lit(1)).alias("total_count"))


def _tagged(records: DataFrame, artist_cache: DataFrame, track_cache: DataFrame) -> DataFrame:
    """The three tables as one tagged stream of the columns the counts need."""
    null_b = F.lit(None).cast("boolean")
    return (records.select(F.lit("r").alias("src"), F.col("time_unix").isNotNull().alias("flag"),
                           F.col("track_duration").isNotNull().alias("has_duration"))
            .unionByName(artist_cache.select(F.lit("a").alias("src"), F.col("fetch_success").alias("flag"),
                                             null_b.alias("has_duration")))
            .unionByName(track_cache.select(F.lit("t").alias("src"), null_b.alias("flag"),
                                            F.col("duration").isNotNull().alias("has_duration"))))


def database_stats(records: DataFrame, artist_cache: DataFrame, track_cache: DataFrame) -> DataFrame:
    """One summary row: records, with time, cached artists, successes, cached tracks (A2, A1).

    One aggregate over a tagged union of the three tables: a single pass,
    no join.
    """
    src, flag = F.col("src"), F.col("flag")
    return _tagged(records, artist_cache, track_cache).agg(
        F.count_if(src == "r").alias("music_records_count"),
        F.count_if((src == "r") & flag).alias("records_with_timestamps"),
        F.count_if(src == "a").alias("cached_artists"),
        F.count_if((src == "a") & flag).alias("successful_images"),
        F.count_if(src == "t").alias("cached_tracks"),
    ).withColumn("timestamp", F.current_timestamp())


def duration_counts(records: DataFrame, track_cache: DataFrame) -> DataFrame:
    """Non-NULL durations in the track cache and in the records (A3)."""
    src, has = F.col("src"), F.col("has_duration")
    empty_cache = track_cache.sparkSession.createDataFrame([], "fetch_success boolean")
    return _tagged(records, empty_cache, track_cache).agg(
        F.count_if((src == "t") & has).alias("tracks_with_duration"),
        F.count_if((src == "r") & has).alias("records_with_duration"))


def artist_cache_preview(cache: DataFrame, n: int | None = None) -> DataFrame:
    """Cached artists with status label and a 50-character URL preview."""
    df = cache.select("artist_name", status_label(F.col("fetch_success")).alias("status"),
                      preview(F.col("image_url"), 50).alias("image_preview"))
    return first_rows(df, n, ["artist_name"]) if n is not None else df


def track_sample(track_cache: DataFrame, n: int = 5, seed: int = 7) -> DataFrame:
    """Random ``n`` tracks with a positive duration.

    The order is a hash of key and seed, so the same seed gives the same sample
    however the table is partitioned; with the limit it plans as a
    per-partition top-n, not a full sort.
    """
    df = track_cache.where(F.col("duration") > 0).select(
        "artist_clean", "song_clean", "duration",
        preview(F.col("track_mbid"), 8).alias("mbid_preview"),
        mmss(F.col("duration")).alias("duration_text"))
    drawn = F.md5(F.concat_ws("|", F.col("artist_clean"), F.col("song_clean"), F.lit(str(seed))))
    return df.orderBy(drawn, "artist_clean", "song_clean").limit(n)


def like_filter(records: DataFrame, column: str, pattern: str) -> DataFrame:
    """Case-insensitive ``LIKE`` filter."""
    return records.where(F.col(column).ilike(pattern))


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in the order of some columns (T3): a per-partition top-n, not a full sort."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(n)


def squares(df: DataFrame, column: str) -> DataFrame:
    """Element-wise square of a numeric column (F21, the original's smoke test)."""
    return df.select((F.col(column) * F.col(column)).alias(f"{column}_squared"))
