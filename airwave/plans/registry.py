"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or plans Spark derives from them)
whole; limits appear only where a top-k or sample is the feature.  Building a
query that needs a dictionary, a cache or the name graph runs those jobs;
only clean columns that a query reads are computed.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.operators import enrich, merge, normalize, shape, stats
from airwave.operators.cluster import fuzzy_map
from airwave.operators.fuzzy import similar_pairs
from airwave.plans import metadata, pipeline, reports, sinks
from airwave.session import checkpoint_dir, durable
from airwave.sources import derived, tables
from airwave.sources.responses import parse_artist_responses, parse_cover_responses, parse_track_responses

REGISTRY: dict = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def top_listening_time(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_listening_time(derived.plays(spark, sf, "artist_clean"))


@register
def bottom_artists(spark: SparkSession, sf: str) -> DataFrame:
    return stats.bottom_artists(derived.plays(spark, sf, "artist_clean"))


@register
def top_artists(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_artists(derived.plays(spark, sf, "artist_clean"))


@register
def artist_play_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.artist_play_counts(derived.plays(spark, sf, "artist_clean"))


@register
def distinct_artist_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_artist_rollup(derived.plays(spark, sf, "artist_clean"))


@register
def records_per_callsign(spark: SparkSession, sf: str) -> DataFrame:
    return stats.records_per_callsign(derived.raw_plays(spark, sf))


@register
def distinct_raw_artists(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_raw_artists(derived.raw_plays(spark, sf))


@register
def parse_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return stats.parse_coverage(derived.plays(spark, sf, "time_unix"))


@register
def clean_artists(spark: SparkSession, sf: str) -> DataFrame:
    return derived.plays(spark, sf, "artist_clean").select("raw_artist", "artist_clean").distinct()


@register
def clean_songs(spark: SparkSession, sf: str) -> DataFrame:
    return derived.plays(spark, sf, "song_clean").select("raw_song", "song_clean").distinct()


@register
def parse_time(spark: SparkSession, sf: str) -> DataFrame:
    return derived.plays(spark, sf, "time_unix").select("raw_time", "time_unix").distinct()


@register
def like_filter(spark: SparkSession, sf: str) -> DataFrame:
    return stats.like_filter(derived.plays(spark, sf, "artist_clean"), "raw_artist", "%ring%").select(
        "play_key", "raw_artist", "artist_clean")


@register
def shape_columns(spark: SparkSession, sf: str) -> DataFrame:
    return shape.to_records(derived.raw_log(spark, sf))


@register
def clean_plays(spark: SparkSession, sf: str) -> DataFrame:
    return derived.plays(spark, sf).select("play_key", "artist_clean", "song_clean", "time_unix")


@register
def distinct_raw_artist_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_count(derived.raw_plays(spark, sf), "raw_artist")


@register
def append_union(spark: SparkSession, sf: str) -> DataFrame:
    plays = derived.raw_plays(spark, sf)
    return merge.append(plays.where("first_play").select("play_key", "raw_artist", "raw_song"),
                        plays.where("NOT first_play").select("play_key", "raw_artist", "callsign"))


# ------------------------------------------------------- files
def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/export-{uuid.uuid4().hex}"


@register
def log_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The log written as a ``;`` file with a header and read back."""
    folder = _scratch(spark)
    derived.raw_log(spark, sf).write.options(sep=";", header=True, ignoreLeadingWhiteSpace=False,
                                             ignoreTrailingWhiteSpace=False).csv(folder)
    return tables.read_play_log(spark, folder)


@register
def log_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """A log with broken lines read, split into kept and quarantined rows, and both read back."""
    lines, out = _scratch(spark), _scratch(spark)
    derived.log_lines(spark, sf).write.text(lines)
    checked = tables.read_checked_log(spark, lines, header=False)
    sinks.save_checked(checked, out)
    return sinks.read_checked(spark, out, checked.schema, "kept").withColumn("status", F.lit("kept")).unionByName(
        sinks.read_checked(spark, out, checked.schema, "quarantined").withColumn("status", F.lit("quarantined")))


@register
def export_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A table exported as CSV with a header and read back (K2)."""
    plays = derived.raw_plays(spark, sf).select("play_key", "callsign", "raw_time", "track_duration")
    (path,) = sinks.export_csv({"plays": plays}, _scratch(spark))
    return spark.read.schema(plays.schema).option("header", True).csv(path)


@register
def rollup_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The sorted roll-up exported as CSV and read back (K3; tests check the order of the files)."""
    path = sinks.export_rollup(derived.plays(spark, sf, "artist_clean"), _scratch(spark))
    return spark.read.option("header", True).schema(
        "artist_name string, play_count long, artist_clean string, artist_lastfm string").csv(path)


@register
def save_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Rows attempted and saved when the plays are appended twice."""
    plays, path = derived.raw_plays(spark, sf).select("play_key", "raw_artist"), _scratch(spark)
    rows = [(k, r["total_records"], r["saved_records"], r["success_rate"])
            for k, r in enumerate((sinks.save(plays, path), sinks.save(plays, path)), 1)]
    return spark.createDataFrame(rows, "run int, total_records long, saved_records long, success_rate double")


# ------------------------------------------------------------ metadata (C4)
CACHE_VALUES = ["artist_name", "artist_lastfm", "image_url", "mbid", "fetch_success", "error_message"]
TRACK_VALUES = ["artist_clean", "song_clean", "artist_lastfm", "song_lastfm", "duration", "track_mbid",
                "fetch_success", "error_message"]


LOOKUP_COLUMNS = ["raw_artist", "raw_song", "artist_clean", "song_clean"]


class Caches:
    """The derived inputs of a run, each made once and only when asked for."""

    def __init__(self, spark: SparkSession, sf: str, records: DataFrame | None = None):
        self.spark, self.sf, self.records = spark, sf, records

    @cached_property
    def covers(self) -> DataFrame:
        return derived.cover_responses(self.spark, self.sf)

    @cached_property
    def previous_artists(self) -> DataFrame:
        return durable(metadata.artist_cache_rows(derived.previous_artist_responses(self.spark, self.sf), self.covers))

    @cached_property
    def previous_tracks(self) -> DataFrame:
        return durable(metadata.track_cache_rows(derived.previous_track_responses(self.spark, self.sf)))

    @cached_property
    def artist_lookups(self) -> DataFrame:
        if self.records is None:
            plays = derived.plays(self.spark, self.sf, "artist_clean")
        else:
            # Every artist lookup stands in the lookups too, which are fewer rows and already written.
            plays = self.lookups if "song_clean" in self.records.columns else self.records
        return durable(plays.select("raw_artist", "artist_clean").distinct())

    @cached_property
    def lookups(self) -> DataFrame:
        return metadata.lookups_of(self.records if self.records is not None else derived.plays(
            self.spark, self.sf, "artist_clean", "song_clean"))

    def artists(self, action_col: str | None = None) -> DataFrame:
        return metadata.refresh_artist_cache(self.artist_lookups, self.previous_artists,
                                             derived.artist_responses(self.artist_lookups), self.covers, action_col)

    def tracks(self, action_col: str | None = None) -> DataFrame:
        return metadata.refresh_track_cache(self.lookups, self.previous_tracks,
                                            derived.track_responses(self.lookups), action_col)

    def inputs(self, lookups: DataFrame) -> metadata.Inputs:
        return metadata.Inputs(self.previous_artists, self.previous_tracks, derived.artist_responses(lookups),
                               derived.track_responses(lookups), self.covers)


@register
def cover_response_parse(spark: SparkSession, sf: str) -> DataFrame:
    return parse_cover_responses(derived.cover_responses(spark, sf))


@register
def artist_response_parse(spark: SparkSession, sf: str) -> DataFrame:
    made = Caches(spark, sf)
    return parse_artist_responses(derived.artist_responses(made.artist_lookups), parse_cover_responses(made.covers))


@register
def track_response_parse(spark: SparkSession, sf: str) -> DataFrame:
    return parse_track_responses(derived.track_responses(Caches(spark, sf).lookups))


@register
def cache_hits(spark: SparkSession, sf: str) -> DataFrame:
    made = Caches(spark, sf)
    keys = enrich.lookup_keys(made.artist_lookups, ["artist_clean"]).withColumnRenamed("artist_clean", "artist_name")
    hits, _ = metadata.stored_cache(made.previous_artists, _scratch(spark)).lookup(keys)
    return hits.withColumnRenamed("artist_name", "artist_clean").select(
        "artist_clean", "artist_lastfm", "image_url", "mbid", "fetch_success", "error_message")


@register
def cache_misses(spark: SparkSession, sf: str) -> DataFrame:
    made = Caches(spark, sf)
    keys = enrich.lookup_keys(made.artist_lookups, ["artist_clean"]).withColumnRenamed("artist_clean", "artist_name")
    _, misses = metadata.stored_cache(made.previous_artists, _scratch(spark)).lookup(keys)
    return misses.withColumnRenamed("artist_name", "artist_clean")


@register
def merge_artist_cache(spark: SparkSession, sf: str) -> DataFrame:
    made = Caches(spark, sf)
    stored = metadata.stored_cache(made.previous_artists, _scratch(spark))
    return metadata.refresh_artist_cache(made.artist_lookups, stored, derived.artist_responses(made.artist_lookups),
                                         made.covers, "action").select(*CACHE_VALUES, "action")


@register
def merge_track_cache(spark: SparkSession, sf: str) -> DataFrame:
    made = Caches(spark, sf)
    stored = metadata.stored_cache(made.previous_tracks, _scratch(spark), track=True)
    return metadata.refresh_track_cache(made.lookups, stored, derived.track_responses(made.lookups), "action").select(
        *TRACK_VALUES, "action")


@register
def enrich_artists(spark: SparkSession, sf: str) -> DataFrame:
    records = derived.plays(spark, sf, "artist_clean")
    out = enrich.enrich_artists(metadata.empty_records(records), Caches(spark, sf, records).artists())
    return out.select("play_key", "artist_clean", "artist_lastfm", "artist_image_url", "artist_mbid")


@register
def enrich_tracks(spark: SparkSession, sf: str) -> DataFrame:
    records = durable(derived.plays(spark, sf, "artist_clean", "song_clean").select("play_key", *LOOKUP_COLUMNS))
    made = Caches(spark, sf, records)
    out = enrich.enrich_artists(metadata.empty_records(records), made.artists())
    return enrich.enrich_tracks(out, made.tracks()).select(
        "play_key", "artist_clean", "song_clean", "artist_lastfm", "song_lastfm", "track_duration", "track_mbid")


@register
def fetch_status(spark: SparkSession, sf: str) -> DataFrame:
    return stats.fetch_status(Caches(spark, sf).artists())


@register
def summary_stats(spark: SparkSession, sf: str) -> DataFrame:
    made = Caches(spark, sf, derived.plays(spark, sf, "artist_clean", "song_clean"))
    return stats.database_stats(derived.plays(spark, sf, "time_unix"),
                                made.artists(), made.tracks()).drop("timestamp")


@register
def duration_counts(spark: SparkSession, sf: str) -> DataFrame:
    records = derived.plays(spark, sf, "artist_clean", "song_clean")
    return stats.duration_counts(records.withColumn("time_unix", F.lit(None).cast("bigint")),
                                 Caches(spark, sf, records).tracks())


@register
def previews(spark: SparkSession, sf: str) -> DataFrame:
    return stats.artist_cache_preview(Caches(spark, sf).artists())


@register
def cache_preview(spark: SparkSession, sf: str) -> DataFrame:
    return stats.artist_cache_preview(Caches(spark, sf).artists(), 5)


@register
def first_records(spark: SparkSession, sf: str) -> DataFrame:
    plays = derived.plays(spark, sf, "artist_clean").select("play_key", "raw_artist", "artist_clean", "callsign", "raw_time")
    return stats.first_rows(plays, 10, ["play_key"])


@register
def exploration_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.exploration_report(derived.plays(spark, sf, "artist_clean", "time_unix"), Caches(spark, sf).artists())


@register
def statistics_report(spark: SparkSession, sf: str) -> DataFrame:
    records = durable(derived.plays(spark, sf).select(*LOOKUP_COLUMNS, "callsign", "artist_lastfm", "time_unix", "track_duration"))
    made = Caches(spark, sf, records)
    return reports.statistics_report(records, made.artists(), made.tracks())


@register
def random_sample(spark: SparkSession, sf: str) -> DataFrame:
    return stats.track_sample(Caches(spark, sf).tracks())


# ------------------------------------------------------- name normalisation

def _artists(spark: SparkSession, sf: str):
    return normalize.artist_counts(derived.plays(spark, sf, "artist_clean"))


@register
def the_prefix_map(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.the_prefix_map(_artists(spark, sf))


@register
def remaining_after_the(spark: SparkSession, sf: str) -> DataFrame:
    artists = durable(_artists(spark, sf))
    return normalize.remaining_after(artists, normalize.the_prefix_map(artists))


@register
def fuzzy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    names = _artists(spark, sf).select(F.lower("name").alias("name")).distinct()
    return similar_pairs(names, 90.0).select("a", "b", "lcs")


@register
def fuzzy_clusters(spark: SparkSession, sf: str) -> DataFrame:
    artists = durable(_artists(spark, sf))
    _, matches = fuzzy_map(normalize.remaining_after(artists, normalize.the_prefix_map(artists)), 90.0)
    return matches


@register
def normalize_map(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalize_artists(derived.plays(spark, sf, "artist_clean"), 90.0).mapping


@register
def normalized_plays(spark: SparkSession, sf: str) -> DataFrame:
    out = normalize.normalize_artists(derived.plays(spark, sf, "artist_clean"), 90.0).records
    return out.groupBy("artist_clean").agg(F.count(F.lit(1)).alias("play_count"),
                                           F.count_if(F.col("renamed")).alias("renamed_plays"))


@register
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.threshold_sweep(derived.plays(spark, sf, "artist_clean"))


# ------------------------------------------------------------- whole job

@register
def pipeline_records(spark: SparkSession, sf: str) -> DataFrame:
    out = pipeline.run(derived.raw_log(spark, sf), Caches(spark, sf).inputs).records
    return out.select("unique_id", "artist_clean", "song_clean", "time_unix", "artist_lastfm",
                      "song_lastfm", "track_duration", "artist_image_url")
