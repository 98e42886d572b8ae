"""Artist and track metadata: parse answers, cache-aside, MERGE, enrich (C4 middle)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave import schemas
from airwave.operators import enrich, merge
from airwave.operators.cache import CacheTable
from airwave.operators.shape import METADATA_COLUMNS, add_empty_columns
from airwave.session import durable
from airwave.sources.responses import (ARTIST_CACHE_COLUMNS, TRACK_CACHE_COLUMNS, parse_artist_responses,
                                       parse_cover_responses, parse_track_responses)

ARTIST_KEY = ["artist_name"]
TRACK_KEY = ["artist_clean", "song_clean"]


@dataclass
class Inputs:
    """What a run reads besides the log: the previous caches and this run's answers."""

    artist_cache: DataFrame | CacheTable
    track_cache: DataFrame | CacheTable
    artist_answers: DataFrame
    track_answers: DataFrame
    covers: DataFrame


def artist_cache_rows(responses: DataFrame, covers: DataFrame) -> DataFrame:
    """Parsed answers reduced to the cache state per artist (S6 + W2)."""
    parsed = parse_artist_responses(responses, parse_cover_responses(covers)).drop("lookup_name")
    return merge.one_per_key(parsed, ARTIST_KEY, "seq").select(*ARTIST_CACHE_COLUMNS)


def track_cache_rows(responses: DataFrame) -> DataFrame:
    """Parsed answers reduced to the cache state per track (S7 + W2)."""
    return merge.one_per_key(parse_track_responses(responses), TRACK_KEY, "seq").select(*TRACK_CACHE_COLUMNS)


def stored_cache(rows: DataFrame, path: str, track: bool = False) -> CacheTable:
    """A bucketed cache table at ``path`` with the given rows; as many buckets as there are shuffle partitions."""
    spark, schema = rows.sparkSession, schemas.TRACK_INFO if track else schemas.ARTIST_IMAGES
    table = CacheTable(spark, path, schema, TRACK_KEY if track else ARTIST_KEY,
                       buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    table.replace(rows.withColumns({c: F.lit(None).cast("timestamp") for c in ("created_at", "updated_at")
                                    if c not in rows.columns}))
    return table


def lookups_of(records: DataFrame) -> DataFrame:
    """Every distinct lookup of the records, written once: keys, misses and answers all start from it."""
    return durable(records.select("raw_artist", "raw_song", "artist_clean", "song_clean").distinct())


def refresh_artist_cache(lookups: DataFrame, cache: DataFrame | CacheTable, answers: DataFrame, covers: DataFrame,
                         action_col: str | None = None) -> DataFrame:
    """Look up every artist: hits stay, misses are fetched and merged.

    A ``CacheTable`` is updated in place, in the buckets of the misses; of a
    plain table the merged rows are returned.
    """
    keys = enrich.lookup_keys(lookups, ["artist_clean"])
    if isinstance(cache, CacheTable):
        _, misses = cache.lookup(keys.withColumnRenamed("artist_clean", "artist_name"))
        misses = misses.withColumnRenamed("artist_name", "artist_clean")
    else:
        misses = enrich.cache_misses(keys, cache, {"artist_clean": "artist_name"})
    updates = artist_cache_rows(answers.join(misses, "artist_clean", "left_semi"), covers)
    if isinstance(cache, CacheTable):
        return cache.upsert(updates, action_col)
    return merge.merge_by_key(cache, updates, ARTIST_KEY, ARTIST_CACHE_COLUMNS[1:], action_col=action_col)


def refresh_track_cache(lookups: DataFrame, cache: DataFrame | CacheTable, answers: DataFrame,
                        action_col: str | None = None) -> DataFrame:
    """Look up every (artist, song) through the track cache."""
    keys = enrich.lookup_keys(lookups, TRACK_KEY)
    if isinstance(cache, CacheTable):
        _, misses = cache.lookup(keys)
    else:
        misses = enrich.cache_misses(keys, cache, {"artist_clean": "artist_clean", "song_clean": "song_clean"})
    updates = track_cache_rows(answers.join(misses, TRACK_KEY, "left_semi"))
    if isinstance(cache, CacheTable):
        return cache.upsert(updates, action_col)
    return merge.merge_by_key(cache, updates, TRACK_KEY, TRACK_CACHE_COLUMNS[2:], action_col=action_col)


def empty_records(records: DataFrame) -> DataFrame:
    """Plays without the seeded metadata: the records as first written (P5)."""
    return add_empty_columns(records.drop(*[c for c in METADATA_COLUMNS if c in records.columns]), METADATA_COLUMNS)
