"""Cache-aside lookups and enrichment joins.

The metadata tables have one row per artist / track, so they are joined to
the plays as dimensions: broadcast when their measured size allows it,
otherwise a shuffle join with AQE splitting any hot artist's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.functions.text import py_strip, truthy, truthy_number
from airwave.operators.dictionary import broadcast_if_small
from airwave.session import durable


def lookup_keys(records: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct non-blank lookup keys of the records (D1; blank keys are never looked up).

    Every key is looked up; the original's testing cap (T6) is not built.
    """
    df = records.select(*keys).distinct()
    for k in keys:
        df = df.where(F.col(k).isNotNull() & (py_strip(F.col(k)) != ""))
    return df


def cache_hits(keys: DataFrame, cache: DataFrame, key_map: dict[str, str]) -> DataFrame:
    """Keys with a successful cache row, with the cached values."""
    ok = cache.where(F.col("fetch_success"))
    cond = [keys[k] == ok[c] for k, c in key_map.items()]
    return keys.join(ok, cond, "inner").drop(*[c for k, c in key_map.items() if c != k])


def cache_misses(keys: DataFrame, cache: DataFrame, key_map: dict[str, str]) -> DataFrame:
    """Keys without a successful cache row -- to be fetched (J3).  Failures retry."""
    ok = cache.where(F.col("fetch_success"))
    cond = [keys[k] == ok[c] for k, c in key_map.items()]
    return keys.join(ok, cond, "left_anti")


def _dimension(df: DataFrame) -> DataFrame:
    """Write a per-key table once and broadcast it if its measured size allows."""
    dim, _ = broadcast_if_small(durable(df))
    return dim


def enrich_artists(records: DataFrame, artist_cache: DataFrame) -> DataFrame:
    """Fold artist metadata into the plays by artist_clean.

    artist_lastfm is set only when the looked-up value is non-empty; image
    URL and MBID are filled too (successful images only, truthy MBIDs).
    """
    dim = _dimension(artist_cache.select(
        F.col("artist_name").alias("__a_key"),
        F.col("artist_lastfm").alias("__a_lastfm"),
        F.when(F.col("fetch_success"), F.col("image_url")).alias("__a_image"),
        F.col("mbid").alias("__a_mbid")))
    j = records.join(dim, records["artist_clean"] == dim["__a_key"], "left")
    return j.withColumns({
        "artist_lastfm": F.when(truthy(F.col("__a_lastfm")), F.col("__a_lastfm")).otherwise(F.col("artist_lastfm")),
        "artist_image_url": F.coalesce(F.col("__a_image"), F.col("artist_image_url")),
        "artist_mbid": F.when(truthy(F.col("__a_mbid")), F.col("__a_mbid")).otherwise(F.col("artist_mbid")),
    }).drop("__a_key", "__a_lastfm", "__a_image", "__a_mbid")


def enrich_tracks(records: DataFrame, track_cache: DataFrame) -> DataFrame:
    """Fold track metadata into the plays by (artist_clean, song_clean).

    Only successful lookups apply; each field only when truthy (0 and ''
    are ignored).  A track's artist name overrides the artist lookup's.
    """
    dim = _dimension(track_cache.where(F.col("fetch_success")).select(
        F.col("artist_clean").alias("__t_artist"), F.col("song_clean").alias("__t_song"),
        F.col("duration").alias("__t_duration"), F.col("track_mbid").alias("__t_mbid"),
        F.col("artist_lastfm").alias("__t_artist_lastfm"), F.col("song_lastfm").alias("__t_song_lastfm")))
    j = records.join(dim, (records["artist_clean"] == dim["__t_artist"]) & (records["song_clean"] == dim["__t_song"]),
                     "left")

    def pick(new, old, test=truthy):
        return F.when(test(F.col(new)), F.col(new)).otherwise(F.col(old))

    return j.withColumns({
        "track_duration": pick("__t_duration", "track_duration", truthy_number).cast("int"),
        "track_mbid": pick("__t_mbid", "track_mbid"),
        "artist_lastfm": pick("__t_artist_lastfm", "artist_lastfm"),
        "song_lastfm": pick("__t_song_lastfm", "song_lastfm"),
    }).drop("__t_artist", "__t_song", "__t_duration", "__t_mbid", "__t_artist_lastfm", "__t_song_lastfm")
