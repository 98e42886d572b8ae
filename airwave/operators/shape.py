"""Column shaping between the raw log and the records table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airwave.functions.clean import clean_artist, clean_song
from airwave.functions.timeparse import parse_time
from airwave.operators.dictionary import distinct_values, map_distinct, values_of

REQUIRED_COLUMNS = ["raw_song", "raw_artist", "song_clean", "artist_clean", "callsign", "time",
                    "time_unix", "unique_id", "combined", "first_question"]
COLUMN_RENAMES = {"first_question": "first_play"}
METADATA_COLUMNS = {
    "artist_image_url": T.StringType(),
    "artist_mbid": T.StringType(),
    "artist_lastfm": T.StringType(),
    "track_duration": T.IntegerType(),
    "track_mbid": T.StringType(),
    "song_lastfm": T.StringType(),
}


def add_clean_columns(df: DataFrame, artist: str = "RAW_ARTIST", song: str = "RAW_SONG",
                      time: str = "TIME", suffix_case=str.upper) -> DataFrame:
    """ARTIST_CLEAN, SONG_CLEAN, TIME_UNIX.

    One pass over the log finds the distinct artists and songs, from which both
    cleaning dictionaries are made; the log itself is only joined to them.
    """
    values = distinct_values(df, [artist, song])
    df = map_distinct(df, [artist], {suffix_case("artist_clean"): clean_artist(artist)}, source=values_of(values, artist))
    df = map_distinct(df, [song], {suffix_case("song_clean"): clean_song(song)}, source=values_of(values, song))
    return df.withColumn(suffix_case("time_unix"), parse_time(time))


def normalize_column_names(df: DataFrame) -> DataFrame:
    """lower-case, ``?`` -> ``_question``, space -> ``_``."""
    return df.toDF(*[c.lower().replace("?", "_question").replace(" ", "_") for c in df.columns])


def project_available(df: DataFrame, required: list[str]) -> DataFrame:
    """Keep the required columns that exist, in required order."""
    return df.select(*[F.col(f"`{c}`") for c in required if c in df.columns])


def rename_existing(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by mapping, ignoring absent columns."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def add_empty_columns(df: DataFrame, columns: dict[str, T.DataType]) -> DataFrame:
    """Typed all-NULL columns, only those not present yet (P5)."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def validate_columns(spark: SparkSession, df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column with a presence flag (P6); schema-only, no job."""
    present = set(df.columns)
    return spark.createDataFrame([(c, c in present) for c in required], "column string, present boolean")


def to_records(raw: DataFrame) -> DataFrame:
    """Raw log (S1 layout) -> records table layout."""
    df = add_clean_columns(raw)
    df = normalize_column_names(df)
    df = project_available(df, REQUIRED_COLUMNS)
    df = rename_existing(df, COLUMN_RENAMES)
    return add_empty_columns(df, METADATA_COLUMNS)
