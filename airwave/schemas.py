"""Table layouts (S5): the raw log, the records table and the two caches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, I, L, B, TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_LOG = _schema(("RAW_SONG", S), ("RAW_ARTIST", S), ("CALLSIGN", S), ("TIME", S), ("UNIQUE_ID", S),
                  ("COMBINED", S), ("First?", S))

MUSIC_RECORDS = _schema(
    ("raw_song", S), ("raw_artist", S), ("song_clean", S), ("artist_clean", S), ("artist_lastfm", S),
    ("song_lastfm", S), ("callsign", S), ("time", S), ("time_unix", L), ("unique_id", S), ("combined", S),
    ("first_play", S), ("artist_image_url", S), ("artist_mbid", S), ("track_duration", I), ("track_mbid", S),
    ("created_at", TS), ("updated_at", TS))

ARTIST_IMAGES = _schema(("artist_name", S), ("artist_lastfm", S), ("image_url", S), ("mbid", S),
                        ("fetch_success", B), ("error_message", S), ("created_at", TS), ("updated_at", TS))

TRACK_INFO = _schema(("artist_clean", S), ("song_clean", S), ("artist_lastfm", S), ("song_lastfm", S),
                     ("duration", I), ("track_mbid", S), ("fetch_success", B), ("error_message", S),
                     ("created_at", TS), ("updated_at", TS))

ARTIST_MATCH = _schema(("original_name", S), ("canonical_name", S), ("similarity_score", T.DoubleType()),
                       ("play_count", L))

DATABASE_STATS = _schema(("music_records_count", L), ("records_with_timestamps", L), ("cached_artists", L),
                         ("successful_images", L), ("cached_tracks", L), ("timestamp", TS))

TABLES = {"music_records": MUSIC_RECORDS, "artist_images": ARTIST_IMAGES, "track_info": TRACK_INFO}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; any other failure to look is an error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def create_if_absent(spark: SparkSession, schema: T.StructType, location: str) -> DataFrame:
    """Create an empty parquet table at ``location`` unless one exists; return it."""
    if not path_exists(spark, location):
        empty(spark, schema).write.parquet(location)
    return spark.read.schema(schema).parquet(location)
