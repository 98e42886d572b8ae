"""Play-log shaped tables derived by Spark from the driver's TPC-H-like tables.

The original job reads a radio play log and talks to metadata web services.
Neither exists here, so these plans derive the same shapes from ``lineitem``
and ``part`` (every row, no sampling): each line item is one play, the part
name is the artist, the part type the song.  The CASE spreads reproduce the
kinds of mess the cleaners handle ("The" prefixes, upper case, featuring
credits, quotes, annotations, doubled / dropped letters, NULLs, mixed time
formats).  The same definitions are written in DuckDB SQL in ``oracle/duck.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.functions.clean import clean_artist, clean_song
from airwave.functions.text import lookup_term
from airwave.functions.timeparse import parse_time
from airwave.operators.dictionary import distinct_values, map_distinct, values_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all shuffle partitions: a table in one small file is read by one task, whatever work follows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# Names that the band rules of cleaning and matching know, and one that is close to such a name.
BANDS = ("beatles", "the beatles", "kinks", "kinkss", "Guess Who", "THE CLASH")


def _mod_case(key: Column, mod: int, branches: dict, default: Column) -> Column:
    k = F.pmod(key, F.lit(mod))
    out = None
    for value, result in branches.items():
        out = F.when(k == value, result) if out is None else out.when(k == value, result)
    return out.otherwise(default)


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One play per line item: raw text columns plus seeded metadata."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    j = li.join(part, li.l_partkey == part.p_partkey)
    name, ok, ln = F.col("p_name"), F.col("l_orderkey"), F.col("l_linenumber")
    band = F.element_at(F.array(*[F.lit(b) for b in BANDS]), F.pmod(F.col("p_size"), F.lit(len(BANDS))) + 1)
    raw_artist = _mod_case(ok, 19, {
        0: F.concat(F.lit("The "), name),
        1: F.upper(name),
        2: F.concat(name, F.lit(" FT. "), F.col("p_brand")),
        3: F.concat(F.lit('"'), name, F.lit('"')),
        4: F.concat(F.lit("  "), name, F.lit(" (Live)")),
        5: F.concat(F.substring(name, 1, 4), F.substr(name, F.lit(4))),
        6: F.concat(F.substring(name, 1, 3), F.substr(name, F.lit(5))),
        7: F.when(ln == 1, F.lit(None).cast("string")).otherwise(name),
        8: F.concat(F.lit("The The "), name),
        9: F.concat(name, F.lit(" [Remaster] {x}")),
        10: F.concat(F.lit("..."), name, F.lit(" \u2013 duo..")),
        11: F.concat(F.lit("dj "), name, F.lit(" ,ok;yes:no!now?")),
        12: band,
        13: F.concat(F.lit("The "), name, F.lit(" of the sea")),
        14: F.concat(name, F.lit(" of the sea")),
        15: F.upper(F.concat(F.lit("The "), name, F.lit(" of the sea"))),
        16: F.when(name.startswith("hot "), F.concat(
            name, F.lit(" and the long winded travelling orchestra of the northern provinces"))).otherwise(name),
    }, name)
    raw_song = F.concat(F.lower(F.col("p_type")), _mod_case(ln, 5, {
        0: F.lit(" with a twist"), 1: F.lit(" (Acoustic)"), 2: F.lit(": the end"), 3: F.lit(" VS night"),
    }, F.lit("")), _mod_case(ok, 9, {
        0: F.lit(" (Radio Edit)"), 1: F.lit(" feat. dj x"), 2: F.lit("..."), 3: F.lit(" [Mix] (remix)"),
        4: F.lit(" \u2014 'the' end, of it"),
    }, F.lit("")))
    callsign = F.when(F.pmod(F.col("l_suppkey"), F.lit(10)) == 3, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("K"), F.col("l_suppkey").cast("string")))
    ship = F.col("l_shipdate").cast("string")
    us_date = F.concat(F.substring(ship, 6, 2), F.lit("/"), F.substring(ship, 9, 2), F.lit("/"),
                       F.substring(ship, 1, 4))
    raw_time = _mod_case(ln, 6, {
        0: F.substring(ship, 1, 10),
        1: F.concat(F.substring(ship, 1, 10), F.lit(" 12:30:45")),
        2: F.concat(us_date, F.lit(" 01:30:45 PM")),
        3: F.concat(us_date, F.lit(" 07:05")),
        4: (F.lit(1400000000) + ok).cast("string"),
    }, F.lit("unknown"))
    duration = F.when(F.pmod(ok, F.lit(4)) == 0, F.lit(None).cast("int")).otherwise(
        (F.col("l_quantity") * 9).cast("int"))
    lastfm = _mod_case(F.col("l_partkey"), 5, {
        0: F.lit("None"), 1: F.lit(""), 2: F.lit(None).cast("string"),
    }, F.upper(name))
    return j.select(
        (ok.cast("bigint") * 10 + ln).alias("play_key"),
        raw_artist.alias("raw_artist"),
        raw_song.alias("raw_song"),
        callsign.alias("callsign"),
        raw_time.alias("raw_time"),
        duration.alias("track_duration"),
        lastfm.alias("artist_lastfm"),
        (ln == 1).alias("first_play"),
    )


CLEAN_COLUMNS = ("artist_clean", "song_clean", "time_unix")


def with_clean_columns(df: DataFrame, artist: str = "raw_artist", song: str = "raw_song", time: str = "raw_time",
                       columns: tuple = CLEAN_COLUMNS) -> DataFrame:
    """The asked-for clean columns: artists and songs once per distinct raw value, times per row.

    A dictionary is only built for a column that is asked for; two are made
    from one pass over the plays.
    """
    asked = [raw for raw, clean in ((artist, "artist_clean"), (song, "song_clean")) if clean in columns]
    values = distinct_values(df, asked) if len(asked) == 2 else None
    if "artist_clean" in columns:
        df = map_distinct(df, [artist], {"artist_clean": clean_artist(artist)}, source=values and values_of(values, artist))
    if "song_clean" in columns:
        df = map_distinct(df, [song], {"song_clean": clean_song(song)}, source=values and values_of(values, song))
    return df.withColumn("time_unix", parse_time(time)) if "time_unix" in columns else df


def plays(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Raw plays with the named clean columns (all of CLEAN_COLUMNS if none is named)."""
    return with_clean_columns(raw_plays(spark, sf_dir), columns=columns or CLEAN_COLUMNS)


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays in the delimited log's own column layout (S1 shape)."""
    p = raw_plays(spark, sf_dir)
    return p.select(
        F.col("raw_song").alias("RAW_SONG"),
        F.col("raw_artist").alias("RAW_ARTIST"),
        F.col("callsign").alias("CALLSIGN"),
        F.col("raw_time").alias("TIME"),
        F.col("play_key").cast("string").alias("UNIQUE_ID"),
        F.concat_ws(" - ", "raw_artist", "raw_song").alias("COMBINED"),
        F.when(F.col("first_play"), F.lit("Y")).otherwise(F.lit("N")).alias("First?"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as text lines, every value in quotes; some are short, long or lack a quote."""
    log = raw_log(spark, sf_dir)
    values = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(f"`{c}`"), F.lit('"'), F.lit('\\"')), F.lit('"')), F.lit(""))
              for c in log.columns]
    return log.select(_mod_case(F.col("UNIQUE_ID").cast("bigint"), 11, {
        3: F.concat_ws(";", *values[:4]),
        5: F.concat_ws(";", *values, F.lit("more")),
        7: F.concat_ws(";", F.concat(F.lit('"'), values[0]), *values[1:6], F.lit('"Y')),
    }, F.concat_ws(";", *values)).alias("value"))


# ----------------------------------------------------------------- responses
# Stand-ins for the web-service answers.  A previous run's answers come from
# ``part`` (one call per part, several per artist); this run's answers come
# from the plays' own distinct lookups, given as a table.  Outcomes spread by a CASE over a
# number derived from the row, covering found / blank image / no image key /
# not found / bad JSON / timeout (408) / server error (500).

# What a failing service says; with a name behind it the text passes 100 characters.
BUSY = "<html><body>The service is busy, please wait a while before asking again, and ask for less</body></html> "


def _artist_body(sel: Column, name: Column, mbid: Column) -> tuple[Column, Column]:
    status = F.when(sel == 5, F.lit(408)).when(sel == 6, F.lit(500)).otherwise(F.lit(200))
    body = (
        F.when(sel == 0, F.concat(F.lit('{"artist":{"name":" '), name, F.lit(' ","mbid":"'), mbid,
                                  F.lit('","image":[{"#text":"s.png","size":"small"},{"#text":"","size":"large"}]}}')))
        .when(sel == 1, F.concat(F.lit('{"artist":{"name":"'), name,
                                 F.lit('","mbid":"","image":[{"#text":" ","size":"small"}]}}')))
        .when(sel == 2, F.concat(F.lit('{"artist":{"name":"'), name, F.lit('"}}')))
        .when(sel == 3, F.lit('{"error":6}'))
        .when(sel == 4, F.lit("{bad"))
        .when(sel == 6, F.concat(F.lit(BUSY), name))
    )
    return status, body


def _track_body(sel: Column, song: Column, artist: Column, mbid: Column) -> tuple[Column, Column]:
    status = F.when(sel == 6, F.lit(408)).when(sel == 8, F.lit(500)).otherwise(F.lit(200))
    body = (
        F.when(sel == 0, F.concat(F.lit('{"track":{"name":" '), song, F.lit(' ","mbid":"'), mbid,
                                  F.lit('","duration":"215000","artist":{"name":"'), artist, F.lit('"}}}')))
        .when(sel == 1, F.concat(F.lit('{"track":{"name":"'), song,
                                 F.lit('","mbid":"","duration":"0","artist":{"name":"'), artist, F.lit('"}}}')))
        .when(sel == 2, F.concat(F.lit('{"track":{"name":"'), song, F.lit('","duration":"500"}}')))
        .when(sel == 3, F.concat(F.lit('{"track":{"name":"'), song, F.lit('","mbid":"t1","duration":"215000.5"}}')))
        .when(sel == 4, F.lit('{"track":{"artist":{"name":""}}}'))
        .when(sel == 5, F.lit('{"error":6}'))
        .when(sel == 7, F.lit("{bad"))
        .when(sel == 8, F.concat(F.lit(BUSY), song))
        .when(sel == 9, F.concat(F.lit('{"track":{"name":"'), song, F.lit('","duration":215000.5}}')))
    )
    return status, body


def previous_artist_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A previous run's artist answers: one per part, keyed by the cleaned part name."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    sel = F.pmod(F.col("p_partkey"), F.lit(7))
    status, body = _artist_body(sel, F.col("p_name"), F.concat(F.lit("m"), F.col("p_size").cast("string")))
    return p.select(clean_artist("p_name").alias("artist_clean"), F.col("p_name").alias("lookup_name"),
                    F.col("p_partkey").alias("seq"), status.alias("status_code"), body.alias("body"))


def artist_responses(lookups: DataFrame) -> DataFrame:
    """Artist answers, one per distinct (raw_artist, artist_clean) of ``lookups``."""
    keys = lookups.where(F.col("artist_clean") != "").select("raw_artist", "artist_clean").distinct()
    lookup = lookup_term(F.col("raw_artist"), F.col("artist_clean"))
    sel = F.pmod(F.length(lookup) * 3 + F.length("artist_clean"), F.lit(7))
    status, body = _artist_body(sel, F.upper("artist_clean"),
                                F.concat(F.lit("m"), F.length(lookup).cast("string")))
    return keys.select("artist_clean", lookup.alias("lookup_name"), lookup.alias("seq"),
                       status.alias("status_code"), body.alias("body"))


def cover_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cover-art answers, one per part (MBID 'm' + part key): an image, none, an empty one, bad JSON, not found."""
    parts = table(spark, sf_dir, "part").select("p_partkey")
    sel = F.pmod(F.col("p_partkey"), F.lit(5))
    key = F.col("p_partkey").cast("string")
    body = (F.when(sel == 0, F.concat(F.lit('{"images":[{"image":"http://img/'), key, F.lit('.jpg"}]}')))
            .when(sel == 1, F.lit('{"images":[]}'))
            .when(sel == 3, F.lit('{"images":[{"image":""}]}'))
            .when(sel == 4, F.lit('{"images":[{"image":')))
    return parts.select(F.concat(F.lit("m"), key).alias("mbid"),
                        F.when(sel == 2, F.lit(404)).otherwise(F.lit(200)).alias("status_code"), body.alias("body"))


def previous_track_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A previous run's track answers: one per part, keyed by cleaned name and type."""
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size"))
    sel = F.pmod(F.col("p_partkey"), F.lit(10))
    status, body = _track_body(sel, F.col("p_type"), F.col("p_name"),
                               F.concat(F.lit("t"), F.col("p_size").cast("string")))
    return p.select(clean_artist("p_name").alias("artist_clean"), clean_song(F.lower("p_type")).alias("song_clean"),
                    F.col("p_partkey").alias("seq"), status.alias("status_code"), body.alias("body"))


def track_responses(lookups: DataFrame) -> DataFrame:
    """Track answers, one per distinct (raw artist, raw song, clean keys) of ``lookups``."""
    keys = lookups.where((F.col("artist_clean") != "") & (F.col("song_clean") != "")).select(
        "raw_artist", "raw_song", "artist_clean", "song_clean").distinct()
    la = lookup_term(F.col("raw_artist"), F.col("artist_clean"))
    ls = lookup_term(F.col("raw_song"), F.col("song_clean"))
    sel = F.pmod(F.length(la) + F.length(ls), F.lit(10))
    status, body = _track_body(sel, F.upper("song_clean"), F.col("artist_clean"),
                               F.concat(F.lit("t"), F.length(ls).cast("string")))
    return keys.select("artist_clean", "song_clean", F.concat(la, F.lit("|"), ls).alias("seq"),
                       status.alias("status_code"), body.alias("body"))
