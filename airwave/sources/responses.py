"""Metadata responses (JSON) to typed cache rows.

The original job calls the web services one row at a time.  Here the
responses are a table ``(key columns, lookup_name, seq, status_code, body)``
-- whatever fetched them -- and parsing is ``from_json`` plus column
expressions, so it runs in the JVM over any number of responses.

Outcome rules (F18): status 408 is a timeout, other 4xx/5xx are request
errors, a 2xx body that is not a JSON object is invalid JSON; otherwise the
body decides (found / no image / not found).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions.rules import INTEGER_PATTERN
from airwave.functions.text import py_strip, truncate_error

ARTIST_BODY = ("struct<artist: struct<name: string, mbid: string, "
               "image: array<struct<`#text`: string, size: string>>>>")
TRACK_BODY = ("struct<track: struct<name: string, mbid: string, duration: string, "
              "artist: struct<name: string>>>")
COVER_BODY = "struct<images: array<struct<image: string>>>"

ARTIST_CACHE_COLUMNS = ["artist_name", "artist_lastfm", "image_url", "mbid", "fetch_success", "error_message"]
TRACK_CACHE_COLUMNS = ["artist_clean", "song_clean", "artist_lastfm", "song_lastfm", "duration",
                       "track_mbid", "fetch_success", "error_message"]


def _nonblank(c: Column) -> Column:
    """Python truthiness of a JSON string value."""
    return c.isNotNull() & (c != "")


def _outcome(status: Column, body: Column):
    timeout = status == 408
    http_error = (status >= 400) & (status < 600) & ~timeout
    keys = F.json_object_keys(body)
    invalid = ~timeout & ~http_error & keys.isNull()
    return timeout, http_error, invalid, keys


def _http_error_text(status: Column, body: Column) -> Column:
    """Status and what the server answered, cut at 100 characters."""
    answer = F.coalesce(F.concat(F.lit(": "), F.when(body != "", body)), F.lit(""))
    return truncate_error(F.concat(status.cast("string"), F.lit(" HTTP error"), answer))


def parse_cover_responses(covers: DataFrame) -> DataFrame:
    """(mbid, status_code, body) -> (mbid, cover_image); NULL unless a 200 with images."""
    parsed = F.from_json(F.col("body"), COVER_BODY)
    image = F.get(parsed.getField("images"), 0).getField("image")
    return covers.select("mbid", F.when(F.col("status_code") == 200, image).alias("cover_image"))


def parse_artist_responses(responses: DataFrame, covers: DataFrame | None = None) -> DataFrame:
    """Artist responses -> artist cache rows.

    ``responses``: artist_clean, lookup_name, seq, status_code, body.
    ``covers``: output of :func:`parse_cover_responses`, one row per mbid.
    """
    status, body = F.col("status_code"), F.col("body")
    timeout, http_error, invalid, keys = _outcome(status, body)
    parsed = F.from_json(body, ARTIST_BODY).getField("artist")
    ok = ~timeout & ~http_error & ~invalid
    has_artist = ok & F.array_contains(keys, "artist")
    has_image_key = has_artist & F.array_contains(
        F.json_object_keys(F.get_json_object(body, "$.artist")), "image")
    name, mbid = parsed.getField("name"), parsed.getField("mbid")
    images = F.filter(parsed.getField("image"), lambda x: py_strip(x.getField("#text")) != "")
    df = responses.withColumns({
        "__ok": ok, "__timeout": timeout, "__http": http_error, "__has_artist": has_artist,
        "__has_image": has_image_key,
        "artist_lastfm": F.when(has_artist & _nonblank(name), py_strip(name)),
        "mbid": F.when(has_artist & _nonblank(mbid), mbid),
        "__last_image": F.when(has_image_key, F.try_element_at(images, F.lit(-1)).getField("#text")),
    })
    if covers is not None:
        c = covers.select(F.col("mbid").alias("__cover_mbid"), F.col("cover_image").alias("__cover"))
        df = df.join(c, df["mbid"] == c["__cover_mbid"], "left").drop("__cover_mbid")
    else:
        df = df.withColumn("__cover", F.lit(None).cast("string"))
    lookup = F.col("lookup_name")
    cover_hit = _nonblank(F.col("__cover"))
    image_hit = F.col("__has_image") & F.col("__last_image").isNotNull()
    image_url = (
        F.when(F.col("__timeout"), F.concat(F.lit("Timeout for artist: "), lookup))
        .when(F.col("__http"), F.concat(F.lit("Request error for "), lookup, F.lit(": "), _http_error_text(status, body)))
        .when(~F.col("__ok"), F.concat(F.lit("Invalid JSON response for "), lookup))
        .when(cover_hit, F.col("__cover"))
        .when(image_hit, F.col("__last_image"))
        .when(F.col("__has_image"), F.lit("No image found"))
        .otherwise(F.concat(F.lit("Artist not found: "), lookup))
    )
    success = F.col("__ok") & (cover_hit | image_hit)
    error = (
        F.when(F.col("__timeout"), F.lit("API timeout"))
        .when(F.col("__http"), _http_error_text(status, body))
        .when(~F.col("__ok"), F.lit("Invalid JSON response"))
        .when(success, F.lit(None).cast("string"))
        .when(F.col("__has_image"), F.lit("No image available"))
        .otherwise(F.lit("Artist not found"))
    )
    failed_call = F.col("__timeout") | F.col("__http") | ~F.col("__ok")
    return df.select(
        F.col("artist_clean").alias("artist_name"),
        "lookup_name", "seq",
        F.when(~failed_call, F.col("artist_lastfm")).alias("artist_lastfm"),
        image_url.alias("image_url"),
        F.when(~failed_call, F.col("mbid")).alias("mbid"),
        success.alias("fetch_success"),
        error.alias("error_message"),
    )


def parse_track_responses(responses: DataFrame) -> DataFrame:
    """Track responses -> track cache rows.

    ``responses``: artist_clean, song_clean, seq, status_code, body.
    """
    status, body = F.col("status_code"), F.col("body")
    timeout, http_error, invalid, keys = _outcome(status, body)
    track = F.from_json(body, TRACK_BODY).getField("track")
    found = ~timeout & ~http_error & ~invalid & F.array_contains(keys, "track")
    raw_ms = py_strip(track.getField("duration"))
    ms = F.when(raw_ms.rlike(INTEGER_PATTERN), F.regexp_replace(raw_ms, "_", "").try_cast("bigint"))
    # A JSON number is truncated like int() does; a string must be a whole number.
    number = F.from_json(body, "struct<track: struct<duration: double>>").getField("track").getField("duration")
    whole = F.when(F.abs(number) < 1e18, number).cast("bigint")
    duration = (F.when(number.isNotNull(), F.when(whole > 0, F.floor(whole / 1000)))
                .when(_nonblank(track.getField("duration")) & (ms > 0), F.floor(ms / 1000))).cast("int")
    error = (
        F.when(timeout, F.lit("API timeout"))
        .when(http_error, _http_error_text(status, body))
        .when(invalid, F.lit("Invalid JSON response"))
        .when(~found, F.lit("Track not found"))
    )
    mbid = track.getField("mbid")
    return responses.select(
        "artist_clean", "song_clean", "seq",
        F.when(found, py_strip(track.getField("artist").getField("name"))).alias("artist_lastfm"),
        F.when(found, py_strip(track.getField("name"))).alias("song_lastfm"),
        F.when(found, duration).alias("duration"),
        F.when(found & _nonblank(mbid), mbid).alias("track_mbid"),
        found.alias("fetch_success"),
        error.alias("error_message"),
    )
