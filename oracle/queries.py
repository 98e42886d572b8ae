"""DuckDB oracle SQL per registered query (same names, same column aliases)."""

from __future__ import annotations

from oracle.duck import with_plays

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


LISTEN = """
SELECT coalesce(artist_lastfm, artist_clean) AS display_name, min(artist_clean) AS artist_clean,
  min(artist_lastfm) AS artist_lastfm, count(*) AS play_count,
  avg(track_duration) AS avg_duration_seconds, CAST(sum(track_duration) AS BIGINT) AS total_listening_seconds
FROM plays WHERE track_duration IS NOT NULL AND track_duration > 0 AND artist_clean IS NOT NULL
GROUP BY 1"""

oracle("top_listening_time", with_plays(f"""
SELECT *,
  CASE WHEN total_listening_seconds >= 3600 THEN CAST(total_listening_seconds // 3600 AS VARCHAR) || 'h ' || CAST((total_listening_seconds % 3600) // 60 AS VARCHAR) || 'm'
       WHEN total_listening_seconds >= 60 THEN CAST(total_listening_seconds // 60 AS VARCHAR) || 'm ' || CAST(total_listening_seconds % 60 AS VARCHAR) || 's'
       ELSE CAST(total_listening_seconds AS VARCHAR) || 's' END AS total_listening_time,
  CASE WHEN avg_duration_seconds IS NULL OR avg_duration_seconds = 0 THEN 'N/A'
       ELSE CAST(CAST(floor(avg_duration_seconds) AS BIGINT) // 60 AS VARCHAR) || ':' || lpad(CAST(CAST(floor(avg_duration_seconds) AS BIGINT) % 60 AS VARCHAR), 2, '0') END AS avg_duration,
  row_number() OVER (ORDER BY total_listening_seconds DESC, display_name) AS rank
FROM g ORDER BY total_listening_seconds DESC, display_name LIMIT 10""", f"g AS ({LISTEN})"))

oracle("bottom_artists", with_plays("""
SELECT *, row_number() OVER (ORDER BY play_count, display_name) AS rank FROM (
  SELECT coalesce(artist_lastfm, artist_clean) AS display_name, min(artist_clean) AS artist_clean,
    min(artist_lastfm) AS artist_lastfm, count(*) AS play_count
  FROM plays WHERE artist_clean IS NOT NULL GROUP BY 1) ORDER BY play_count, display_name LIMIT 10"""))

oracle("top_artists", with_plays("""
SELECT *, row_number() OVER (ORDER BY play_count DESC, artist_clean) AS rank FROM (
  SELECT artist_clean, count(*) AS play_count FROM plays WHERE artist_clean IS NOT NULL GROUP BY 1)
ORDER BY play_count DESC, artist_clean LIMIT 10"""))

oracle("artist_play_counts", with_plays("""
SELECT artist_clean, count(*) AS play_count FROM plays
WHERE artist_clean IS NOT NULL AND artist_clean <> '' GROUP BY 1"""))

oracle("distinct_artist_rollup", with_plays("""
SELECT coalesce(CASE WHEN artist_lastfm IS NULL OR artist_lastfm = '' OR artist_lastfm = 'None' THEN NULL
                     ELSE artist_lastfm END, artist_clean) AS artist_name,
  count(*) AS play_count, min(artist_clean) AS artist_clean, min(artist_lastfm) AS artist_lastfm
FROM plays WHERE artist_clean IS NOT NULL AND artist_clean <> '' AND trim(artist_clean) <> ''
GROUP BY 1 ORDER BY play_count DESC, artist_name"""))

oracle("records_per_callsign", with_plays("""
SELECT callsign, count(*) AS record_count FROM plays GROUP BY callsign ORDER BY record_count DESC"""))

oracle("distinct_raw_artists", with_plays("SELECT DISTINCT raw_artist FROM plays"))

oracle("parse_coverage", with_plays(
    "SELECT count(time_unix) AS parsed_count, count(*) AS total_count FROM plays"))

oracle("clean_artists", with_plays("SELECT DISTINCT raw_artist, artist_clean FROM plays"))
oracle("clean_songs", with_plays("SELECT DISTINCT raw_song, song_clean FROM plays"))
oracle("parse_time", with_plays("SELECT DISTINCT raw_time, time_unix FROM plays"))

oracle("like_filter", with_plays(
    "SELECT play_key, raw_artist, artist_clean FROM plays WHERE raw_artist ILIKE '%ring%'"))

oracle("shape_columns", with_plays("""
SELECT raw_song, raw_artist, song_clean, artist_clean, callsign, raw_time AS time, time_unix,
  CAST(play_key AS VARCHAR) AS unique_id, concat_ws(' - ', raw_artist, raw_song) AS combined,
  CASE WHEN first_play THEN 'Y' ELSE 'N' END AS first_play,
  CAST(NULL AS VARCHAR) AS artist_image_url, CAST(NULL AS VARCHAR) AS artist_mbid,
  CAST(NULL AS VARCHAR) AS artist_lastfm, CAST(NULL AS INTEGER) AS track_duration,
  CAST(NULL AS VARCHAR) AS track_mbid, CAST(NULL AS VARCHAR) AS song_lastfm
FROM plays"""))


# ---------------------------------------------------------------- metadata
from oracle import metadata_sql as M  # noqa: E402

oracle("cover_response_parse", "WITH " + M.covers() + " SELECT * FROM covers")
oracle("artist_response_parse", with_plays(
    "SELECT * FROM artist_parsed",
    ", ".join([M.covers(), M.artist_answers(), M.parse_artist("artist_resp", "artist_parsed")])))
oracle("track_response_parse", with_plays(
    "SELECT * FROM track_parsed", ", ".join([M.track_answers(), M.parse_track("track_resp", "track_parsed")])))
oracle("cache_hits", with_plays(
    "SELECT k.artist_clean, c.artist_lastfm, c.image_url, c.mbid, c.fetch_success, c.error_message "
    "FROM artist_keys k JOIN prev_artist_cache c ON k.artist_clean = c.artist_name WHERE c.fetch_success",
    M.artist_cache_ctes()))
oracle("cache_misses", with_plays("SELECT * FROM artist_misses", M.artist_cache_ctes()))
oracle("merge_artist_cache", with_plays("SELECT * FROM artist_cache", M.artist_cache_ctes()))
oracle("merge_track_cache", with_plays("SELECT * FROM track_cache", M.track_cache_ctes()))
oracle("enrich_artists", with_plays(
    "SELECT play_key, artist_clean, e_artist_lastfm AS artist_lastfm, artist_image_url, artist_mbid FROM enr_a",
    M.artist_cache_ctes() + ", " + M.enriched_artists_cte()))
oracle("enrich_tracks", with_plays(
    "SELECT e.play_key, e.artist_clean, e.song_clean, "
    "CASE WHEN t.artist_lastfm IS NOT NULL AND t.artist_lastfm <> '' THEN t.artist_lastfm ELSE e.e_artist_lastfm END AS artist_lastfm, "
    "CASE WHEN t.song_lastfm IS NOT NULL AND t.song_lastfm <> '' THEN t.song_lastfm END AS song_lastfm, "
    "CASE WHEN t.duration IS NOT NULL AND t.duration <> 0 THEN t.duration END AS track_duration, "
    "CASE WHEN t.track_mbid IS NOT NULL AND t.track_mbid <> '' THEN t.track_mbid END AS track_mbid "
    "FROM enr_a e LEFT JOIN (SELECT * FROM track_cache WHERE fetch_success) t "
    "ON e.artist_clean = t.artist_clean AND e.song_clean = t.song_clean",
    M.artist_cache_ctes() + ", " + M.enriched_artists_cte() + ", " + M.track_cache_ctes()))
oracle("fetch_status", with_plays(
    "SELECT CASE WHEN fetch_success THEN 'Success' ELSE 'Failed' END AS status, count(*) AS entries "
    "FROM artist_cache GROUP BY 1", M.artist_cache_ctes()))
oracle("summary_stats", with_plays(
    "SELECT (SELECT count(*) FROM plays) AS music_records_count, (SELECT count(time_unix) FROM plays) AS records_with_timestamps, "
    "(SELECT count(*) FROM artist_cache) AS cached_artists, (SELECT count(*) FROM artist_cache WHERE fetch_success) AS successful_images, "
    "(SELECT count(*) FROM track_cache) AS cached_tracks", M.artist_cache_ctes() + ", " + M.track_cache_ctes()))
oracle("duration_counts", with_plays(
    "SELECT (SELECT count(duration) FROM track_cache) AS tracks_with_duration, "
    "(SELECT count(track_duration) FROM plays) AS records_with_duration", M.track_cache_ctes()))
oracle("previews", with_plays(
    "SELECT artist_name, CASE WHEN fetch_success THEN 'Success' ELSE 'Failed' END AS status, "
    "substr(image_url, 1, 50) || '...' AS image_preview FROM artist_cache", M.artist_cache_ctes()))

oracle("cache_preview", ORACLES["previews"] + " ORDER BY artist_name LIMIT 5")
oracle("first_records", with_plays(
    "SELECT play_key, raw_artist, artist_clean, callsign, raw_time FROM plays ORDER BY play_key LIMIT 10"))


def long_rows(section: str, metric: str, value: str, src: str, item: str = "NULL", rank: str = "NULL") -> str:
    return (f"SELECT '{section}' AS section, CAST({rank} AS INTEGER) AS rank, CAST({item} AS VARCHAR) AS item, "
            f"'{metric}' AS metric, CAST({value} AS BIGINT) AS value FROM {src}")


oracle("exploration_report", with_plays(" UNION ALL ".join([
    long_rows("summary", "records", "count(*)", "plays"),
    long_rows("summary", "distinct_raw_artists", "count(*)", "(SELECT DISTINCT raw_artist FROM plays)"),
    long_rows("callsign", "records", "count(*)", "plays GROUP BY callsign", "callsign"),
    long_rows("fetch_status", "entries", "count(*)", "artist_cache GROUP BY fetch_success",
              "CASE WHEN fetch_success THEN 'Success' ELSE 'Failed' END")]), M.artist_cache_ctes()))

SHOWN = ("shown AS (SELECT coalesce(artist_lastfm, artist_clean) AS name, count(*) AS plays, "
         "count(*) FILTER (track_duration > 0) AS timed, sum(track_duration) FILTER (track_duration > 0) AS seconds "
         "FROM plays WHERE artist_clean IS NOT NULL GROUP BY 1), "
         "listened AS (SELECT *, row_number() OVER (ORDER BY seconds DESC, name) AS r FROM shown WHERE timed > 0), "
         "fewest AS (SELECT *, row_number() OVER (ORDER BY plays, name) AS r FROM shown), "
         "most AS (SELECT *, row_number() OVER (ORDER BY plays DESC, name) AS r FROM ("
         "SELECT artist_clean AS name, count(*) AS plays FROM plays WHERE artist_clean IS NOT NULL GROUP BY 1))")
oracle("statistics_report", with_plays(" UNION ALL ".join([
    long_rows("summary", "records", "count(*)", "plays"),
    long_rows("summary", "records_with_timestamps", "count(time_unix)", "plays"),
    long_rows("summary", "records_with_duration", "count(track_duration)", "plays"),
    long_rows("summary", "cached_artists", "count(*)", "artist_cache"),
    long_rows("summary", "successful_images", "count(*) FILTER (fetch_success)", "artist_cache"),
    long_rows("summary", "cached_tracks", "count(*)", "track_cache"),
    long_rows("summary", "tracks_with_duration", "count(duration)", "track_cache"),
    long_rows("top_listening_time", "seconds", "seconds", "listened WHERE r <= 10", "name", "r"),
    long_rows("top_listening_time", "timed", "timed", "listened WHERE r <= 10", "name", "r"),
    long_rows("bottom_artists", "plays", "plays", "fewest WHERE r <= 10", "name", "r"),
    long_rows("top_artists", "plays", "plays", "most WHERE r <= 10", "name", "r")]),
    M.artist_cache_ctes() + ", " + M.track_cache_ctes() + ", " + SHOWN))

oracle("random_sample", with_plays(
    "SELECT artist_clean, song_clean, duration, substr(track_mbid, 1, 8) || '...' AS mbid_preview, "
    "CAST(duration // 60 AS VARCHAR) || ':' || lpad(CAST(duration % 60 AS VARCHAR), 2, '0') AS duration_text "
    "FROM track_cache WHERE duration > 0 "
    "ORDER BY md5(concat_ws('|', artist_clean, song_clean, '7')), artist_clean, song_clean LIMIT 5",
    M.track_cache_ctes()))
oracle("clean_plays", with_plays("SELECT play_key, artist_clean, song_clean, time_unix FROM plays"))
oracle("distinct_raw_artist_count", with_plays(
    "SELECT count(*) AS distinct_count FROM (SELECT DISTINCT raw_artist FROM plays)"))
oracle("append_union", with_plays(
    "SELECT play_key, raw_artist, CASE WHEN first_play THEN raw_song END AS raw_song, "
    "CASE WHEN NOT first_play THEN callsign END AS callsign FROM plays"))
oracle("log_round_trip", with_plays("""
SELECT raw_song AS "RAW_SONG", raw_artist AS "RAW_ARTIST", callsign AS "CALLSIGN", raw_time AS "TIME",
  CAST(play_key AS VARCHAR) AS "UNIQUE_ID", concat_ws(' - ', raw_artist, raw_song) AS "COMBINED",
  CASE WHEN first_play THEN 'Y' ELSE 'N' END AS "First?" FROM plays"""))
VALUES = [f"coalesce('\"' || replace({x}, '\"', '\\\"') || '\"', '')" for x in (
    "raw_song", "raw_artist", "callsign", "raw_time", "CAST(play_key AS VARCHAR)", "concat_ws(' - ', raw_artist, raw_song)",
    "CASE WHEN first_play THEN 'Y' ELSE 'N' END")]
oracle("log_quarantine", with_plays(f"""
SELECT CASE WHEN line IS NULL THEN raw_song END AS "RAW_SONG", CASE WHEN line IS NULL THEN raw_artist END AS "RAW_ARTIST",
  CASE WHEN line IS NULL THEN callsign END AS "CALLSIGN", CASE WHEN line IS NULL THEN raw_time END AS "TIME",
  CASE WHEN line IS NULL THEN CAST(play_key AS VARCHAR) END AS "UNIQUE_ID",
  CASE WHEN line IS NULL THEN concat_ws(' - ', raw_artist, raw_song) END AS "COMBINED",
  CASE WHEN line IS NULL THEN CASE WHEN first_play THEN 'Y' ELSE 'N' END END AS "First?", line,
  CASE play_key % 11 WHEN 3 THEN 'too few values' WHEN 5 THEN 'too many values' WHEN 7 THEN 'open quote' END AS reason,
  CASE WHEN line IS NULL THEN 'kept' ELSE 'quarantined' END AS status
FROM (SELECT *, CASE play_key % 11 WHEN 3 THEN {" || ';' || ".join(VALUES[:4])} WHEN 5 THEN {" || ';' || ".join(VALUES)} || ';more'
  WHEN 7 THEN '"' || {" || ';' || ".join(VALUES[:6])} || ';"Y' END AS line FROM plays)"""))
oracle("export_round_trip", with_plays("SELECT play_key, callsign, raw_time, track_duration FROM plays"))
oracle("rollup_round_trip", ORACLES["distinct_artist_rollup"].replace(
    "min(artist_lastfm) AS artist_lastfm", "nullif(min(artist_lastfm), '') AS artist_lastfm"))
oracle("save_rate", "SELECT run, n AS total_records, n AS saved_records, 100.0::DOUBLE AS success_rate "
       "FROM (SELECT count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey), (VALUES (1), (2)) AS r(run)")


# ------------------------------------------------------- name normalisation
from oracle import names_sql as N  # noqa: E402

oracle("the_prefix_map", N.plan("SELECT old_key, new_name FROM n_the"))
oracle("remaining_after_the", N.plan("SELECT name, play_count FROM n_left"))
oracle("fuzzy_pairs", with_plays("SELECT a, b, lcs FROM f_edges", ", ".join([
    "f_left AS (SELECT artist_clean AS name, count(*) AS play_count FROM plays "
    "WHERE artist_clean IS NOT NULL AND artist_clean <> '' GROUP BY 1)", *N.edges("f", 90)])))
oracle("fuzzy_clusters", N.plan("SELECT name AS original_name, canonical AS canonical_name, "
                                "score AS similarity_score, play_count FROM n_named"))
oracle("normalize_map", N.plan("SELECT old_key, new_name FROM n_map"))
oracle("normalized_plays", N.plan(
    "SELECT coalesce(m.new_name, p.artist_clean) AS artist_clean, count(*) AS play_count, "
    "count(m.old_key) AS renamed_plays FROM plays p LEFT JOIN n_map m ON lower(p.artist_clean) = m.old_key GROUP BY 1"))
oracle("threshold_sweep", N.sweep((95, 90, 85)))
oracle("pipeline_records", N.plan(
    "SELECT CAST(e.play_key AS VARCHAR) AS unique_id, coalesce(m.new_name, e.artist_clean) AS artist_clean, "
    "e.song_clean, e.time_unix, "
    "CASE WHEN t.artist_lastfm IS NOT NULL AND t.artist_lastfm <> '' THEN t.artist_lastfm ELSE e.e_artist_lastfm END AS artist_lastfm, "
    "CASE WHEN t.song_lastfm IS NOT NULL AND t.song_lastfm <> '' THEN t.song_lastfm END AS song_lastfm, "
    "CASE WHEN t.duration IS NOT NULL AND t.duration <> 0 THEN t.duration END AS track_duration, e.artist_image_url "
    "FROM enr_a e LEFT JOIN (SELECT * FROM track_cache WHERE fetch_success) t "
    "ON e.artist_clean = t.artist_clean AND e.song_clean = t.song_clean "
    "LEFT JOIN n_map m ON lower(e.artist_clean) = m.old_key",
    M.artist_cache_ctes() + ", " + M.enriched_artists_cte() + ", " + M.track_cache_ctes()))
