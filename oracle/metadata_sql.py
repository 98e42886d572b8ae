"""DuckDB side of the metadata queries: answers, parsing, W2, MERGE, enrichment."""

from __future__ import annotations

from oracle.duck import clean_ctes, q

BUSY = "<html><body>The service is busy, please wait a while before asking again, and ask for less</body></html> "
STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x=x)


def artist_answer(sel: str, name: str, mbid: str) -> str:
    status = f"CASE {sel} WHEN 5 THEN 408 WHEN 6 THEN 500 ELSE 200 END AS status_code"
    body = (f"CASE {sel} "
            f"WHEN 0 THEN {q('{\"artist\":{\"name\":\" ')} || {name} || {q(' \",\"mbid\":\"')} || {mbid} || "
            f"{q('\",\"image\":[{\"#text\":\"s.png\",\"size\":\"small\"},{\"#text\":\"\",\"size\":\"large\"}]}}')} "
            f"WHEN 1 THEN {q('{\"artist\":{\"name\":\"')} || {name} || "
            f"{q('\",\"mbid\":\"\",\"image\":[{\"#text\":\" \",\"size\":\"small\"}]}}')} "
            f"WHEN 2 THEN {q('{\"artist\":{\"name\":\"')} || {name} || {q('\"}}')} "
            f"WHEN 3 THEN {q('{\"error\":6}')} WHEN 4 THEN '{{bad' WHEN 6 THEN {q(BUSY)} || {name} END AS body")
    return status + ", " + body


def track_answer(sel: str, song: str, artist: str, mbid: str) -> str:
    status = f"CASE {sel} WHEN 6 THEN 408 WHEN 8 THEN 500 ELSE 200 END AS status_code"
    body = (f"CASE {sel} "
            f"WHEN 0 THEN {q('{\"track\":{\"name\":\" ')} || {song} || {q(' \",\"mbid\":\"')} || {mbid} || "
            f"{q('\",\"duration\":\"215000\",\"artist\":{\"name\":\"')} || {artist} || {q('\"}}}')} "
            f"WHEN 1 THEN {q('{\"track\":{\"name\":\"')} || {song} || "
            f"{q('\",\"mbid\":\"\",\"duration\":\"0\",\"artist\":{\"name\":\"')} || {artist} || {q('\"}}}')} "
            f"WHEN 2 THEN {q('{\"track\":{\"name\":\"')} || {song} || {q('\",\"duration\":\"500\"}}')} "
            f"WHEN 3 THEN {q('{\"track\":{\"name\":\"')} || {song} || {q('\",\"mbid\":\"t1\",\"duration\":\"215000.5\"}}')} "
            f"WHEN 4 THEN {q('{\"track\":{\"artist\":{\"name\":\"\"}}}')} "
            f"WHEN 5 THEN {q('{\"error\":6}')} WHEN 7 THEN '{{bad' WHEN 8 THEN {q(BUSY)} || {song} "
            f"WHEN 9 THEN {q('{\"track\":{\"name\":\"')} || {song} || {q('\",\"duration\":215000.5}}')} END AS body")
    return status + ", " + body


def covers() -> str:
    return ("cover_raw AS (SELECT 'm' || CAST(p_partkey AS VARCHAR) AS mbid, "
            "CASE WHEN p_partkey % 5 = 2 THEN 404 ELSE 200 END AS status_code, "
            "CASE p_partkey % 5 WHEN 0 THEN '{\"images\":[{\"image\":\"http://img/' || CAST(p_partkey AS VARCHAR) || '.jpg\"}]}' "
            "WHEN 1 THEN '{\"images\":[]}' WHEN 3 THEN '{\"images\":[{\"image\":\"\"}]}' "
            "WHEN 4 THEN '{\"images\":[{\"image\":' END AS body FROM part), "
            "covers AS (SELECT mbid, CASE WHEN status_code = 200 THEN "
            "json_extract_string(CASE WHEN json_valid(body) THEN body END, '$.images[0].image') END AS cover_image "
            "FROM cover_raw)")


def prev_artist_answers() -> str:
    return ("prev_part AS (SELECT p_partkey, p_name, p_size, p_type FROM part), "
            + clean_ctes("prev_part", "prev_part_c", [("p_name", "artist_clean")])
            + ", prev_artist_resp AS (SELECT artist_clean, p_name AS lookup_name, p_partkey AS seq, "
            + artist_answer("p_partkey % 7", "p_name", "'m' || CAST(p_size AS VARCHAR)") + " FROM prev_part_c)")


def artist_answers() -> str:
    return ("art_keys AS (SELECT DISTINCT raw_artist, artist_clean FROM plays WHERE artist_clean <> ''), "
            "art_keys2 AS (SELECT *, coalesce(CASE WHEN raw_artist <> '' THEN raw_artist END, artist_clean) AS lk "
            "FROM art_keys), "
            "artist_resp AS (SELECT artist_clean, lk AS lookup_name, lk AS seq, "
            + artist_answer("(length(lk) * 3 + length(artist_clean)) % 7", "upper(artist_clean)",
                            "'m' || CAST(length(lk) AS VARCHAR)") + " FROM art_keys2)")


def prev_track_answers() -> str:
    return ("prev_tpart AS (SELECT p_partkey, p_name, p_size, p_type, lower(p_type) AS lt FROM part), "
            + clean_ctes("prev_tpart", "prev_tpart_c", [("p_name", "artist_clean")], [("lt", "song_clean")])
            + ", prev_track_resp AS (SELECT artist_clean, song_clean, p_partkey AS seq, "
            + track_answer("p_partkey % 10", "p_type", "p_name", "'t' || CAST(p_size AS VARCHAR)") + " FROM prev_tpart_c)")


def track_answers() -> str:
    return ("trk_keys AS (SELECT DISTINCT raw_artist, raw_song, artist_clean, song_clean FROM plays "
            "WHERE artist_clean <> '' AND song_clean <> ''), "
            "trk_keys2 AS (SELECT *, coalesce(CASE WHEN raw_artist <> '' THEN raw_artist END, artist_clean) AS la, "
            "coalesce(CASE WHEN raw_song <> '' THEN raw_song END, song_clean) AS ls FROM trk_keys), "
            "track_resp AS (SELECT artist_clean, song_clean, la || '|' || ls AS seq, "
            + track_answer("(length(la) + length(ls)) % 10", "upper(song_clean)", "artist_clean",
                           "'t' || CAST(length(ls) AS VARCHAR)") + " FROM trk_keys2)")


def parse_artist(src: str, out: str) -> str:
    return (
        f"{out}__a AS (SELECT *, status_code = 408 AS is_to, "
        f"status_code >= 400 AND status_code < 600 AND status_code <> 408 AS is_http, "
        f"CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT' THEN body END AS vb FROM {src}), "
        f"{out}__b AS (SELECT *, NOT is_to AND NOT is_http AND vb IS NOT NULL AS ok FROM {out}__a), "
        f"{out}__c AS (SELECT *, ok AND coalesce(list_contains(json_keys(vb), 'artist'), false) AS has_artist FROM {out}__b), "
        f"{out}__d AS (SELECT *, has_artist AND coalesce(list_contains(json_keys(vb, '$.artist'), 'image'), false) AS has_image, "
        f"json_extract_string(vb, '$.artist.name') AS nm, json_extract_string(vb, '$.artist.mbid') AS mb FROM {out}__c), "
        f"{out}__e AS (SELECT *, CASE WHEN has_artist AND nm IS NOT NULL AND nm <> '' THEN {strip('nm')} END AS lastfm, "
        f"CASE WHEN has_artist AND mb IS NOT NULL AND mb <> '' THEN mb END AS mbid_v, "
        f"CASE WHEN has_image THEN list_filter(json_extract_string(vb, '$.artist.image[*].\"#text\"'), "
        f"lambda x: {strip('x')} <> '')[-1] END AS last_image FROM {out}__d), "
        f"{out}__f AS (SELECT e.*, c.cover_image AS cover FROM {out}__e e LEFT JOIN covers c ON e.mbid_v = c.mbid), "
        f"{out}__g AS (SELECT *, cover IS NOT NULL AND cover <> '' AS cover_hit, "
        f"has_image AND last_image IS NOT NULL AS image_hit FROM {out}__f), "
        f"{out} AS (SELECT artist_clean AS artist_name, lookup_name, seq, "
        f"CASE WHEN ok THEN lastfm END AS artist_lastfm, "
        f"CASE WHEN is_to THEN 'Timeout for artist: ' || lookup_name "
        f"WHEN is_http THEN 'Request error for ' || lookup_name || ': ' || substr(CAST(status_code AS VARCHAR) || ' HTTP error' || coalesce(': ' || nullif(body, ''), ''), 1, 100) "
        f"WHEN NOT ok THEN 'Invalid JSON response for ' || lookup_name "
        f"WHEN cover_hit THEN cover WHEN image_hit THEN last_image WHEN has_image THEN 'No image found' "
        f"ELSE 'Artist not found: ' || lookup_name END AS image_url, "
        f"CASE WHEN ok THEN mbid_v END AS mbid, "
        f"ok AND (cover_hit OR image_hit) AS fetch_success, "
        f"CASE WHEN is_to THEN 'API timeout' WHEN is_http THEN substr(CAST(status_code AS VARCHAR) || ' HTTP error' || coalesce(': ' || nullif(body, ''), ''), 1, 100) "
        f"WHEN NOT ok THEN 'Invalid JSON response' WHEN ok AND (cover_hit OR image_hit) THEN NULL "
        f"WHEN has_image THEN 'No image available' ELSE 'Artist not found' END AS error_message FROM {out}__g)")


TRACK_ARTIST = "json_extract_string(vb, '$.track.artist.name')"
TRACK_NAME = "json_extract_string(vb, '$.track.name')"


def parse_track(src: str, out: str) -> str:
    return (
        f"{out}__a AS (SELECT *, status_code = 408 AS is_to, "
        f"status_code >= 400 AND status_code < 600 AND status_code <> 408 AS is_http, "
        f"CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT' THEN body END AS vb FROM {src}), "
        f"{out}__b AS (SELECT *, NOT is_to AND NOT is_http AND vb IS NOT NULL AS ok FROM {out}__a), "
        f"{out}__c AS (SELECT *, ok AND coalesce(list_contains(json_keys(vb), 'track'), false) AS found, "
        f"json_extract_string(vb, '$.track.duration') AS dur, json_extract_string(vb, '$.track.mbid') AS mb FROM {out}__b), "
        f"{out}__d AS (SELECT *, CASE WHEN regexp_full_match({strip('dur')}, '[+-]?\\d(_?\\d)*') "
        f"THEN TRY_CAST(replace({strip('dur')}, '_', '') AS BIGINT) END AS ms FROM {out}__c), "
        f"{out} AS (SELECT artist_clean, song_clean, seq, "
        f"CASE WHEN found THEN {strip(TRACK_ARTIST)} END AS artist_lastfm, "
        f"CASE WHEN found THEN {strip(TRACK_NAME)} END AS song_lastfm, "
        f"CASE WHEN found AND json_type(vb, '$.track.duration') IN ('DOUBLE', 'BIGINT', 'UBIGINT') "
        f"THEN CASE WHEN CAST(dur AS DOUBLE) >= 1 THEN CAST(floor(trunc(CAST(dur AS DOUBLE)) / 1000) AS INTEGER) END "
        f"WHEN found AND dur IS NOT NULL AND dur <> '' AND ms > 0 THEN CAST(ms // 1000 AS INTEGER) END AS duration, "
        f"CASE WHEN found AND mb IS NOT NULL AND mb <> '' THEN mb END AS track_mbid, "
        f"found AS fetch_success, "
        f"CASE WHEN is_to THEN 'API timeout' WHEN is_http THEN substr(CAST(status_code AS VARCHAR) || ' HTTP error' || coalesce(': ' || nullif(body, ''), ''), 1, 100) "
        f"WHEN NOT ok THEN 'Invalid JSON response' WHEN NOT found THEN 'Track not found' END AS error_message FROM {out}__d)")


ARTIST_VALS = ["artist_lastfm", "image_url", "mbid", "fetch_success", "error_message"]
TRACK_VALS = ["artist_lastfm", "song_lastfm", "duration", "track_mbid", "fetch_success", "error_message"]


def one_per_key(src: str, out: str, keys: list[str], vals: list[str]) -> str:
    st = "struct_pack(" + ", ".join(f"{v} := {v}" for v in vals) + ")"
    ks = ", ".join(keys)
    return (f"{out}__w AS (SELECT {ks}, coalesce(arg_min({st}, seq) FILTER (WHERE fetch_success), "
            f"arg_max({st}, seq)) AS w FROM {src} GROUP BY {ks}), "
            f"{out} AS (SELECT {ks}, " + ", ".join(f"w.{v} AS {v}" for v in vals) + f" FROM {out}__w)")


def merge(target: str, updates: str, out: str, keys: list[str], vals: list[str]) -> str:
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM u.{k}" for k in keys)
    sel = ", ".join([f"CASE WHEN u.__u THEN u.{k} ELSE t.{k} END AS {k}" for k in keys]
                    + [f"CASE WHEN u.__u THEN u.{v} ELSE t.{v} END AS {v}" for v in vals])
    return (f"{out} AS (SELECT {sel}, CASE WHEN t.__t AND u.__u THEN 'updated' WHEN u.__u THEN 'inserted' "
            f"ELSE 'kept' END AS action FROM (SELECT *, true AS __t FROM {target}) t "
            f"FULL OUTER JOIN (SELECT *, true AS __u FROM {updates}) u ON {on})")


def artist_cache_ctes() -> str:
    """prev_artist_cache, artist_misses, artist_cache (merged)."""
    return ", ".join([
        covers(), prev_artist_answers(), parse_artist("prev_artist_resp", "prev_artist_parsed"),
        one_per_key("prev_artist_parsed", "prev_artist_cache", ["artist_name"], ARTIST_VALS),
        "artist_keys AS (SELECT DISTINCT artist_clean FROM plays WHERE artist_clean IS NOT NULL AND trim(artist_clean) <> '')",
        "artist_misses AS (SELECT k.artist_clean FROM artist_keys k ANTI JOIN "
        "(SELECT * FROM prev_artist_cache WHERE fetch_success) c ON k.artist_clean = c.artist_name)",
        artist_answers(),
        "artist_resp_miss AS (SELECT * FROM artist_resp SEMI JOIN artist_misses USING (artist_clean))",
        parse_artist("artist_resp_miss", "artist_upd_parsed"),
        one_per_key("artist_upd_parsed", "artist_updates", ["artist_name"], ARTIST_VALS),
        merge("prev_artist_cache", "artist_updates", "artist_cache", ["artist_name"], ARTIST_VALS),
    ])


def track_cache_ctes() -> str:
    return ", ".join([
        prev_track_answers(), parse_track("prev_track_resp", "prev_track_parsed"),
        one_per_key("prev_track_parsed", "prev_track_cache", ["artist_clean", "song_clean"], TRACK_VALS),
        "track_keys AS (SELECT DISTINCT artist_clean, song_clean FROM plays WHERE artist_clean IS NOT NULL "
        "AND trim(artist_clean) <> '' AND song_clean IS NOT NULL AND trim(song_clean) <> '')",
        "track_misses AS (SELECT k.* FROM track_keys k ANTI JOIN (SELECT * FROM prev_track_cache WHERE fetch_success) c "
        "ON k.artist_clean = c.artist_clean AND k.song_clean = c.song_clean)",
        track_answers(),
        "track_resp_miss AS (SELECT * FROM track_resp SEMI JOIN track_misses USING (artist_clean, song_clean))",
        parse_track("track_resp_miss", "track_upd_parsed"),
        one_per_key("track_upd_parsed", "track_updates", ["artist_clean", "song_clean"], TRACK_VALS),
        merge("prev_track_cache", "track_updates", "track_cache", ["artist_clean", "song_clean"], TRACK_VALS),
    ])


def enriched_artists_cte() -> str:
    return ("enr_a AS (SELECT p.*, CASE WHEN c.artist_lastfm IS NOT NULL AND c.artist_lastfm <> '' "
            "THEN c.artist_lastfm END AS e_artist_lastfm, CASE WHEN c.fetch_success THEN c.image_url END AS artist_image_url, "
            "CASE WHEN c.mbid IS NOT NULL AND c.mbid <> '' THEN c.mbid END AS artist_mbid "
            "FROM plays p LEFT JOIN artist_cache c ON p.artist_clean = c.artist_name)")
