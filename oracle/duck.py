"""DuckDB SQL for the oracle side of every registered query.

The same derived tables and cleaning rules as the Spark code, written as
plain SQL over the driver's registered views.  Nothing is imported from the
package: the rules are the oracle's own (``oracle.fixed``).
"""

from __future__ import annotations

from oracle import fixed as rules


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _chain(expr: str, rule_list, options: str = "gi") -> str:
    for pattern, replacement in rule_list:
        expr = f"regexp_replace({expr}, {q(pattern)}, {q(replacement)}, {q(options)})"
    return expr


def prepare(col: str) -> str:
    s = f"coalesce({col}, '')"
    s = f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"
    s = f"regexp_replace({s}, {q(chr(94) + "['\"]+|['\"]+$")}, '', 'g')"
    return f"regexp_replace({s}, '\\s+', ' ', 'g')"


def strip_the(col: str) -> str:
    return f"CASE WHEN starts_with(lower({col}), 'the ') THEN substr(lower({col}), 5) ELSE lower({col}) END"


def cap(w: str) -> str:
    return f"(upper({w}[1]) || lower({w}[2:]))"


def _list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def force_the(col: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in rules.BANDS_WITH_THE.items())
    return f"coalesce(CASE {strip_the(col)} {cases} END, {col})"


def artist_title(ws: str) -> str:
    body = (f"CASE WHEN i = 1 OR i = len({ws}) THEN {cap('w')} "
            f"WHEN list_contains({_list(rules.ARTIST_LOWER_WORDS)}, lower(w)) AND w <> upper(w) THEN lower(w) "
            f"ELSE {cap('w')} END")
    return _chain(f"array_to_string(list_transform({ws}, lambda w, i: {body}), ' ')", rules.ARTIST_WORD_FIXES)


def song_title(ws: str) -> str:
    body = (f"CASE WHEN i = 1 THEN {cap('w')} "
            f"WHEN regexp_matches({ws}[i - 1], '[:!?.]') THEN {cap('w')} "
            f"WHEN list_contains({_list(rules.SONG_LOWER_WORDS)}, lower(w)) THEN lower(w) "
            f"ELSE {cap('w')} END")
    return _chain(f"array_to_string(list_transform({ws}, lambda w, i: {body}), ' ')", rules.SONG_WORD_FIXES)


NUMBER = rules.NUMBER_PATTERN


def parse_time(col: str) -> str:
    s = f"regexp_replace(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')"
    parts = [f"CAST(epoch(try_strptime({s}, {q(fmt)})) AS BIGINT)" for _, fmt in rules.TIME_FORMATS]
    numeric = (f"CASE WHEN regexp_full_match({s}, {q(NUMBER)}) "
               f"THEN TRY_CAST(trunc(TRY_CAST(replace({s}, '_', '') AS DOUBLE)) AS BIGINT) END")
    return f"CASE WHEN {s} <> '' THEN coalesce({', '.join(parts)}, {numeric}) END"


def clean_ctes(src: str, out: str, artist_cols=(), song_cols=(), keep="*") -> str:
    """CTE chain: ``out`` = ``src`` plus cleaned columns.

    ``artist_cols`` / ``song_cols``: pairs (input column, output column).
    """
    a1 = ", ".join([f"{_chain(prepare(i), rules.ARTIST_RULES)} AS {o}__1" for i, o in artist_cols]
                   + [f"{_chain(prepare(i), rules.SONG_RULES)} AS {o}__1" for i, o in song_cols])
    a2 = ", ".join([f"string_split(trim({force_the(o + '__1')}), ' ') AS {o}__w" for _, o in artist_cols]
                   + [f"string_split(trim({o}__1), ' ') AS {o}__w" for _, o in song_cols])
    a3 = ", ".join([f"{artist_title(o + '__w')} AS {o}" for _, o in artist_cols]
                   + [f"{song_title(o + '__w')} AS {o}" for _, o in song_cols])
    drop = ", ".join([f"{o}__1, {o}__w" for _, o in list(artist_cols) + list(song_cols)])
    return (f"{out}__s1 AS (SELECT {keep}, {a1} FROM {src}), "
            f"{out}__s2 AS (SELECT *, {a2} FROM {out}__s1), "
            f"{out} AS (SELECT * EXCLUDE ({drop}), {a3} FROM {out}__s2)")


RAW_PLAYS = """
raw_plays AS (
SELECT CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS play_key,
  CASE l_orderkey % 19
    WHEN 0 THEN concat('The ', p_name)              WHEN 1 THEN upper(p_name)
    WHEN 2 THEN concat(p_name, ' FT. ', p_brand)    WHEN 3 THEN concat('"', p_name, '"')
    WHEN 4 THEN concat('  ', p_name, ' (Live)')
    WHEN 5 THEN concat(substring(p_name, 1, 4), substring(p_name, 4))
    WHEN 6 THEN concat(substring(p_name, 1, 3), substring(p_name, 5))
    WHEN 7 THEN CASE WHEN l_linenumber = 1 THEN NULL ELSE p_name END
    WHEN 8 THEN concat('The The ', p_name)          WHEN 9 THEN concat(p_name, ' [Remaster] {x}')
    WHEN 10 THEN concat('...', p_name, ' ', chr(8211), ' duo..')
    WHEN 11 THEN concat('dj ', p_name, ' ,ok;yes:no!now?')
    WHEN 12 THEN CASE p_size % 6 WHEN 0 THEN 'beatles' WHEN 1 THEN 'the beatles' WHEN 2 THEN 'kinks'
                 WHEN 3 THEN 'kinkss' WHEN 4 THEN 'Guess Who' ELSE 'THE CLASH' END
    WHEN 13 THEN concat('The ', p_name, ' of the sea')
    WHEN 14 THEN concat(p_name, ' of the sea')
    WHEN 15 THEN upper(concat('The ', p_name, ' of the sea'))
    WHEN 16 THEN CASE WHEN starts_with(p_name, 'hot ')
                 THEN concat(p_name, ' and the long winded travelling orchestra of the northern provinces') ELSE p_name END
    ELSE p_name END AS raw_artist,
  concat(lower(p_type), CASE l_linenumber % 5 WHEN 0 THEN ' with a twist' WHEN 1 THEN ' (Acoustic)'
    WHEN 2 THEN ': the end' WHEN 3 THEN ' VS night' ELSE '' END,
    CASE l_orderkey % 9 WHEN 0 THEN ' (Radio Edit)' WHEN 1 THEN ' feat. dj x' WHEN 2 THEN '...'
    WHEN 3 THEN ' [Mix] (remix)' WHEN 4 THEN concat(' ', chr(8212), ' ''the'' end, of it') ELSE '' END) AS raw_song,
  CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE concat('K', CAST(l_suppkey AS VARCHAR)) END AS callsign,
  CASE l_linenumber % 6
    WHEN 0 THEN substring(CAST(l_shipdate AS VARCHAR), 1, 10)
    WHEN 1 THEN concat(substring(CAST(l_shipdate AS VARCHAR), 1, 10), ' 12:30:45')
    WHEN 2 THEN concat(substring(CAST(l_shipdate AS VARCHAR), 6, 2), '/', substring(CAST(l_shipdate AS VARCHAR), 9, 2), '/', substring(CAST(l_shipdate AS VARCHAR), 1, 4), ' 01:30:45 PM')
    WHEN 3 THEN concat(substring(CAST(l_shipdate AS VARCHAR), 6, 2), '/', substring(CAST(l_shipdate AS VARCHAR), 9, 2), '/', substring(CAST(l_shipdate AS VARCHAR), 1, 4), ' 07:05')
    WHEN 4 THEN CAST(1400000000 + l_orderkey AS VARCHAR)
    ELSE 'unknown' END AS raw_time,
  CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE CAST(l_quantity * 9 AS INT) END AS track_duration,
  CASE l_partkey % 5 WHEN 0 THEN 'None' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE upper(p_name) END AS artist_lastfm,
  l_linenumber = 1 AS first_play
FROM lineitem JOIN part ON p_partkey = l_partkey)"""


def plays_ctes() -> str:
    """``WITH``-list body defining ``plays`` (raw plays + clean columns + time_unix)."""
    return (RAW_PLAYS + ", "
            + clean_ctes("raw_plays", "plays_c", [("raw_artist", "artist_clean")], [("raw_song", "song_clean")])
            + f", plays AS (SELECT *, {parse_time('raw_time')} AS time_unix FROM plays_c)")


def with_plays(select: str, extra_ctes: str = "") -> str:
    return "WITH " + plays_ctes() + (", " + extra_ctes if extra_ctes else "") + "\n" + select
