"""Sources, sinks, shaping, merge and the pipeline pieces."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from airwave import schemas
from airwave.operators import merge, shape
from airwave.plans import reports, sinks
from airwave.sources import tables


def _tmp():
    return tempfile.mkdtemp(prefix="airwave-test-")


def test_read_play_log_quotes_and_nulls(spark):
    d = _tmp()
    path = os.path.join(d, "log.txt")
    with open(path, "w") as f:
        f.write("RAW_SONG;RAW_ARTIST;CALLSIGN;TIME;UNIQUE_ID;COMBINED;First?\n")
        f.write('Layla (live);"Derek; the Dominos";KXYZ;2023-01-01;1;x;Y\n')
        f.write("Stand Up;;KABC;1402943314;2;y;N\n")
    df = tables.read_play_log(spark, path)
    rows = df.orderBy("UNIQUE_ID").collect()
    assert rows[0]["RAW_ARTIST"] == "Derek; the Dominos"
    assert rows[1]["RAW_ARTIST"] is None
    recs = shape.to_records(df)
    assert recs.columns[:10] == ["raw_song", "raw_artist", "song_clean", "artist_clean", "callsign", "time",
                                 "time_unix", "unique_id", "combined", "first_play"]
    got = {r.unique_id: (r.artist_clean, r.song_clean, r.time_unix) for r in recs.collect()}
    assert got["1"] == ("Derek; the Dominos", "Layla", 1672531200)
    assert got["2"] == ("", "Stand up", 1402943314)


def test_validate_and_describe(spark):
    df = spark.createDataFrame([("a", 1)], "raw_song string, x int")
    v = {r.column: r.present for r in shape.validate_columns(spark, df, ["raw_song", "raw_artist"]).collect()}
    assert v == {"raw_song": True, "raw_artist": False}
    d = tables.describe(spark, df).collect()
    assert [(r.column, r.type) for r in d] == [("raw_song", "string"), ("x", "int")]


def test_merge_by_key_upserts(spark):
    target = spark.createDataFrame([("a", "old", True), ("b", "keep", True)], "k string, v string, fetch_success boolean")
    updates = spark.createDataFrame([("a", None, False), ("c", "new", True)], "k string, v string, fetch_success boolean")
    out = merge.merge_by_key(target, updates, ["k"], ["v", "fetch_success"], action_col="action")
    got = {r.k: (r.v, r.fetch_success, r.action) for r in out.collect()}
    assert got == {"a": (None, False, "updated"), "b": ("keep", True, "kept"), "c": ("new", True, "inserted")}
    again = merge.merge_by_key(out.drop("action"), updates, ["k"], ["v", "fetch_success"])
    assert sorted(map(tuple, again.select("k", "v").collect()), key=str) == \
        sorted(map(tuple, out.select("k", "v").collect()), key=str)


def test_one_per_key_first_success_else_last(spark):
    df = spark.createDataFrame([("a", 1, False, "x"), ("a", 2, True, "y"), ("a", 3, True, "z"),
                                ("b", 1, False, "p"), ("b", 2, False, "q")],
                               "k string, seq int, fetch_success boolean, v string")
    got = {r.k: r.v for r in merge.one_per_key(df, ["k"], "seq").collect()}
    assert got == {"a": "y", "b": "q"}


def test_union_and_append(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "1")], "old_key string, new_name string")
    b = spark.createDataFrame([("y", "2")], "old_key string, new_name string")
    assert {r.old_key: r.new_name for r in merge.union_prefer_last(a, b, ["old_key"]).collect()} == {"x": "1", "y": "2"}
    c = spark.createDataFrame([("z",)], "old_key string")
    assert merge.append(a, c).where(F.col("new_name").isNull()).count() == 1


def test_save_and_exports(spark):
    d = _tmp()
    df = spark.createDataFrame([("A", "x"), ("B", None)], "artist_clean string, artist_lastfm string")
    res = sinks.save(df, f"{d}/t")
    assert res["saved"] and res["saved_records"] == 2 and res["success_rate"] == 100.0
    assert sinks.save(df.limit(0), f"{d}/t")["saved"] is False
    assert spark.read.parquet(f"{d}/t").count() == 2
    sinks.export_csv({"t": df}, d)
    assert spark.read.option("header", True).csv(f"{d}/t").count() == 2
    sinks.export_rollup(df, d)
    assert spark.read.option("header", True).csv(f"{d}/distinct_artists").count() == 2


def test_create_if_absent_and_reports(spark):
    d = _tmp()
    t = schemas.create_if_absent(spark, schemas.ARTIST_IMAGES, f"{d}/ai")
    assert t.count() == 0 and t.columns == [f.name for f in schemas.ARTIST_IMAGES.fields]
    recs = spark.createDataFrame([("x", "K1", 1)], "raw_artist string, callsign string, time_unix long")
    cache = spark.createDataFrame([("x", True)], "artist_name string, fetch_success boolean")
    rep = reports.explore(spark, recs, cache)
    assert rep["fetch_status"].collect()[0]["status"] == "Success"
    reports.register_views(spark, {"music_records": recs})
    assert spark.sql("SELECT count(*) AS n FROM music_records").first().n == 1


def test_squares(spark):
    from airwave.operators.stats import squares

    assert [r[0] for r in squares(spark.range(1, 5), "id").collect()] == [1, 4, 9, 16]


def test_dictionary_beyond_the_bound_matches_broadcast(spark):
    """Over the size bound the dictionary is joined by a shuffle; results must not change."""
    from airwave.functions.clean import clean_artist
    from airwave.operators.dictionary import map_distinct
    from airwave.sources import derived

    raw = derived.raw_plays(spark, "/root/testdata/sf0.001").select("play_key", "raw_artist")
    small = map_distinct(raw, ["raw_artist"], {"artist_clean": clean_artist("raw_artist")})
    big = map_distinct(raw, ["raw_artist"], {"artist_clean": clean_artist("raw_artist")}, max_rows=0)
    a = sorted(map(tuple, small.select("play_key", "artist_clean").collect()))
    b = sorted(map(tuple, big.select("play_key", "artist_clean").collect()))
    assert a == b and len(a) == raw.count()


def test_lookup_keys_skip_blanks_of_any_kind(spark):
    from airwave.operators.enrich import lookup_keys

    df = spark.createDataFrame([("b",), ("a",), ("",), (None,), ("\u00a0\t",), ("a",)], "artist_clean string")
    assert sorted(r[0] for r in lookup_keys(df, ["artist_clean"]).collect()) == ["a", "b"]


def test_rollup_files_are_in_order(spark):
    rows = [(f"A{k % 37:02d}", None) for k in range(900)]
    path = sinks.export_rollup(spark.createDataFrame(rows, "artist_clean string, artist_lastfm string"), _tmp())
    got = []
    for name in sorted(f for f in os.listdir(path) if f.startswith("part-")):
        with open(os.path.join(path, name)) as f:
            got += [line.strip().split(",")[:2] for line in f.readlines()[1:]]
    assert got == [[n, str(c)] for n, c in sorted(
        ((f"A{k:02d}", len(range(k, 900, 37))) for k in range(37)), key=lambda x: (-x[1], x[0]))]


def test_read_table_by_name_and_path(spark):
    d = _tmp()
    spark.range(3).write.parquet(f"{d}/t")
    assert tables.read_table(spark, f"{d}/t").count() == 3
    spark.read.parquet(f"{d}/t").createOrReplaceTempView("three")
    assert tables.read_table(spark, "three").count() == 3


def test_numeric_track_durations(spark):
    from airwave.sources.responses import parse_track_responses

    bodies = ['"215000"', "215000.5", '"215000.5"', "0", "999", "-5", "null", "1e6", '"0"', "true"]
    df = spark.createDataFrame([("a", "s", k, 200, '{"track":{"name":"x","duration":%s}}' % b)
                                for k, b in enumerate(bodies)],
                               "artist_clean string, song_clean string, seq int, status_code int, body string")
    got = {r.seq: r.duration for r in parse_track_responses(df).collect()}
    assert [got[k] for k in range(9)] == [215, 215, None, None, 0, None, None, 1000, None]


def test_no_jobs_for_columns_nobody_asked_for(spark, monkeypatch):
    from airwave.plans import registry
    from airwave import session

    made = []
    for module in ("airwave.operators.dictionary", "airwave.plans.registry", "airwave.operators.enrich"):
        monkeypatch.setattr(f"{module}.durable", lambda df: made.append(df) or session.durable(df))
    sf = "/root/testdata/sf0.001"
    for name in ("records_per_callsign", "distinct_raw_artists", "parse_coverage", "parse_time", "append_union"):
        registry.REGISTRY[name](spark, sf)
    assert made == []
    registry.REGISTRY["top_artists"](spark, sf)
    assert len(made) == 1


def test_pipeline_on_own_inputs(spark):
    from airwave.plans import metadata, pipeline

    log = spark.createDataFrame(
        [("Layla (live)", "clapton", "K1", "2023-01-01", "1", "x", "Y"), ("Layla", "CLAPTON", "K2", "0", "2", "y", "N"),
         ("Help", "the beatles", "K1", "bad", "3", "z", "N")], schemas.RAW_LOG)
    artist_cache = spark.createDataFrame([("The Beatles", "The Beatles", "img", "mb", True, None)],
                                         "artist_name string, artist_lastfm string, image_url string, mbid string, "
                                         "fetch_success boolean, error_message string")
    track_cache = schemas.empty(spark, schemas.TRACK_INFO)
    answers = spark.createDataFrame(
        [("Clapton", "clapton", "1", 200, '{"artist":{"name":"Eric Clapton","mbid":"m9","image":[{"#text":"e.png"}]}}'),
         ("The Beatles", "the beatles", "1", 500, None)],
        "artist_clean string, lookup_name string, seq string, status_code int, body string")
    tracks = spark.createDataFrame([("Clapton", "Layla", "1", 200, '{"track":{"name":"Layla","duration":"7000"}}')],
                                   "artist_clean string, song_clean string, seq string, status_code int, body string")
    covers = spark.createDataFrame([], "mbid string, status_code int, body string")
    d = _tmp()
    out = pipeline.run(log, metadata.Inputs(artist_cache, track_cache, answers, tracks, covers), 90.0, d)
    got = {r.unique_id: (r.artist_clean, r.artist_lastfm, r.artist_image_url, r.track_duration)
           for r in spark.read.parquet(f"{d}/music_records").collect()}
    assert got == {"1": ("Clapton", "Eric Clapton", "e.png", 7), "2": ("Clapton", "Eric Clapton", "e.png", 7),
                   "3": ("The Beatles", "The Beatles", "img", None)}
    assert out.statistics["summary"].first()["music_records_count"] == 3
    assert {r.artist_name: r.fetch_success for r in spark.read.parquet(f"{d}/artist_images").collect()} == {
        "Clapton": True, "The Beatles": True}
    assert out.statistics["top_listening_time"].first()["total_listening_seconds"] == 14


def test_broken_lines_are_kept_as_data(spark):
    from airwave.schemas import RAW_LOG

    d = _tmp()
    os.makedirs(f"{d}/log")
    lines = ["a;b;c;d;e;f;g", '"x;y";"say \\"hi\\"";;d;e;f;g', "a;b;c", "a;b;c;d;e;f;g;h", 'a;"b;c;d;e;f;g', '"a;b";c;d;e;f;g']
    with open(f"{d}/log/part.csv", "w") as f:
        f.write("\n".join([";".join(RAW_LOG.names), *lines]) + "\n")
    checked = tables.read_checked_log(spark, f"{d}/log")
    assert sinks.save_checked(checked, f"{d}/out") == {"kept": 2, "quarantined": 4}
    kept = sinks.read_checked(spark, f"{d}/out", checked.schema, "kept").select(*RAW_LOG.names).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(
        [tuple("abcdefg"), ("x;y", 'say "hi"', None, "d", "e", "f", "g")], key=str)
    bad = sinks.read_checked(spark, f"{d}/out", checked.schema, "quarantined")
    assert {r.line: r.reason for r in bad.collect()} == {
        lines[2]: "too few values", lines[3]: "too many values", lines[4]: "open quote", lines[5]: "too few values"}
    assert bad.where(F.coalesce(*[F.col(f"`{c}`") for c in RAW_LOG.names]).isNotNull()).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_by_arithmetic_is_the_parser(spark, zone):
    import random

    from airwave.functions import rules
    from airwave.functions.text import collapse_ws, py_strip
    from airwave.functions.timeparse import parse_time
    from test_clean import TIMES

    def by_format(c):
        """Each format tried in turn by Spark's parser, then a number."""
        s = collapse_ws(py_strip(F.col(c)))
        tried = [F.when(s.rlike(shape), F.unix_seconds(F.try_to_timestamp(s, F.lit(fmt))))
                 for (fmt, _), shape in zip(rules.TIME_FORMATS, rules.TIME_SHAPES)]
        number = F.when(s.rlike(rules.NUMBER_PATTERN), F.regexp_replace(s, "_", "").try_cast("double").try_cast("bigint"))
        return F.coalesce(*tried, number)

    rng = random.Random(3)
    texts = [t for t, _ in TIMES] + ["2023-02-29", "2024-02-29 23:59:59", "1900-2-29", "2000-2-29", "12/31/1999 12:00:00 am",
             "12/31/1999 00:00:00 PM", "1/1/2020 13:00:00 PM", "1/1/2020 1:00 PM", " 2020-01-01\t01:02 ", "2020/01/01", "1-1-2020",
             "2020-01-01 24:00:00", "2020-01-01 1:60", "2020-1-1 1:1:60", "1_000", "+5e3", "\u00a02021-01-01"]
    texts += [f"{rng.randint(1900, 2100)}-{rng.randint(0, 13)}-{rng.randint(0, 32)} {rng.randint(0, 25)}:{rng.randint(0, 61)}"
              for _ in range(200)]
    texts += [f"{rng.randint(0, 13)}/{rng.randint(0, 32)}/{rng.randint(1900, 2100)} {rng.randint(0, 13)}:{rng.randint(0, 61)}:"
              f"{rng.randint(0, 61)} {rng.choice(['am', 'PM', 'Am'])}" for _ in range(200)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        for r in df.select("t", parse_time("t").alias("got"), by_format("t").alias("want")).collect():
            assert r.got == r.want, r
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_reports_scan_the_records_once(spark, monkeypatch):
    from airwave.plans import reports

    d = _tmp()
    spark.createDataFrame([("K1", "a", "A", None, 1, 10), (None, None, None, None, None, None), ("K1", "b", "A", "AA", 2, 5)],
                          "callsign string, raw_artist string, artist_clean string, artist_lastfm string, time_unix long, "
                          "track_duration int").write.parquet(f"{d}/r")
    records = spark.read.parquet(f"{d}/r")
    plans = []
    plain = reports.durable
    monkeypatch.setattr(reports, "durable", lambda df: plans.append(df) or plain(df))
    cache = spark.createDataFrame([("A", True, 5)], "artist_name string, fetch_success boolean, duration int")
    got = {(r.section, r["rank"], r.item, r.metric): r.value for r in reports.statistics_report(records, cache, cache).collect()}
    assert got["top_listening_time", 1, "A", "seconds"] == 10 and got["bottom_artists", 2, "AA", "plays"] == 1
    assert got["top_artists", 1, "A", "plays"] == 2 and got["summary", None, None, "records"] == 3
    assert plans[0]._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    seen = {(r.section, r.item, r.metric): r.value for r in reports.exploration_report(records, cache).collect()}
    assert seen["callsign", None, "records"] == 1 and seen["summary", None, "distinct_raw_artists"] == 3
