"""The bucketed cache: only touched buckets are rewritten, certain misses skip the join, results as a plain MERGE."""

import os
import tempfile

from pyspark.sql import functions as F

from airwave import schemas
from airwave.operators import merge
from airwave.operators.cache import CacheTable
from airwave.plans import metadata

COLUMNS = "artist_name string, artist_lastfm string, image_url string, mbid string, fetch_success boolean, error_message string"


def _cache(spark, n=400):
    rows = [(f"artist {k}", f"A{k}", f"u{k}", None, k % 3 > 0, None if k % 3 else "Artist not found") for k in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _table(spark, n=400):
    return metadata.stored_cache(_cache(spark, n), tempfile.mkdtemp(prefix="airwave-cache-"))


def test_one_key_rewrites_one_bucket(spark):
    table = _table(spark)
    before = _files(f"{table.path}/rows")
    assert len({os.path.dirname(f) for f in before}) == table.buckets
    after = table.upsert(spark.createDataFrame([("artist 7", "new", "u", "m", True, None)], COLUMNS), "action")
    changed = {os.path.dirname(f) for f in _files(f"{table.path}/rows").items() ^ before.items() for f in [f[0]]}
    assert len(changed) == 1
    got = {r.artist_name: r for r in after.collect()}
    assert len(got) == 400 and got["artist 7"].action == "updated" and got["artist 7"].artist_lastfm == "new"
    assert sum(r.action == "kept" for r in got.values()) == 399
    assert {r.artist_name: r.artist_lastfm for r in table.rows().collect()}["artist 7"] == "new"


def test_upsert_is_the_plain_merge(spark):
    table, old = _table(spark), _cache(spark)
    updates = spark.createDataFrame([(f"artist {k}", f"B{k}", None, "m", False, "API timeout") for k in range(390, 420)]
                                    + [(None, "nobody", None, None, True, None)], COLUMNS)
    values = old.columns[1:]
    want = merge.merge_by_key(old, updates, ["artist_name"], values, action_col="action").select(*old.columns, "action")
    got = table.upsert(updates, "action").select(*old.columns, "action")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, table.rows().select(*old.columns).collect())) == sorted(
        map(str, want.drop("action").collect()))
    assert table.upsert(updates.limit(0)).count() == 421


def test_filter_has_no_false_misses_and_few_false_hits(spark):
    table = _table(spark, 3000)
    known = spark.createDataFrame([(f"artist {k}",) for k in range(3000)], "artist_name string")
    assert table.maybe(known).where("NOT maybe").count() == 0
    unknown = spark.createDataFrame([(f"band {k}",) for k in range(3000)], "artist_name string")
    assert table.maybe(unknown).where("maybe").count() < 60
    hits, misses = table.lookup(known.unionByName(unknown))
    assert hits.count() == 2000 and misses.count() == 4000
    table.upsert(spark.createDataFrame([("band 1", None, None, None, True, None)], COLUMNS))
    assert table.lookup(unknown)[0].count() == 1


def test_empty_table(spark):
    table = CacheTable(spark, tempfile.mkdtemp(prefix="airwave-cache-"), schemas.ARTIST_IMAGES, ["artist_name"], buckets=4)
    keys = spark.createDataFrame([("x",)], "artist_name string")
    hits, misses = table.lookup(keys)
    assert hits.count() == 0 and misses.count() == 1
    table.upsert(spark.createDataFrame([("x", "X", None, None, True, None)], COLUMNS))
    assert table.lookup(keys)[0].count() == 1


def test_only_touched_buckets_are_read(spark):
    table = _table(spark)
    plan = table.rows([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:80]
    assert table.rows([3]).where(table.bucket(["artist_name"]) != F.lit(3)).count() == 0
