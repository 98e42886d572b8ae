"""Nearest neighbours against a full distance matrix."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airwave.llm.ann import Coded, int8_products, nearest, tile

SCHEMA = "vec_id long, embedding array<float>, label int, ids string, v string, dim string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def brute(rows, is_query, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if is_query(q):
            found = sorted((float(np.sqrt(np.cumsum((x - y) ** 2)[-1])), c) for c, y in good
                           if c != q and len(y) == len(x))
            for r, (s, c) in enumerate(found[:k], 1):
                out[q, r] = (c, s)
    return out


def rows_of(n, dim, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("dim", [3, 64])
def test_matches_brute_force_over_many_tiles(spark, dim):
    rows = rows_of(400, dim)
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1002, [0.0] * dim), (1003, None), (1004, [math.nan] * dim),
             (1005, [None] * dim), (None, rows[1][1]), (1006, [math.inf] + [1.0] * (dim - 1)), (1007, []),
             (1100, [1.0] * (dim + 1)), (1200, [2.0] * (dim + 1)), (1300, [1e30] + [1.0] * (dim - 1))]
    got = nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, 10, query_block=3, candidate_block=40)
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got.collect()}
    assert found == brute(rows, lambda i: i % 50 == 0, 10)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [2.0, 0.0]) for i in range(40, 0, -1)]
    got = nearest(frame(spark, rows), F.col("vec_id") == 0, 5, candidate_block=7).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 5]


def test_few_candidates_and_empty_table(spark):
    got = nearest(frame(spark, [(0, [1.0]), (7, [3.0])]), F.col("vec_id") % 100 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 7, 2.0)]
    assert nearest(frame(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_hold_and_prune():
    x = np.random.default_rng(4).standard_normal((600, 32))
    query, other = Coded(np.arange(20).tobytes(), x[:20].tobytes(), 32), Coded(
        np.arange(20, 600).tobytes(), x[20:].tobytes(), 32)
    assert (int8_products(query.code, other.code) == query.code.astype(int) @ other.code.astype(int).T).all()
    kept = {i: dict(zip(ids.tolist(), score)) for i, ids, score in tile(query, other, 10)}
    for i in range(20):
        d = np.sqrt(((x[i] - x[20:]) ** 2).sum(axis=1))
        assert {20 + int(j) for j in np.argsort(d)[:10]} <= kept[i].keys()
        assert len(kept[i]) < 60


def test_repeated_rows_hide_no_neighbour(spark):
    rows = rows_of(60, 8)
    once = nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 10).collect()
    many = nearest(frame(spark, rows * 5 + rows[:30] * 9), F.col("vec_id") % 20 == 0, 10, candidate_block=50).collect()
    assert len(once) == 30 and sorted(many) == sorted(once)


def test_vectors_under_one_id(spark):
    rows = [(0, [0.0, 1.0]), (0, [9.0, 1.0]), (1, [1.0, 1.0]), (1, [8.0, 1.0]), (2, [4.0, 1.0])]
    got = nearest(frame(spark, rows), F.col("vec_id") == 0, 2, candidate_block=2)
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == [
        (1, 1, 1.0), (1, 1, 1.0), (2, 2, 4.0), (2, 2, 5.0)]


def test_distances_beyond_double_precision_drop_none():
    x = np.random.default_rng(5).standard_normal((40, 4)) * 1e200
    block = Coded(np.arange(40).tobytes(), x.tobytes(), 4)
    assert {i: len(ids) for i, ids, _ in tile(block, block, 10)} == dict.fromkeys(range(40), 39)


def test_tile_groups_meet_in_all_partitions(spark):
    rows = rows_of(300, 6)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        got = nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, 10, query_block=2, candidate_block=8).collect()
    finally:
        spark.conf.unset(name)
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got} == brute(rows, lambda i: i % 10 == 0, 10)
