"""Feistel sharding: a bijection, equal counts, gapless slots, reproducible."""

import zlib

import pytest
from fixtures import awkward_texts, documents, empty
from pyspark.sql import functions as F

from airwave.llm.sharding import feistel, permuted, shard


@pytest.mark.parametrize("a,b", [(1, 1), (3, 5), (10, 10), (32, 31)])
def test_feistel_is_a_permutation(spark, a, b):
    got = [r[0] for r in spark.range(a * b).select(feistel(F.col("id"), a, b, 7)).collect()]
    assert sorted(got) == list(range(a * b))
    if a * b > 50:
        assert got != list(range(a * b))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 1013])
def test_cycle_walking_stays_inside(spark, n):
    got = [r["place"] for r in permuted(spark.range(n), "id", n).collect()]
    assert sorted(got) == list(range(n))


def test_shards(spark):
    texts = awkward_texts() * 5
    docs = documents(spark, texts, clashing=True)
    rows = shard(docs, shards=8).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    sizes = [len(slots.get(k, ())) for k in range(8)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1
    again = shard(docs.repartition(7), shards=8).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = shard(documents(spark, ["a", "a", None, "b"], [None, None, 3, 3]), shards=2).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert shard(empty(spark)).count() == 0
