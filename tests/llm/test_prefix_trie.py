"""Prefix trie against a plain dictionary of prefixes, with small shards and cut conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from airwave.llm import prefix_trie
from airwave.llm.queries import ORACLES, REGISTRY

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(conversations: dict) -> list:
    """Every node of {conv_id: [(role, text), ...]}."""
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv in sorted(conversations):
        path = tuple(conversations[conv])
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
            if d:
                kids[path[:d - 1]].add(path[:d])
        ends[path].append(conv)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        gain = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += gain
    return sorted([(members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), leaves[p],
                    saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p in members], key=str)


def in_order(rows) -> dict:
    """Rows of the table, brought into order by the rules of the operator."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out[conv].append(((turn is not None, turn or 0, role, text[:64], digest), (role, text)))
    return {c: [t for _, t in sorted(v)] for c, v in out.items()}


def rows_of(nodes) -> list:
    return sorted(map(tuple, nodes.select(*COLUMNS).collect()), key=str)


def talk(seed: int, convs: int) -> list:
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = 90 if c in (7, 8) else rng.choice([1, 1, 2, 3, 4, 6])
        for k in range(n):
            rows.append((c * 3, k, "user" if k % 2 else "bot", "same" if k == 0 and c % 3 else f"é{rng.randrange(3 if k < 60 else 1)}"))
    rng.shuffle(rows)
    return rows


AWKWARD = [(None, 1, "user", "lost"), (5, None, None, None), (5, 1, "", ""), (5, 1, "", ""), (6, None, "", ""), (6, 1, "", ""),
           (-7, 2, "user", "x" * 200_000), (-7, 1, "user", "first"), (9, 3, "user", "tie b"), (9, 3, "user", "tie a"),
           (10, 1, "user", "tie a"), (10, 2, "user", "tie b"), (11, 1, "use", "rtie"), (12, 1, "user", "tie")]


@pytest.mark.parametrize("convs,rows,parts", [(4096, 65536, 8), (3, 7, 8), (1, 2, 5), (5, 4, 40)])
def test_shards_and_cuts(spark, monkeypatch, convs, rows, parts):
    monkeypatch.setattr(prefix_trie, "SHARD_CONVS", convs)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", rows)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        table = talk(convs, 60)
        got = prefix_trie.prefix_trie(spark.createDataFrame(table, SCHEMA))
        assert rows_of(got.nodes) == brute(in_order(table))
        listed = [c for r in got.ends.collect() for c in r["conv_ids"]]
        assert sorted(listed) == sorted(in_order(table))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_awkward_rows(spark):
    table = spark.createDataFrame(AWKWARD, SCHEMA).selectExpr("*", "'x' AS `key`", "1 AS place", "2 AS shard", "3 AS digest")
    assert rows_of(prefix_trie.prefix_trie(table).nodes) == brute(in_order(AWKWARD))
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).nodes.count() == 0


@pytest.mark.parametrize("table", [AWKWARD, talk(3, 80), []])
def test_query_rebuilds(spark, tmp_path, table):
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    given, rebuilt = in_order(table), {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 9
        lender = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = given.get(lender, [])[:h] + own[h:]
    got = rows_of(REGISTRY["op11_prefix_trie"](spark, str(tmp_path)))
    assert got == brute(rebuilt)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = con.execute(ORACLES["op11_prefix_trie"])
    order = [[d[0] for d in found.description].index(c) for c in COLUMNS]
    assert sorted([tuple(r[k] for k in order) for r in found.fetchall()], key=str) == got
