"""SimHash: Golay keys lose no pair, fingerprints and components match brute force."""

import random

import numpy as np
import xxhash
from fixtures import awkward_texts, documents, empty, prose
from pyspark.sql import functions as F

from airwave.llm.graph import components
from airwave.llm.simhash import coset_patterns, fingerprint, fingerprints, golay_keys, linked, near_duplicates


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    least = {i: i for i in marks}
    changed = True
    while changed:
        changed = False
        for a, x in marks.items():
            for b, y in marks.items():
                if (x ^ y).bit_count() <= 4 and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def test_golay_patterns_cover_each_coset():
    found = (coset_patterns() >= 0).sum(axis=1)
    assert sorted(set(found.tolist())) == [1, 6] and (found == 1).sum() == 1 + 23 + 253


def test_keys_meet_within_four_bits():
    rng = random.Random(3)
    patterns = coset_patterns()
    for _ in range(400):
        a = rng.getrandbits(64)
        for bits in range(5):
            b = a
            for p in rng.sample(range(64), bits):
                b ^= 1 << p
            x, y = ([(k, c) for keys, _, centre in golay_keys(np.array([v], np.uint64), patterns)
                     for k, c in zip(keys.tolist(), centre.tolist())] for v in (a, b))
            assert {k for k, c in x if c} & {k for k, _ in y} and {k for k, c in y if c} & {k for k, _ in x}


def test_fingerprints(spark):
    texts = awkward_texts()
    got = {r["doc_id"]: r["fp"] % 2**64 for r in fingerprints(documents(spark, texts, clashing=True)).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert fingerprint(None, 4) == 0


def test_components_of_near_copies(spark):
    rng = random.Random(5)
    texts = awkward_texts()
    for k in range(40):  # a group of near copies: one word of a long text changes
        words = prose(77, 400).split()
        words[rng.randrange(400)] = f"new{k}"
        texts.append(" ".join(words))
    marks = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(spark, texts)).collect()}
    assert got == brute_components(marks)


def test_dense_and_chained_fingerprints(spark):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    ball = {centre ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 4))) for _ in range(150)}
    chain = [rng.getrandbits(64)]
    for k in range(12):
        chain.append(chain[-1] ^ (0b1111 << (4 * k)))
    marks = dict(enumerate([*sorted(ball), *chain, *(rng.getrandbits(64) for _ in range(100))]))
    signed = {i: x - (x >> 63 << 64) for i, x in marks.items()}
    roots = {r["fp"]: r["root"] for r in linked(
        spark.createDataFrame([(x,) for x in signed.values()], "fp long")).collect()}
    expected = brute_components(marks)
    groups, wanted = {}, {}
    for i in marks:
        groups.setdefault(roots[signed[i]], set()).add(i)
        wanted.setdefault(expected[i], set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = prose(1, 50)
    got = near_duplicates(documents(spark, [text, text, text, prose(2, 50)], [None, 4, 4, None])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [
        ("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    assert near_duplicates(empty(spark)).count() == 0


def test_components_on_a_long_path(spark):
    edges = spark.range(0, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(201)}
