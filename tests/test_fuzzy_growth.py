"""The similarity join at growing size: key meetings, hot keys, refinement, delta joins, components."""

import random

import pytest
from pyspark.sql import functions as F

from airwave.operators import cluster, fuzzy, normalize
from airwave.operators.fuzzy import candidate_pairs, key_sizes, similar_pairs
from properties import check_groups, near

PARTS = ["ba", "lo", "ring", "ten", "sa", "mu", "rod", "ka", "vel", "dor", "ni", "sh", "est", "gra", "pol", "um", "ix", "ter",
         "hew", "jo"]


def many_names(seed, n):
    """Names of two or three made-up words, a third with the same long credit, a fifth spelled once more with an error."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(PARTS) for _ in range(rng.choice([2, 2, 3]))) for _ in range(3000)]
    out = set()
    while len(out) < n:
        w = " ".join(rng.choice(words) for _ in range(rng.choice([2, 2, 3])))
        if rng.random() < 1 / 3:
            w += " feat. the northern lights"
        out.add(w)
        if rng.random() < 0.2:
            i = rng.randrange(len(w))
            out.add(w[:i] + rng.choice(["", "x", "a"]) + w[i + 1:])
    return sorted(out)[:n]


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def brute(names, t):
    return {(min(a, b), max(a, b)) for i, a in enumerate(names) for b in names[i + 1:] if near(a, b, t)}


def found(df, t, **kw):
    return {(r.a, r.b) for r in similar_pairs(df, t, **kw).collect()}


def test_heavy_keys_are_split(spark, monkeypatch):
    """A third of the names share a credit; no key holds more than a bound well above HEAVY after refinement."""
    monkeypatch.setattr(fuzzy, "HEAVY", 60)
    names = frame(spark, many_names(1, 800)).repartition(8)
    assert key_sizes(names, 90.0).agg(F.max("names")).first()[0] <= 150


@pytest.mark.parametrize("heavy,families", [(3, "segments"), (3, "letters")])
def test_refinement_loses_nothing(spark, monkeypatch, heavy, families):
    monkeypatch.setattr(fuzzy, "HEAVY", heavy)
    if families:
        picked = (0, 0) if families == "segments" else (2, 2)
        monkeypatch.setattr(fuzzy, "chosen_families", lambda rows, shapes: [
            (k, picked[0] and k + picked[0], picked[1]) for k in range(1, fuzzy.LETTER_EDITS + 1)])
    rng = random.Random(heavy)
    names = many_names(heavy, 150) + [f"same words here {rng.randrange(10 ** k)}" for k in range(1, 6) for _ in range(8)]
    names = sorted(set(names))
    assert found(frame(spark, names), 90.0) == brute(names, 90.0)


def test_delta_join(spark):
    names = many_names(5, 120)
    old, new = names[::3] + names[1::3], names[2::3]
    pairs = found(frame(spark, old), 85.0) | found(frame(spark, old), 85.0, fresh=frame(spark, new))
    assert pairs == brute(names, 85.0)
    assert not [p for p in found(frame(spark, old), 85.0, fresh=frame(spark, new)) if not set(p) & set(new)]
    assert candidate_pairs(frame(spark, old), 85.0, fresh=frame(spark, [])).count() == 0


def test_components(spark):
    chain = [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(200)] + [("x", "y"), ("y", "z"), ("q", "p")]
    both = spark.createDataFrame(chain + [(b, a) for a, b in chain], "u string, v string")
    got = {r.node: r.root for r in cluster.components(both).collect()}
    assert got == {**{f"n{k:03d}": "n000" for k in range(201)}, **dict.fromkeys("xyz", "x"), "q": "p", "p": "p"}


@pytest.mark.parametrize("small", [256, 3])
def test_folds_and_rounds_agree(spark, monkeypatch, small):
    monkeypatch.setattr(cluster, "SMALL", small)
    rng = random.Random(11)
    names = [n for n in many_names(2, 60)] + [f"long chain number {'ab' * k}" for k in range(12)]
    artists = [(n, rng.randint(1, 9)) for n in sorted(set(names))]
    _, matches = cluster.fuzzy_map(spark.createDataFrame(artists, "name string, play_count long"), 85.0)
    check_groups(artists, {r.original_name: (r.canonical_name, r.similarity_score) for r in matches.collect()}, 85.0)


def test_sweep_joins_names_once(spark, monkeypatch):
    calls = []
    plain = normalize.similar_pairs
    monkeypatch.setattr(normalize, "similar_pairs", lambda names, t, **kw: calls.append(kw.get("fresh")) or plain(names, t, **kw))
    monkeypatch.setattr(cluster, "similar_pairs", None)
    rows = [("Guess Who", 5), ("Guess Whoo", 2), ("The Kinkss", 1), ("Red Rods", 4), ("Red Rodds", 3), ("Red Rood", 1)]
    records = spark.createDataFrame([(n,) for n, c in rows for _ in range(c)], "artist_clean string")
    for cumulative in (True,):
        got = normalize.threshold_sweep(records, cumulative=cumulative).collect()
        assert len([c for c in calls if c is None]) == 1
        assert {r.threshold for r in got} == {95.0, 90.0, 85.0}
        for t in (95.0, 90.0, 85.0):
            assert sum(r.play_count for r in got if r.threshold == t) == 16
