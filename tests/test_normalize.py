"""Name matching: LCS, blocking, grouping by its properties, renames, the whole normaliser."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from airwave.functions.similarity import with_lcs
from airwave.operators import normalize
from airwave.operators.cluster import fuzzy_map
from airwave.operators.fuzzy import candidate_pairs, similar_pairs
from properties import check_groups, check_renames, common, near, score


def test_score_goldens():
    assert score("hot gear", "hot ring") == 62.5
    assert round(score("red rod", "redd rod"), 2) == 93.33
    assert round(score("red rod", "red rot"), 2) == 85.71


def test_native_lcs_at_any_length(spark):
    rng = random.Random(5)
    rows = [("".join(rng.choice("abcde") for _ in range(rng.randint(0, n))),
             "".join(rng.choice("abcde") for _ in range(rng.randint(0, n)))) for n in (8, 62, 63, 70, 200) for _ in range(40)]
    rows += [("a" * 62, "a" * 62), ("a" * 63, "a" * 63), ("ab" * 62, "ba" * 62), ("x" * 130, "y" * 130)]
    for r in with_lcs(spark.createDataFrame(rows, "a string, b string"), "a", "b").collect():
        assert r.lcs == common(r.a, r.b), (r.a, r.b)


def _names(rng, n):
    words = ["red", "rod", "hot", "gear", "ring", "blue", "bolt", "the", "a", "gizmo", "feat. brand#12"]
    out = set()
    while len(out) < n:
        w = " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 3, 7])))
        for _ in range(3):
            if w.strip():
                out.add(w)
            i = rng.randrange(len(w)) if w else 0
            w = w[:i] + rng.choice(["", "x", "a"]) + w[i + 1:]
    return sorted(out)


@pytest.mark.parametrize("t", [101.0, 100.0, 95.0, 90.0, 75.0, 60.0, 20.0])
def test_blocking_is_lossless_at_any_threshold(spark, t):
    names = _names(random.Random(int(t)), 90) + ["z" * 70, "z" * 69 + "y", "z" * 140]
    brute = {(min(a, b), max(a, b)) for i, a in enumerate(names) for b in names[i + 1:] if near(a, b, t)}
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert {(r.a, r.b) for r in similar_pairs(df, t).collect()} == brute


def test_common_parts_do_not_make_candidates(spark):
    """Names that share a long credit are candidates only if the rest of their letters nearly agrees."""
    rng = random.Random(4)
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) + " feat. somebody" for _ in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert candidate_pairs(df, 90.0).count() < 0.05 * 400 * 399 / 2


FIXTURE_CASES = [
    ([("Eagles", 9), ("The Eagles", 1)], {"eagles": "The Eagles"}),
    ([("Strokes", 9), ("The Strokes", 3)], {"the strokes": "Strokes"}),
    ([("Strokes", 3), ("The Strokes", 3)], {"strokes": "The Strokes"}),
    ([("Kinks", 5), ("Kinkss", 1)], {"kinks": "The Kinks", "kinkss": "The Kinks"}),
    ([("Metallica", 9), ("Metalica", 2)], {"metalica": "Metallica"}),
    ([("Rage Against The Machine", 5), ("Rage Against the Machine", 2)], {}),
    ([("aaaaaaaaaa", 9), ("aaaaaaaaab", 5), ("aaaaaaaabb", 1)], {"aaaaaaaaab": "aaaaaaaaaa"}),
    # The later centre is the earlier one in play order: the follower must wait for it.
    ([("Act 99 Alpha Beta Gamma", 9), ("Act 24 Alpha Beta Gamma", 8), ("Act 7 Alpha Beta Gamma", 7),
      ("Act 2 Alpha Beta Gamma", 1)], None),
]


def _records(spark, artists):
    return spark.createDataFrame([(n,) for n, c in artists for _ in range(c)], "artist_clean string")


def _spark_map(spark, artists, t):
    return {r.old_key: r.new_name for r in normalize.normalize_artists(_records(spark, artists), t).mapping.collect()}


def _matches(spark, artists, t):
    _, matches = fuzzy_map(spark.createDataFrame(artists, "name string, play_count long"), t)
    return {r.original_name: (r.canonical_name, r.similarity_score) for r in matches.collect()}


@pytest.mark.parametrize("artists,expected", FIXTURE_CASES)
def test_fixture_mappings(spark, artists, expected):
    if expected is not None:
        assert _spark_map(spark, artists, 90.0) == expected
    check_groups(artists, _matches(spark, artists, 90.0), 90.0)


@pytest.mark.parametrize("t", [90.0, 80.0, 60.0])
def test_groups_have_their_properties(spark, t):
    rng = random.Random(int(t))
    names = [n for n in _names(rng, 70) if not n.startswith("the ")]
    artists = [(n, rng.randint(1, 6)) for n in names] + [(n.upper(), 1) for n in names[:3]]
    check_groups(artists, _matches(spark, artists, t), t)


def test_nothing_matches_above_100(spark):
    artists = [("Same Name", 2), ("same name", 1), ("Samename", 1)]
    assert _matches(spark, artists, 101.0) == {} and _spark_map(spark, artists, 101.0) == {}


def test_stacked_the_names_end_in_one_artist(spark):
    artists = [("The " * k + "Zed", 20 - k) for k in range(13)]
    out = normalize.normalize_artists(_records(spark, artists), None).records
    assert [(r[0], r[1]) for r in out.groupBy("artist_clean").count().collect()] == [("Zed", sum(c for _, c in artists))]


def test_renames_that_lead_to_each_other(spark):
    artists = [("The Keepers of the Flame", 5), ("Keepers of the Flame", 3), ("The Keepers Of The Flame", 1)]
    result = normalize.normalize_artists(_records(spark, artists), 90.0)
    assert [r["count"] for r in result.records.groupBy("artist_clean").count().collect()] == [9]
    check_renames({r.old_key: r.new_name for r in result.mapping.collect()})
    assert result.metrics()["plays_renamed"] == 9


def test_plays_names_have_their_properties(spark):
    from airwave.sources import derived

    records = derived.plays(spark, "/root/testdata/sf0.001", "artist_clean")
    result = normalize.normalize_artists(records, 90.0)
    mapping = {r.old_key: r.new_name for r in result.mapping.collect()}
    check_renames(mapping)
    # normalising changes spellings only where the map says so, and a second pass renames nothing more
    again = normalize.apply_mapping(result.records.drop("renamed").withColumn("once", F.col("artist_clean")), result.mapping)
    assert again.where("artist_clean <> once").count() == 0
    artists = normalize.artist_counts(records)
    left = [(r.name, r.play_count) for r in normalize.remaining_after(artists, result.the_map).collect()]
    check_groups(left, {r.original_name: (r.canonical_name, r.similarity_score) for r in result.matches.collect()}, 90.0)


def test_runs_from_another_folder(tmp_path):
    """No part of the matcher needs the package on the executors."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from airwave.session import get_session\n"
            "import __spark_entry__ as E\n"
            "spark = get_session('elsewhere', master='local[2]', shuffle_partitions=4)\n"
            "print('rows', E.queries()['normalize_map'](spark, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
