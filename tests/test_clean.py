"""Golden rows for the scalar cleaners, derived by hand from the rules."""

import pytest
from pyspark.sql import functions as F

from airwave.functions.clean import clean_artist, clean_song
from airwave.functions.timeparse import parse_time

ARTISTS = [
    (None, ""), ("", ""), ("   ", ""),
    ("'Beatles'", "The Beatles"),
    ("the who", "The Who"),
    ("Guess Who?", "Guess Who?"),
    ("Foo (Live) Bar", "Foobar"),
    ("Artist [Remaster] {x}", "Artist"),
    ("Santana ft. Rob Thomas", "Santana Feat. Rob Thomas"),
    ("Tom Petty w/ Stevie", "Tom Petty Feat. Stevie"),
    (".38 Special", "38 Special"),
    ("R.E.M.", "R. E. M"),
    ("10,000 Maniacs", "10, 000 Maniacs"),
    ("Panic! At The Disco", "Panic! at the Disco"),
    ("RAGE AGAINST THE MACHINE", "Rage Against The Machine"),
    ("rage against the machine", "Rage Against the Machine"),
    ("dj shadow", "DJ Shadow"),
    ("AC/DC", "Ac/dc"),
    ("McCartney", "Mccartney"),
    ("3RD EYE", "3rd Eye"),
    ("Foo – Bar", "Foo - Bar"),
    ("Foo  Bar", "Foo Bar"),
]

SONGS = [
    (None, ""),
    ("Sweet Emotion (LIVE)", "Sweet Emotion"),
    ("Layla (acoustic) (live)", "Layla"),
    ("Layla (live) (acoustic)", "Layla (live)"),
    ("Wonderwall [Remastered]", "Wonderwall [remastered]"),
    ("Dancing With Myself", "Dancing feat. Myself"),
    ("Money: That's what I want", "Money: That's What I Want"),
    ("Sympathy for the devil", "Sympathy for the Devil"),
    ("Stand Up", "Stand up"),
    ("Born in the U.S.A.", "Born in the U. S. A"),
    ("Animal VS Human", "Animal vs Human"),
    ("...Baby", "Baby"),
    ("Song (live) (Live) (LIVE)", "Song"),
]

TIMES = [
    ("2023-01-01 12:30:45", 1672576245), ("01/01/2023 12:30:45", 1672576245),
    ("1/2/2023 1:30:45 PM", 1672666245),
    ("2023-01-01 12:30", 1672576200), ("01/01/2023 12:30", 1672576200),
    ("2023-01-01", 1672531200), ("01/01/2023", 1672531200),
    ("1402943314", 1402943314), ("1402943314.9", 1402943314), ("-1.7", -1),
    ("3000000000", 3000000000), ("1_000", 1000), ("  2023-01-01  12:30  ", 1672576200),
    ("2023-02-30", None), ("abc", None), ("nan", None), ("23-01-01", None), (None, None),
    ("inf", None), ("1d", None), ("12f", None), ("", None),
]


def _run(spark, rows, fn, typ="string"):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], f"i int, x {typ}")
    got = {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    return [(rows[i][0], got[i], rows[i][1]) for i in range(len(rows))]


@pytest.mark.parametrize("kind", ["artist", "song", "time"])
def test_goldens(spark, kind):
    rows, fn = {"artist": (ARTISTS, clean_artist), "song": (SONGS, clean_song),
                "time": (TIMES, parse_time)}[kind]
    bad = [(x, got, want) for x, got, want in _run(spark, rows, fn) if got != want]
    assert not bad, bad
