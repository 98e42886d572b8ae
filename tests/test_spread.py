"""Steps that one small input file or a second pass over the plays would hold up."""

import pytest

from airwave.plans import registry
from airwave.sources import derived

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("made", [derived.previous_artist_responses, derived.previous_track_responses])
def test_previous_answers_are_made_in_all_partitions(spark, made):
    df = made(spark, SF)
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert df.count() == derived.table(spark, SF, "part").count()


def test_artist_lookups_need_no_second_pass(spark):
    rows = [("The A", "x", "A", "X"), ("The A", "y", "A", "Y"), ("The A", "x", "A", "X"), (None, None, "", ""), ("b", None, "B", "")]
    records = spark.createDataFrame(rows, "raw_artist string, raw_song string, artist_clean string, song_clean string")
    made = registry.Caches(spark, SF, records)
    assert sorted(map(str, made.artist_lookups.collect())) == sorted(map(str, records.select(
        "raw_artist", "artist_clean").distinct().collect()))
    assert "lookups" in vars(made)
