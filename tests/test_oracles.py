"""Every query with an oracle matches DuckDB at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
import oracle_harness as H

SF = "/root/testdata/sf0.01"
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return H.duck(SF)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, con, name):
    r = H.compare(spark, name, SF, con)
    assert r["ok"], r["problems"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert "total_listening_time" in df.columns
