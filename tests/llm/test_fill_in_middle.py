"""Fill-in-middle: searches against plain sums, exact outputs and exact restoration."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
import regex
from fixtures import awkward_texts, documents, empty
from pyspark.sql import functions as F

from airwave.llm.fill_in_middle import SkipList, check_marks, fill_in_middle, restore, unit_widths
from airwave.llm.queries import ORACLES, REGISTRY

TEXTS = awkward_texts() + ["<", "a<P", "x<P>y", "<S", "<M>", "🙂é́" * 40, "\x00\n\t", "<<<P<<" * 9, "long 🙂 " * 40_000]


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 300, 5000])
def test_every_rank(n):
    widths = np.array([random.Random(n).randrange(0, 9) for _ in range(n)], np.int64)
    places, found = np.concatenate([[0], np.cumsum(widths)]), SkipList(widths)
    assert [found.seek(k) for k in range(n + 1)] == places.tolist()
    steps = sum(len(lane[1]) for lane in found.lanes[1:])
    assert steps <= n // 4 + 16


def test_units():
    assert unit_widths("a🙂", None).tolist() == [1, 1]
    assert unit_widths("  ab cd\n", r"\S+").tolist() == [5, 3]
    assert unit_widths("   ", r"\S+").tolist() == [3] and unit_widths("", r"\S+").tolist() == []
    for bad in (("aa", "<S>", "<M>"), ("<P>", "<P>x", "<M>"), ("", "<S>", "<M>"), ("ab", "bc", "de")):
        with pytest.raises(ValueError):
            check_marks(bad)


@pytest.mark.parametrize("unit", [None, r"\X", r"\w+|\W"])
def test_forms_and_restoration(spark, unit):
    docs = documents(spark, TEXTS, clashing=True)
    made = fill_in_middle(docs, F.col("doc_id") * 7919 + 3, F.col("doc_id") * 104_729 + 11, F.col("doc_id") % 5 == 4,
                          F.when(F.col("doc_id") > 0, F.col("doc_id") % 2 == 0), unit=unit)
    got = made.withColumn("restored", restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        i = r["row"]["doc_id"]
        text = TEXTS[i] or ""
        units = list(text) if unit is None else regex.findall(unit, text)
        assert "".join(units) == text and r["n"] == len(units) and r["restored"] == text
        x, y = sorted(((i * 7919 + 3) % (len(units) + 1), (i * 104_729 + 11) % (len(units) + 1)))
        pre, mid, suf = ("".join(u) for u in (units[:x], units[x:y], units[y:]))
        if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or i % 5 == 4:
            assert (r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) == ("plain", text, None, None)
        else:
            spm = i > 0 and i % 2 == 0
            assert r["form"] == ("spm" if spm else "psm") and (r["prefix_chars"], r["middle_chars"]) == (len(pre), len(mid))
            assert r["output"] == (f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}")
    assert fill_in_middle(empty(spark), F.lit(1), F.lit(2), F.lit(False), F.lit(False)).count() == 0


def test_query_on_awkward_rows(spark, tmp_path):
    ids = [None, -4, *range(100, 100 + len(TEXTS) - 3), 100]
    documents(spark, TEXTS, ids).write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["op12_fill_in_middle"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(ORACLES["op12_fill_in_middle"])
    rows = got.select(*[d[0] for d in found.description]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(found.fetchall(), key=str)
    texts = {hashlib.sha256((t or "").encode()).hexdigest() for t in TEXTS}
    assert {r["restored_sha256"] for r in rows} == texts
