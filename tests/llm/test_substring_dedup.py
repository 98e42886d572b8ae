"""Substring dedup against a brute-force walk over all windows."""

import tracemalloc

import pyarrow as pa
import pytest
from fixtures import awkward_texts, documents, empty, prose

from airwave.llm.substring_dedup import Block, dedup_substrings, longest_repeats, second_level


def brute(rows, size):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            window = tuple(words[k:k + size])
            if window in seen:
                gone[k:k + size] = [True] * size
            seen.add(window)
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


@pytest.mark.parametrize("size", [1, 5, 20])
def test_matches_brute_force(spark, size):
    texts = awkward_texts()
    # many small blocks and buckets, so that repeats lie across them
    got = dedup_substrings(documents(spark, texts, clashing=True), min_words=size, block_bytes=700, bucket_hashes=50)
    found = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()}
    assert found == brute(list(enumerate(texts)), size)
    assert got.select("row.*").columns[:5] == documents(spark, texts).columns


def test_hot_passage_costs_one_entry_per_block(spark):
    passage = prose(9, 30)
    texts = [f"{prose(100 + k, 8)} {passage} {prose(500 + k, 8)}" for k in range(300)]
    got = dedup_substrings(documents(spark, texts), min_words=20, block_bytes=4000)
    found = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()}
    assert found == brute(list(enumerate(texts)), 20)
    assert sum(v[1] for v in found.values()) >= 299 * 30


def test_null_and_repeated_ids(spark):
    text = prose(5, 40)
    got = dedup_substrings(documents(spark, [text, text, text, None], [None, 7, 7, None])).collect()
    assert sorted((r["row"]["doc_id"] or 99, r["n_removed"]) for r in got) == [(7, 0), (7, 40), (99, 0), (99, 40)]


def test_empty_table(spark):
    assert dedup_substrings(empty(spark)).count() == 0
    assert longest_repeats(empty(spark)).count() == 0


def test_doubling_goes_on_until_none_survives(spark):
    long, short = prose(11, 100, 5000), prose(12, 25, 5000)
    texts = [long, "x " + long + " y", short, prose(13, 50, 5000) + " " + short, prose(14, 30, 5000), None]
    got = longest_repeats(documents(spark, texts), min_words=10, block_bytes=300)
    assert {r["row"]["doc_id"]: r["longest_repeat"] for r in got.collect()} == {0: 80, 1: 80, 2: 20, 3: 20, 4: 0, 5: 0}


def test_block_holds_no_word_objects():
    text = prose(9, 100_000, 50_000)
    rows = pa.table({"row": pa.array([{"doc_id": 1, "text": text}])})
    tracemalloc.start()
    block = Block(rows, "doc_id", "text")
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(block.h) == 100_000 and held < len(text) + 30 * len(block.h)


def test_levels_work_piece_by_piece():
    text = prose(9, 500_000, 50_000)
    rows = pa.table({"row": pa.array([{"doc_id": 1, "text": text}])})
    block = Block(rows, "doc_id", "text")
    tracemalloc.start()
    found = second_level(block, 20, 1, {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not len(found.at) and peak < 40 * len(block.h)


def test_pieces_join_without_a_seam(monkeypatch):
    texts = [prose(k, 300, 40) for k in range(6)] + ["", "a b"]
    rows = pa.table({"row": pa.array([{"doc_id": k, "text": t} for k, t in enumerate(texts)])})
    whole = {n: second_level(Block(rows, "doc_id", "text"), n, 1, {}).at.tolist() for n in (1, 2, 5)}
    anchors = Block(rows, "doc_id", "text").anchors(20)
    monkeypatch.setattr("airwave.llm.substring_dedup.PIECE", 7)
    assert whole == {n: second_level(Block(rows, "doc_id", "text"), n, 1, {}).at.tolist() for n in (1, 2, 5)}
    assert [x.tolist() for x in Block(rows, "doc_id", "text").anchors(20)] == [x.tolist() for x in anchors]
