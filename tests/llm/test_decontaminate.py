"""Decontamination: WAND equals exhaustive scoring, planted items are found, clean texts stay."""

import math
import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward_texts, documents, empty, prose

from airwave.llm import decontaminate
from airwave.llm.decontaminate import SLACK, Index, contaminated, passages, uncontaminated, words_of

ITEMS = "item_id long, text string, doc_id long, score double"


def index_of(items):
    frequency = Counter(w for _, t in items for w in set(words_of(t)))
    return Index(items, frequency, len(items), sum(len(words_of(t)) for _, t in items) / len(items))


def frame(spark, items):
    return spark.createDataFrame([(i, t, 0, 0.0) for i, t in items], ITEMS)


@pytest.mark.parametrize("vocabulary", [12, 60, 600])
def test_wand_retrieves_all_above_any_threshold(vocabulary):
    index = index_of([(i, prose(i, 4 + i % 40, vocabulary)) for i in range(150)])
    rng = random.Random(1)
    for _ in range(150):
        terms = rng.sample(range(len(index.vocabulary)), min(len(index.vocabulary), rng.randint(1, 60)))
        scores = [math.fsum(x for t in terms for i, x in zip(index.items[t], index.impact[t]) if i == n)
                  for n in range(len(index.ids))]
        for threshold in (0.05, 0.2, 0.5, 0.9):
            got = dict(index.search(terms, threshold))
            assert set(got) == {n for n, s in enumerate(scores) if s >= threshold - SLACK}
            assert all(abs(got[n] - scores[n]) < 1e-12 for n in got)


def test_bounds_never_lose_a_passage():
    index = index_of([(i, prose(i, 30, 300)) for i in range(80)])
    docs = [words_of(prose(1000 + d, 40 + 17 * d, 300)) for d in range(25)] + [[], words_of("only one")]
    for threshold in (0.1, 0.3):
        kept = {(d, start) for d, start, _ in passages(docs, index, 16, threshold)}
        for d, words in enumerate(docs):
            for start in range(0, len(words), 16):
                terms = sorted({index.vocabulary[w] for w in words[start:start + 32] if w in index.vocabulary})
                if index.search(terms, threshold):
                    assert (d, start) in kept


@pytest.mark.parametrize("words", [400, 3])
def test_a_batch_of_documents_is_taken_piece_by_piece(words):
    index = index_of([(i, prose(i, 30, 300)) for i in range(200)])
    texts = [prose(1000 + d % 50, words, 300) for d in range(300_000 // words if words > 3 else 20_000)]
    texts[7] = prose(3, 30, 300)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    kept = list(decontaminate.sieve(SimpleNamespace(value=index), 0, 64, 0.6, 0.8)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in kept) == len(texts) - 1 and peak < 32e6


def test_planted_items_are_found(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BATCH_WORDS", 500)
    items = [(i, prose(2000 + i, 8 + 7 * (i % 9), 3000)) for i in range(40)] + [(None, "x"), (90, None), (91, "  "),
                                                                                 (92, "What is it? It is a planted cat")]
    clean = [prose(5000 + k, 30 + 40 * (k % 12), 3000) for k in range(60)]
    texts, planted = list(clean), set()
    for k, (i, t) in enumerate(items[:40]):
        words = clean[k].split()
        at = (k * 37) % len(words)
        mangled = t.upper() + "!!" if k % 3 == 0 else t.replace(" ", ",  ") if k % 3 == 1 else t
        texts.append(" ".join([*words[:at], mangled, *words[at:]]))
        planted.add((len(texts) - 1, i))
    texts.append("so: what IS it? it is a planted CAT.")
    planted.add((len(texts) - 1, 92))
    texts.append(items[5][1].rsplit(" ", len(items[5][1].split()) // 2)[0])  # half an item is no match
    docs = documents(spark, texts + awkward_texts())
    got = {(r["row"]["doc_id"], r["item_id"]) for r in contaminated(docs, frame(spark, items)).collect()}
    assert {p for p in got if p[1] is not None} == planted
    kept = [r["doc_id"] for r in uncontaminated(docs, frame(spark, items)).collect()]
    assert sorted(kept) == sorted(set(range(len(texts) + len(awkward_texts()))) - {d for d, _ in got})


def test_edited_and_cut_copies_of_items_without_a_question_mark(spark):
    items = [(i, prose(3000 + i, n, 3000)) for i, n in enumerate((29, 45))]
    texts, want = [], set()
    for i, t in items:
        words = t.split()
        copies = [[*words[:k], "edited", *words[k + 1:]] for k in range(len(words))]
        copies += [words[:k] for k in range(1, len(words))] + [words[k:] for k in range(1, len(words))]
        whole = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
        for c in copies:
            if len(whole & {tuple(c[k:k + 5]) for k in range(len(c) - 4)}) >= 0.8 * len(whole):
                want.add((len(texts), i))
            texts.append(" ".join([prose(4000, 20, 3000), *c, prose(4001, 20, 3000)]))
    docs = documents(spark, texts)
    got = contaminated(docs, frame(spark, items)).collect()
    assert {(r["row"]["doc_id"], r["item_id"]) for r in got} == want and len(want) > 70
    assert {r["doc_id"] for r in uncontaminated(docs, frame(spark, items)).collect()} == (
        set(range(len(texts))) - {d for d, _ in want})


def test_question_and_answer_must_both_stand(spark):
    question, answer = prose(3100, 40, 3000) + "?", prose(3101, 6, 3000)
    docs = documents(spark, [f"{question} {answer}", f"{question} {prose(3102, 6, 3000)}", question])
    got = contaminated(docs, frame(spark, [(1, f"{question} {answer}"), (2, question)])).collect()
    assert {(r["row"]["doc_id"], r["item_id"]) for r in got} == {(0, 1), (0, 2), (1, 2), (2, 2)}


def test_item_longer_than_the_usual_chunk_and_sharded_index(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 600)
    items = [(i, prose(i, 150 if i == 3 else 12, 5000)) for i in range(20)]
    texts = [prose(99, 70, 5000) + " " + t + " " + prose(98, 33, 5000) for _, t in items] + [prose(97, 400, 5000)]
    docs = documents(spark, texts)
    got = contaminated(docs, frame(spark, items)).collect()
    assert {(r["row"]["doc_id"], r["item_id"]) for r in got} == {(i, i) for i in range(20)}
    assert [r["doc_id"] for r in uncontaminated(docs, frame(spark, items)).collect()] == [20]


def test_empty_tables(spark):
    some = frame(spark, [(1, "an item of five words")])
    assert contaminated(empty(spark), some).count() == 0 and uncontaminated(empty(spark), some).count() == 0
    docs = documents(spark)
    assert contaminated(docs, frame(spark, [])).count() == 0
    assert uncontaminated(docs, frame(spark, [])).count() == len(awkward_texts())


def test_all_planted_in_the_given_tables(spark):
    from airwave.llm.common import table
    sf = "/root/testdata/sf0.01"
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    plain = [(d, b" ".join(words_of(t))) for d, t in docs]
    whole = {(d, i) for i, x in items for d, t in plain if b" ".join(words_of(x)) in t}
    got = contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).collect()
    assert {(r["row"]["doc_id"], r["item_id"]) for r in got} == whole
    assert np.mean([r["score"] for r in got]) > 0.99
