"""The corpus pipeline against a plain sequential version, and awkward tables."""

import random

import corpus_pipeline
import pyarrow as pa
import pytest
from fixtures import awkward_texts, documents, empty, prose
from test_simhash import brute_components, brute_fingerprint
from test_substring_dedup import brute as brute_cut
from tokenizers import Tokenizer

import public_tokenizers
from airwave.llm.common import BATCH_BYTES, stage, table
from airwave.llm.decontaminate import words_of
from airwave.llm.language_id import learn, predict

SF = "/root/testdata/sf0.001"


def sequential(spark, docs, items):
    languages = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(docs, learn(docs)).collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = {i: t for i, t in rows.items() if languages[i][0] != "und" and languages[i][1] >= corpus_pipeline.MIN_COSINE}
    least = brute_components({i: brute_fingerprint(t) for i, t in rows.items()})
    rows = {i: t for i, t in rows.items() if least[i] == i}
    cut = brute_cut(list(rows.items()), 20)
    rows = {i: (cut[i][2] if cut[i][1] else t) for i, t in rows.items() if not cut[i][0] or cut[i][1] < cut[i][0]}
    plain = [b" ".join(words_of(t)) for t in items if words_of(t)]
    rows = {i: t for i, t in rows.items() if not any(p in b" ".join(words_of(t)) for p in plain)}
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    return {i: (len(t), library.encode(t, add_special_tokens=False).ids) for i, t in rows.items()}


def test_matches_the_sequential_version(spark):
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    got = {r["doc_id"]: (r["n_chars"], r["ids"]) for r in corpus_pipeline.run(spark, SF).collect()}
    wanted = sequential(spark, table(spark, SF, "documents"), items)
    assert got == wanted and 0 < len(got) < 200


def through(spark, docs, sf):
    for _, step in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = stage(step(spark, docs, sf))
        assert docs.columns == before
    return corpus_pipeline.STAGES[-1][1](spark, docs, sf)


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_texts(spark, clashing):
    got = {r["doc_id"]: r["n_chars"] for r in through(spark, documents(spark, clashing=clashing), SF).collect()}
    texts = awkward_texts()
    assert 0 in got and 1 not in got and 2 not in got  # copies of document 0
    assert not {6, 7, 8, 19} & got.keys()  # no letters
    assert all(n <= len(texts[i]) for i, n in got.items())


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = documents(spark, ["words of one document", "words of one document", "quite another text"], [1, 1, None])
    assert sorted(str(r["doc_id"]) for r in through(spark, docs, SF).collect()) == ["1", "None"]
    assert through(spark, empty(spark), SF).count() == 0


def test_near_duplicates_are_judged_by_row_whatever_the_ids(spark):
    a, b, c, d = (prose(k, 60) for k in (1, 2, 3, 4))
    rows = [(1, a), (1, b), (1, b), (2, b), (2, c), (3, a), (None, a), (None, c), (None, d), (None, d), (None, d)]
    kept = corpus_pipeline.simhash_stage(spark, documents(spark, [t for _, t in rows], [i for i, _ in rows]), SF)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, a), (1, b), (2, c), (None, d)], key=str)


def test_texts_of_an_unlearned_script_do_not_go_by_chance(spark):
    rng = random.Random(5)
    foreign = [" ".join("".join(chr(rng.randrange(0x430, 0x450)) for _ in range(6)) for _ in range(80))
               for _ in range(60)]
    rows = [(i, t, None, "s", len(t)) for i, t in enumerate([*foreign, "123 !", ""])]
    learned = documents(spark, ["an english text of a few plain words", "some more of the same language"], [100, 101])
    docs = learned.unionByName(spark.createDataFrame(rows, learned.schema))
    kept = corpus_pipeline.language_stage(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(60), 100, 101]


def test_stages_hand_small_batches_to_python(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    docs = documents(spark, [prose(i, 30, 900) * 20 for i in range(4000)]).coalesce(1)
    for _, step in corpus_pipeline.STAGES:
        spark.conf.unset(BATCH_BYTES)
        step(spark, docs, SF)
        assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) < 5 << 20
    spark.conf.set(BATCH_BYTES, "1m")
    corpus_pipeline.language_stage(spark, docs, SF)
    assert spark.conf.get(BATCH_BYTES) == "1m"
    spark.conf.unset(BATCH_BYTES)
