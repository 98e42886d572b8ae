"""BPE against the tokenizers library, exact ids and exact decoding."""

import random

import public_tokenizers
from fixtures import awkward_texts, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from airwave.llm.bpe import Codec, load, tokenize

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), Codec(load(PATH))


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=("Cs", "Cn")), max_size=60))
def test_any_text(text):
    same(text)


def test_special_tokens_accents_and_long_words():
    for text in ("<|endoftext|>", "a<|startoftext|>B<|endoftext|><|endoftext|>", "<|EndOfText|>", "ΑΣ ΣΑΣ", "İstanbul",
                 "ȩ́", "don't we'LL 1234", "日本語 한국어", "\x1c\x1d\x85\xa0", "ab" * 50_000, "가"):
        same(text)
    rng = random.Random(1)
    same("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30_000)))


def test_table(spark):
    texts = awkward_texts() + ["long " * 40_000]
    got = tokenize(documents(spark, texts, clashing=True), PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode(texts[r["row"]["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == LIBRARY.decode(ids, skip_special_tokens=False)
    assert tokenize(empty(spark), PATH).count() == 0


def test_frequent_pieces_stay_in_the_memo(monkeypatch):
    merged = []

    class Counting(Codec):
        def merge(self, piece):
            merged.append(piece)
            return super().merge(piece)

    monkeypatch.setattr("airwave.llm.bpe.MEMO", 20)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = " ".join(f"common {a}{b}q" for a in letters for b in letters)
    assert Counting(load(PATH)).encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert merged.count("common") == 1
