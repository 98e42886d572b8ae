"""Language-model scores: base against plain counts, attention against a plain formula, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from fixtures import awkward_texts, documents, empty
from pyspark.sql import functions as F

from airwave.llm import lm_scoring
from airwave.llm.queries import REGISTRY

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
CODER = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=lm_scoring.read_ranks(PATH), special_tokens={})
TEXTS = awkward_texts() + ["same words again " * 30, "a\xa0b  x   q ", "'s 't' '' \x85", "İ É ß", "🙂" * 50]


def words(text) -> list:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in lowered.translate({k: " " for k in (32, 9, 10, 11, 12, 13)}).split(" ") if w]


def brute_base(texts: list, learns: list) -> list:
    counts, end = Counter(), object()
    for t, use in zip(texts, learns):
        if use:
            counts.update([*words(t), end])
    every, distinct = sum(counts.values()), len(counts)
    return [(len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), end]), every,
             sum(math.log10((counts[w] + 1) / (every + distinct + 1)) for w in [*words(t), end])) for t in texts]


@pytest.mark.parametrize("texts", [
    TEXTS, [""], ["", ""], ["  ", "one"], [bytes(range(256)), b"\xff\xfe A a\x0b\x0cB", b"\t\n\r"]])
def test_words_are_numbered_as_they_appear(texts):
    raw = [t if isinstance(t, bytes) else (t or "").encode() for t in texts]
    numbers, ends, distinct = lm_scoring.numbered(raw)
    split = [t.lower().split() for t in raw]
    assert distinct == list(dict.fromkeys(w for t in split for w in t))
    assert [distinct[k] for k in numbers] == [w for t in split for w in t]
    assert ends.tolist() == np.cumsum([len(t) for t in split]).tolist()


def test_subwords_of_words_one_by_one():
    coder = lm_scoring.Encoder(lm_scoring.read_ranks(PATH), PATTERN)
    for some in ([], [b"one"], [b"one", b"caf\xc3\xa9", b"don't", b"12345"], [b"a\xc2\xa0b", b"x"], [b"\xff\xc3", b"\xe2\x82", b"y"],
                 sorted({w for t in TEXTS for w in words(t)} and {w.encode() for t in TEXTS for w in words(t)})):
        ids, ends = coder.encode(some)
        got = [p.tolist() for p in np.split(ids, ends)[:len(some)]]
        assert got == [CODER.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in some]


def scored(docs, learns):
    got = lm_scoring.score(docs, learns, PATH, PATTERN).collect()
    return {r["row"]["doc_id"]: r for r in got}


@pytest.mark.parametrize("block", [1, 3000, 1 << 24])
def test_base_and_counts(spark, monkeypatch, block):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_scoring, "RANGE_WORDS", 500)
    docs = documents(spark, TEXTS, clashing=True).repartition(3)
    got = scored(docs, F.col("doc_id") % 3 != 1)
    want = brute_base(TEXTS, [i % 3 != 1 for i in range(len(TEXTS))])
    assert set(got) == set(range(len(TEXTS)))
    for i, (n, known, every, base) in enumerate(want):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["learns"]) == (n, known, every, i % 3 != 1)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isfinite(r["score"]) and r["score"] < 0
        ids = [k for w in words(TEXTS[i]) for k in CODER.encode_ordinary(" " + w)]
        assert r["n_subwords"] == len(ids) + 1
        assert r["row"]["lang"] == "en"


def test_empty_and_nothing_to_learn(spark):
    assert lm_scoring.score(empty(spark), F.lit(True), PATH, PATTERN).count() == 0
    for r in scored(documents(spark, ["a b", None]), F.lit(None).cast("boolean")).values():
        assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
        assert r["score"] <= -r["n_subwords"] * math.log10(lm_scoring.SLOTS) * 0.99


def small_model(seed: int) -> tuple:
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 5000, 4000)
    counts = np.bincount(ids, minlength=lm_scoring.IDS).astype(float)
    slots = lm_scoring.Model(counts).slot[ids]
    pairs = np.zeros((lm_scoring.SLOTS, lm_scoring.SLOTS))
    np.add.at(pairs, (slots[:-1], slots[1:]), 1)
    model = lm_scoring.Model(counts, pairs)
    model.weights = {n: a + rng.normal(0, 0.3, a.shape).astype(np.float32) for n, a in model.weights.items()}
    return model, rng


def plain(model, ids: list) -> list:
    """Log probabilities one token at a time, over the window each token falls in."""
    w = {n: a.astype(float) for n, a in model.weights.items()}
    slots = model.slot[ids].tolist()
    fed = [model.start] + slots[:-1]
    out = []
    for t, want in enumerate(slots):
        lo = max(0, t // lm_scoring.STRIDE * lm_scoring.STRIDE - lm_scoring.CONTEXT)
        seen = w["e"][fed[lo:t + 1]]
        now = seen[-1]
        a = (now @ w["q"]) @ (seen @ w["k"]).T / lm_scoring.DIM ** 0.5 + w["b"][np.arange(t - lo, -1, -1)]
        a = np.exp(a - a.max())
        h = np.concatenate([now, a / a.sum() @ (seen @ w["v"])])
        r = np.maximum(h @ w["w"] + w["c"], 0)
        g = np.concatenate([h, r]) @ w["u"] + model.prior[fed[t]]
        g -= np.log(np.exp(g - g.max()).sum()) + g.max()
        out.append(g[model.cls[want]] + model.within[fed[t], want] + model.inside[ids[t]])
    return out


def test_windows_score_every_token_once():
    model, rng = small_model(1)
    docs = [rng.integers(0, 5000, n).tolist() for n in (0, 1, 14, 15, 16, 17, 31, 200)]
    block = object.__new__(lm_scoring.Block)
    block.ids = np.array([k for d in docs for k in [*d, lm_scoring.END]], np.int32)
    block.lengths = np.array([len(d) + 1 for d in docs])
    want = [p for d in docs for p in plain(model, np.array([*d, lm_scoring.END]))]
    assert np.allclose(lm_scoring.log_probabilities(model, block), want, atol=2e-3)


def test_probabilities_add_up():
    model, _ = small_model(2)
    for start in ([], [5, 9, 1]):
        p = 0.0
        block = object.__new__(lm_scoring.Block)
        some = np.arange(lm_scoring.IDS)
        block.ids = np.concatenate([[*start, k] for k in some]).astype(np.int32)
        block.lengths = np.full(len(some), len(start) + 1)
        got = lm_scoring.log_probabilities(model, block)[len(start)::len(start) + 1]
        p = np.exp(got).sum()
        assert abs(p - 1) < 1e-3


def test_gradients():
    model, rng = small_model(3)
    w = {n: a.astype(np.float64) for n, a in model.weights.items()}
    x = rng.integers(0, lm_scoring.SLOTS + 1, (3, lm_scoring.WINDOW))
    y = rng.integers(-1, lm_scoring.CLASSES, x.size)

    def loss(weights) -> float:
        e = weights["e"][x]
        a = (e @ weights["q"]) @ (e @ weights["k"]).transpose(0, 2, 1) * lm_scoring.DIM ** -0.5
        a = a + weights["b"][lm_scoring.DISTANCE] + lm_scoring.CAUSAL + np.where(x == lm_scoring.PAD, -1e9, 0)[:, None, :]
        a = np.exp(a - a.max(-1, keepdims=True))
        h = np.concatenate([e, a / a.sum(-1, keepdims=True) @ (e @ weights["v"])], -1).reshape(-1, 2 * lm_scoring.DIM)
        o = np.concatenate([h, np.maximum(h @ weights["w"] + weights["c"], 0)], 1) @ weights["u"] + model.prior[x.reshape(-1)]
        o -= np.log(np.exp(o - o.max(1, keepdims=True)).sum(1, keepdims=True)) + o.max(1, keepdims=True)
        return -o[np.arange(len(y)), y][y >= 0].mean()

    d, n = lm_scoring.gradients(w, model.prior, x, y)
    assert n == (y >= 0).sum()
    for name in w:
        towards = rng.normal(size=w[name].shape)
        up, down = ({**w, name: w[name] + s * 1e-5 * towards} for s in (1, -1))
        assert math.isclose((loss(up) - loss(down)) / 2e-5, (d[name] * towards).sum(), rel_tol=2e-2, abs_tol=1e-4), name


def test_every_learning_window_trains(monkeypatch):
    model, rng = small_model(4)
    block = object.__new__(lm_scoring.Block)
    block.number, block.lengths = 7, np.array([1, 33, 700, 64, 5000])
    block.learns = np.array([True, True, False, True, True])
    block.ids = rng.integers(0, 5000, block.lengths.sum()).astype(np.int32)
    seen = []
    real = lm_scoring.gradients
    monkeypatch.setattr(lm_scoring, "gradients", lambda w, prior, x, y: (seen.append(x), real(w, prior, x, y))[1])
    tokens = sum(lm_scoring.train_task(model, iter([block]), turn, 0)[1] for turn in range(lm_scoring.ROUNDS))
    assert tokens == block.lengths[block.learns].sum()
    slots = model.slot[block.ids[np.repeat(block.learns, block.lengths)]]
    want, _ = lm_scoring.windows(slots, block.lengths[block.learns], model.start, 0, lm_scoring.WINDOW)
    assert sorted(np.concatenate(seen).tolist()) == sorted(want.tolist())


def test_steps_are_plain_adam(monkeypatch):
    """The two vectors of the steps move every weight as Adam on each array alone does."""
    model, rng = small_model(5)
    block = object.__new__(lm_scoring.Block)
    block.number, block.lengths, block.learns = 3, np.array([900, 5, 3000]), np.ones(3, bool)
    block.ids = rng.integers(0, 5000, block.lengths.sum()).astype(np.int32)
    taken = []
    real = lm_scoring.gradients

    def kept(w, prior, x, y):
        d, n = real(w, prior, x, y)
        taken.append({k: np.array(g) for k, g in d.items()})
        return d, n

    monkeypatch.setattr(lm_scoring, "gradients", kept)
    got, _ = lm_scoring.train_task(model, iter([block]), 0, 30)
    assert len(taken) >= 30
    for name, start in model.weights.items():
        a, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
        for step, d in enumerate(taken, 1):
            m += np.float32(0.1) * (d[name] - m)
            v += np.float32(0.02) * (d[name] ** 2 - v)
            rate = lm_scoring.RATE * min(1.0, step / 50)
            a -= (rate * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.98 ** step)) + 1e-8)).astype(np.float32)
        assert got[name].shape == a.shape and np.array_equal(got[name], a), name


def test_what_fills_the_places_behind_the_end_moves_nothing():
    model, rng = small_model(6)
    x = rng.integers(0, lm_scoring.SLOTS, (4, lm_scoring.WINDOW))
    y = rng.integers(0, lm_scoring.CLASSES, x.shape)
    y[1, 20:], y[2, 1:] = -1, -1
    filled = np.where(y < 0, lm_scoring.PAD, x)
    (d, n), (same, m) = (lm_scoring.gradients(model.weights, model.prior, some, y.reshape(-1)) for some in (x, filled))
    assert n == m == (y >= 0).sum() and not same["e"][lm_scoring.PAD].any()
    assert all(np.allclose(d[name], same[name], rtol=1e-5, atol=1e-8) for name in d)


def test_held_out_gain(spark):
    """Attention and pair counts beat single subwords by far; on learning documents the model beats the word base."""
    got = REGISTRY["op13_lm_scoring"](spark, "/root/testdata/sf0.01").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 7 == 2 for i in got["doc_id"]]).all()
    held = got[got["held_out"]].sum(numeric_only=True)
    assert held["score"] / held["n_subwords"] > -1.75 and held["score"] > 1.06 * held["base_score"]
