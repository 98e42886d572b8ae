"""Language-model scores of documents: causal self-attention over subword ids.

Words are runs of bytes other than space and U+0009 to U+000D, A to Z lowered;
a text is its words and one end.  Each word is encoded on its own, behind a
space, with a public byte-level BPE file; the model's tokens are these subword
ids and the end.  Two scores, both log10 probabilities of the whole text:

* **base**: every word's smoothed share of all learning words,
  (count + 1) / (all + distinct + 1).
* **score**: p(next | before) = p(class | window) * p(id | class, id before).
  Every learning document's id pairs give smoothed pair probabilities over the
  ``KNOWN`` most frequent ids (others share a slot, and their own shares inside
  it).  Ids fall into ``CLASSES``: the most frequent alone, the rest clustered
  by their pair profiles.  Causal self-attention over the ids of the window,
  with a bias for the distance, and a hidden layer move the class probabilities
  that the pair counts give; without any training the model is the pair model.
  All factors sum to one, so the score is the log of a proper distribution.

Scoring cuts a document into windows of ``WINDOW`` ids that overlap by
``WINDOW - STRIDE``: queries are the last STRIDE places, so each token is scored
once, by at least WINDOW - STRIDE ids of context (fewer at the start).  Windows
of many documents go through masked attention in batches.

How it runs:

* Documents are cut into blocks of about ``BLOCK_BYTES`` of text (a longer text
  is a block of its own), each written once as one row: its distinct words in
  the order of a 128-bit hash, with their subword ids and learning counts, and
  each document's words as numbers.
* Words are counted by hash range.  A block sends each range its words' hashes
  and counts, packed; a range adds up what all blocks sent and returns the sums
  in the same order.  Ranges are made for ``RANGE_WORDS`` of these words each; a
  frequent word is one entry a block, so no word makes a range heavy.
* Subword and pair counts are summed in each task, then by Spark; what reaches
  the driver is bounded by the vocabulary (50,257 ids, (KNOWN + 1)**2 pairs).
* Training: in each of ``ROUNDS`` jobs every task starts from the same weights
  and takes Adam steps over its share of all learning windows; Spark adds up the
  tasks' weights times tokens, by weight, and the average starts the next round.
  Every learning window is used in exactly one round (dealt by a hash of block
  and window), so counts and weights learn from the whole corpus.  Where that
  makes fewer than ``LEAST_STEPS`` steps in all, tasks go on through their other
  windows.
  As with any data-parallel training, the split of the input moves the weights
  a little; the same split gives the same weights.

Defined results: null text counts as empty (one token, the end); null ids are
the caller's (a null choice does not learn); without learning documents the base
is 0 a token and the model uniform over the slots, and over the ids that share one; repeated rows count repeatedly;
extra columns travel in the struct column ``row``; empty in, empty out.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from airwave.llm.common import fmix, stage

BLOCK_BYTES = 8 << 20
RANGE_WORDS = 400_000
PART_WORDS = 100_000
IDS = 50_257
END = 50_256
KNOWN = 1023
SLOTS = KNOWN + 1
PAD = SLOTS
CLASSES = 64
ALONE = 32
WINDOW = 32
STRIDE = 16
CONTEXT = WINDOW - STRIDE
DIM = 16
HIDDEN = 32
DISCOUNT = 0.5
ROUNDS = 2
BATCH = 64
RATE = 0.01
LEAST_STEPS = 400
SCORED = 512
SAFE = 60.0
SHAPES = {"e": (SLOTS + 1, DIM), "q": (DIM, DIM), "k": (DIM, DIM), "v": (DIM, DIM), "b": (WINDOW,),
          "w": (2 * DIM, HIDDEN), "c": (HIDDEN,), "u": (2 * DIM + HIDDEN, CLASSES)}


# ------------------------------------------------------------------ blocks
def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(number of each word, each text's end among them, distinct words): lower-cased words, numbered as they first appear.

    bytes.lower() knows ASCII only, as the contract does.
    """
    raw = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    white = (raw == 32) | (raw - np.uint8(9) < 5)
    edges = np.flatnonzero(np.diff(white, prepend=True))  # start, end, start, end, ...
    offsets = np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[~white])]
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
    ends = np.searchsorted(edges[::2], np.cumsum([len(t) + 1 for t in texts]))
    _, cuts, data = words.dictionary.buffers()
    cuts, data = np.frombuffer(cuts, np.int64)[:len(words.dictionary) + 1].tolist(), data.to_pybytes() if data else b""
    return words.indices.to_numpy(), ends, [data[i:j] for i, j in zip(cuts, cuts[1:])]


class Encoder:
    """Subword ids of words, each encoded behind a space."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.coder = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.starts = np.zeros(IDS, bool)
        self.starts[[k for token, k in ranks.items() if token[:1] == b" "]] = True

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end of each word's ids).

        Words go in as one text, and each is told by the space its ids start
        with.  Words that hold white space beyond ASCII go one by one.
        """
        whole = b"".join(map(b" %b".__mod__, words)).decode("utf-8", "replace")
        if not SPACES.search(whole):
            ids = np.array(self.coder.encode_ordinary(whole), np.uint16)
            first = np.flatnonzero(self.starts[ids])
            if len(words) == len(first):
                return ids, np.append(first[1:], len(ids)).astype(np.int32)[:len(words)]
        text = [w.decode("utf-8", "replace") for w in words]
        plain = [w for w in text if not SPACES.search(w)]
        ids = np.array(self.coder.encode_ordinary("".join(f" {w}" for w in plain)), np.uint16)
        first = np.flatnonzero(self.starts[ids])
        told = iter(np.split(ids, first[1:])) if len(plain) == len(first) > 0 else None
        coded = [self.coder.encode_ordinary(f" {w}") if told is None or SPACES.search(w) else next(told) for w in text]
        return (np.array([i for c in coded for i in c], np.uint16), np.cumsum([len(c) for c in coded], dtype=np.int32))


# White space beyond ASCII, at which the splitting pattern may cut off a space.
SPACES = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def packed(x: np.ndarray) -> bytes:
    """Whole numbers below 2**31 as planes of bytes, which compress well."""
    return x.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view(np.int32).reshape(-1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


BLOCK = ("block long, distinct long, keys binary, counts binary, subwords binary, subword_ends binary, numbers binary, "
         "doc_ends binary, learns binary")


def blocks_of(docs: DataFrame, learns: Column, path: str, pattern: str, text_col: str) -> DataFrame:
    """One row for each block; ``rows`` holds the documents' other columns."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(path))  # fixed by the file
    kept = [c for c in docs.columns if c != text_col]
    row = F.struct(*[docs[f"`{c}`"] for c in kept]) if kept else F.struct(F.lit(1).alias("none"))
    given = docs.select(docs[f"`{text_col}`"].cast("binary").alias("text"), row.alias("row"),
                        F.coalesce(learns, F.lit(False)).alias("learns"))
    kind = StructType([*StructType.fromDDL(BLOCK).fields,
                       StructField("rows", ArrayType(given.schema["row"].dataType))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(ranks.value, pattern).encode
        part, number = TaskContext.get().partitionId(), 0
        docs_in, flags, size = [], [], 0
        held: list[pa.Array] = []

        def close() -> pa.RecordBatch:
            nonlocal number, docs_in, flags, size, held
            flat, ends, words = numbered(docs_in)
            keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2)
            order = np.lexsort((keys[:, 1], keys[:, 0]))
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            flat = place[flat]
            counts = np.bincount(flat[np.repeat(np.array(flags), np.diff(ends, prepend=0))], minlength=len(words))
            ids, sub_ends = encode([words[k] for k in order])
            rows = pa.concat_arrays(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number]), pa.array([len(words)]), pa.array([keys[order].astype("<u8").tobytes()]),
                 pa.array([packed(counts)]), pa.array([ids.tobytes()]), pa.array([packed(sub_ends)]),
                 pa.array([packed(flat)]), pa.array([ends.tobytes()]), pa.array([np.array(flags, bool).tobytes()]),
                 pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)],
                names=[*(f.split()[0] for f in BLOCK.split(", ")), "rows"])
            number += 1
            docs_in, flags, size, held = [], [], 0, []
            return out

        for b in batches:
            texts, first = b.column("text"), 0
            use = b.column("learns").to_pylist()
            for k in range(b.num_rows):
                raw = texts[k].as_py() or b""
                if docs_in and size + len(raw) > BLOCK_BYTES:
                    held.append(b.column("row").slice(first, k - first))
                    first = k
                    yield close()
                docs_in.append(raw)
                flags.append(use[k])
                size += len(raw)
            held.append(b.column("row").slice(first))
        if docs_in:
            yield close()

    return given.mapInArrow(run, kind)


class Block:
    """Some documents of a block row as arrays: their words, and their subword ids with an end behind each document."""

    def __init__(self, number: int, learns: np.ndarray, numbers: np.ndarray, n_words: np.ndarray, sub: np.ndarray,
                 to: np.ndarray):
        self.number, self.learns, self.numbers, self.n_words = number, learns, numbers, n_words
        self.ends = np.cumsum(n_words)
        width = np.diff(to, prepend=0)
        size = width[numbers]
        total = int(size.sum())
        at = np.repeat((to - width)[numbers] - (np.cumsum(size) - size), size) + np.arange(total)
        passed = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        docs = passed[self.ends] - passed[self.ends - n_words]
        self.lengths = docs + 1
        ids = np.full(total + len(docs), END, np.int32)
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(self.lengths) - 1] = False
        ids[inside] = sub[at]
        self.ids = ids


def parts_of(r: dict) -> Iterator[Block]:
    """A block row in runs of documents of at most PART_WORDS words (a longer document is a run of its own)."""
    learns, ends = np.frombuffer(r["learns"], bool), np.frombuffer(r["doc_ends"], np.int64)
    numbers, n_words = unpacked(r["numbers"]), np.diff(np.frombuffer(r["doc_ends"], np.int64), prepend=0)
    sub, to = np.frombuffer(r["subwords"], np.uint16), unpacked(r["subword_ends"])
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + PART_WORDS, side="right")))
        yield Block(r["block"] * 1_000_003 + at, learns[at:stop], numbers[before:ends[stop - 1]], n_words[at:stop], sub, to)
        at = stop


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    columns = ("block", "learns", "numbers", "doc_ends", "subwords", "subword_ends")
    for b in batches:
        for k in range(b.num_rows):
            yield from parts_of({c: b.column(c)[k].as_py() for c in columns})


# ------------------------------------------------------------------- model
def windows(slots: np.ndarray, lengths: np.ndarray, start: int, context: int, stride: int):
    """(inputs, targets' places or -1): windows of context + stride inputs, each with stride targets.

    A document's inputs are ``start`` and all its ids but the last; missing
    context and the filling behind the end are PAD.
    """
    count = -(-lengths // stride)
    room = context + count * stride
    base = np.cumsum(room) - room
    first = np.cumsum(lengths) - lengths
    shift = np.repeat(base + context - first, lengths)
    shift += np.arange(len(slots))
    laid = np.full(int(room.sum()), PAD, np.int32)
    before = np.empty_like(slots)
    before[1:] = slots[:-1]
    before[first] = start
    laid[shift] = before
    target = np.full(len(laid), -1, np.int32)
    target[shift] = np.arange(len(slots), dtype=np.int32)
    if not context:
        return laid.reshape(-1, stride), target.reshape(-1, stride)
    of = np.repeat(base - stride * (np.cumsum(count) - count), count) + stride * np.arange(int(count.sum()))
    return laid.take(of[:, None] + np.arange(context + stride)), target.take(of[:, None] + context + np.arange(stride))


def clusters(pairs: np.ndarray) -> np.ndarray:
    """Class of each slot: the ALONE most frequent alone, the others by k-means over their pair profiles."""
    def profile(m: np.ndarray) -> np.ndarray:
        return np.log((m + 0.5) / (m.sum(1, keepdims=True) + 0.5 * SLOTS))

    f = np.concatenate([profile(pairs), profile(pairs.T)], axis=1)
    f -= f.mean(0)
    strength, axes = np.linalg.eigh(f @ f.T)
    z = (axes[:, -20:] * np.sqrt(np.maximum(strength[-20:], 0)))[ALONE:]
    weight, k = pairs.sum(0)[ALONE:] + 1, CLASSES - ALONE
    centres = z[:k].copy()
    for _ in range(30):
        nearest = ((z[:, None] - centres) ** 2).sum(-1).argmin(1)
        for j in range(k):
            if (nearest == j).any():
                centres[j] = np.average(z[nearest == j], axis=0, weights=weight[nearest == j])
    return np.concatenate([np.arange(ALONE), ALONE + nearest])


def initial() -> dict[str, np.ndarray]:
    draw = np.random.default_rng(13)
    scale = {"e": 0.5, "q": 0.5 / DIM ** 0.5, "k": 0.5 / DIM ** 0.5, "v": DIM ** -0.5, "w": (2 * DIM) ** -0.5}
    return {n: (draw.normal(0, scale[n], s) if n in scale else np.zeros(s)).astype(np.float32) for n, s in SHAPES.items()}


class Model:
    """Counts' tables and the attention's weights."""

    def __init__(self, ids: np.ndarray, pairs: np.ndarray | None = None):
        order = np.argsort(-ids, kind="stable")
        rank = np.empty(IDS, np.int64)
        rank[order] = np.arange(IDS)
        self.slot = np.minimum(rank, KNOWN).astype(np.int32)
        rare = ids[order[KNOWN:]].sum()
        self.inside = np.where(rank >= KNOWN, np.log((ids + 1) / (rare + IDS - KNOWN)), 0.0)
        self.start = int(self.slot[END])
        self.weights = initial()
        if pairs is not None:
            # Absolute discounting: what is taken off the pairs seen goes to ids by the number of ids they follow.
            alone = (pairs > 0).sum(0) + 0.1
            left = DISCOUNT * (pairs > 0).sum(1, keepdims=True) + 1
            follows = (np.maximum(pairs - DISCOUNT, 0) + left * alone / alone.sum()) / (pairs.sum(1, keepdims=True) + 1)
            self.cls = clusters(pairs)
            classes = np.zeros((SLOTS, CLASSES))
            for c in range(CLASSES):
                classes[:, c] = follows[:, self.cls == c].sum(1)
            classes = np.maximum(classes, 1e-30)
            self.within = (np.log(follows) - np.log(classes[:, self.cls])).astype(np.float32)
            self.prior = np.concatenate([np.log(classes), np.zeros((1, CLASSES))]).astype(np.float32)


BACK = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
DISTANCE = np.maximum(BACK, 0)
CAUSAL = np.where(BACK >= 0, 0, -1e9).astype(np.float32)


def log_probabilities(model: Model, block: Block) -> np.ndarray:
    """Natural log probability of every subword and end of a block.

    Keys, queries, values and what an id itself adds to the hidden layer and
    the logits depend on the id alone: they are tables.  One more column masks
    PAD keys and adds up the weights.
    """
    slots = model.slot[block.ids]
    inputs, targets = windows(slots, block.lengths, model.start, CONTEXT, STRIDE)
    w = model.weights
    e = w["e"]
    pad = np.zeros((len(e), 1), np.float32)
    pad[PAD] = -1e4
    queries = np.hstack([e @ w["q"] * np.float32(DIM ** -0.5), np.ones_like(pad)])
    held = np.hstack([e @ w["k"], pad, e @ w["v"], np.ones_like(pad)])
    keys, values = held[:, :DIM + 1], held[:, DIM + 1:]
    bias = (w["b"][DISTANCE] + CAUSAL)[CONTEXT:]
    hidden, logits = e @ w["w"][:DIM] + w["c"], e @ w["u"][:DIM] + model.prior
    from_mix, mix_logits, hidden_logits = w["w"][DIM:], w["u"][DIM:2 * DIM], w["u"][2 * DIM:]
    # Bounds of what is exponentiated; only beyond SAFE it is clipped.
    size = np.abs(values[:, :DIM]).max(0)
    most_a = np.abs(queries[:, :DIM]).max(0) @ np.abs(keys[:, :DIM]).max(0) + np.abs(w["b"]).max()
    most_r = np.maximum(hidden, 0).max(0) + size @ np.abs(from_mix)
    most_g = (logits.max(0) + size @ np.abs(mix_logits) + most_r @ np.abs(hidden_logits)).max()
    ones = np.ones(CLASSES, np.float32)
    out = np.empty(len(slots))
    for lo in range(0, len(inputs), SCORED):
        x, to = inputs[lo:lo + SCORED], targets[lo:lo + SCORED].reshape(-1)
        seen = held.take(x, 0)
        a = queries.take(x[:, CONTEXT:], 0) @ seen[..., :DIM + 1].transpose(0, 2, 1)
        a += bias
        if most_a > SAFE:
            np.minimum(a, SAFE, out=a)
        mixed = np.exp(a, out=a) @ seen[..., DIM + 1:]
        asked = x[:, CONTEXT:].reshape(-1)
        valid = np.flatnonzero(to >= 0)
        asked, to, mixed = asked.take(valid), to.take(valid), mixed.reshape(-1, DIM + 1).take(valid, 0)
        mix = mixed[:, :DIM] / mixed[:, DIM:]
        r = hidden.take(asked, 0)
        r += mix @ from_mix
        g = logits.take(asked, 0)
        g += mix @ mix_logits
        g += np.maximum(r, 0, out=r) @ hidden_logits
        if most_g > SAFE:
            np.minimum(g, SAFE, out=g)
        y = slots[to]
        picked = g[np.arange(len(y)), model.cls[y]]
        out[to] = picked - np.log(np.exp(g, out=g) @ ones) + model.within[asked, y]
    return out + model.inside[block.ids]


def gradients(w: dict, prior: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[dict, int]:
    """Gradient of the mean loss of the class predictions at all places of the windows (targets -1 are none)."""
    scale = np.float32(DIM ** -0.5)
    flat = x.reshape(-1)
    one, out = np.ones((DIM, 1), np.float32), np.ones(CLASSES, np.float32)
    mixers = np.hstack([w["q"] * scale, w["k"], w["v"]])
    e = w["e"].take(flat, 0)
    o = np.empty((len(flat), 2 * DIM + HIDDEN), e.dtype)
    mix, r = o[:, DIM:2 * DIM], o[:, 2 * DIM:]
    o[:, :DIM] = e
    q, k, v = (m.reshape(*x.shape, DIM) for m in np.split(e @ mixers, 3, axis=1))
    a = q @ k.transpose(0, 2, 1)
    a += w["b"][DISTANCE] + CAUSAL
    # Later places are masked already, so PAD keys count only in front of a target.
    ok, pads = y >= 0, x == PAD
    if (np.logical_or.accumulate(pads, 1) & ok.reshape(x.shape)).any():
        a += np.where(pads, np.float32(-1e9), np.float32(0))[:, None, :]
    # No maximum is taken off: only what lies beyond SAFE is clipped, and an empty sum is kept from 0 / 0.
    if a.max(initial=0) > SAFE:
        np.minimum(a, SAFE, out=a)
    np.exp(a, out=a)
    a /= np.maximum(a @ np.ones((a.shape[-1], 1), np.float32), 1e-30)
    np.matmul(a, v, out=mix.reshape(*x.shape, DIM))
    h = e @ w["w"][:DIM]
    h += mix @ w["w"][DIM:]
    h += w["c"]
    np.maximum(h, 0, out=r)
    g = o @ w["u"]
    g += prior.take(flat, 0)
    if g.max(initial=0) > SAFE:
        np.minimum(g, SAFE, out=g)
    np.exp(g, out=g)
    g *= (ok / np.maximum(g @ out, 1e-30) / max(1, ok.sum())).astype(np.float32)[:, None]
    at = np.flatnonzero(ok)
    g.reshape(-1)[at * CLASSES + y[at]] -= np.float32(1 / max(1, len(at)))
    d = {"u": o.T @ g}
    back = g @ w["u"].T
    hidden = back[:, 2 * DIM:] * (r > 0)
    d["w"], d["c"] = o[:, :2 * DIM].T @ hidden, np.ones(len(hidden), np.float32) @ hidden
    dh = hidden @ w["w"].T
    dh += back[:, :2 * DIM]
    dc = np.ascontiguousarray(dh[:, DIM:])
    through = (dc * mix) @ one  # what each place's weights share: the sum of da * a over its keys
    dc = dc.reshape(*x.shape, DIM)
    da = dc @ v.transpose(0, 2, 1)
    da -= through.reshape(*x.shape, 1)
    da *= a
    d["b"] = np.bincount(DISTANCE.reshape(-1), weights=(da.sum(0) * (BACK >= 0)).reshape(-1), minlength=WINDOW)
    back = da.transpose(0, 2, 1)
    moved = np.empty((len(flat), 3 * DIM), e.dtype)
    parts = moved.reshape(*x.shape, 3 * DIM)
    for part, left, right in zip(np.split(parts, 3, axis=2), (da, back, a.transpose(0, 2, 1)), (k, q, dc)):
        np.matmul(left, right, out=part)
    d["q"], d["k"], d["v"] = np.split(e.T @ moved, 3, axis=1)
    d["q"] = d["q"] * scale
    de = moved @ mixers.T
    de += dh[:, :DIM]
    short = flat.astype(np.uint16)  # SLOTS + 1 values: sorted by counting
    order = np.argsort(short, kind="stable")
    short = short.take(order)
    first = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]]))
    d["e"] = np.zeros(SHAPES["e"], np.float32)
    d["e"][short[first]] = np.add.reduceat(de.take(order, 0), first, axis=0)
    return d, len(at)


def train_task(model: Model, blocks: Iterator[Block], turn: int, least: int) -> tuple[dict, int]:
    """Adam steps over this task's learning windows of the round; (weights, tokens seen).

    A task with fewer than ``least`` steps of its own goes on with the windows of the next rounds, then again.
    """
    # Adam takes the weights in two vectors: the biases, whose gradient is in double precision, and all others.
    others = [n for n in SHAPES if n != "b"]
    flat = np.concatenate([model.weights[n].reshape(-1) for n in others])
    cuts = np.cumsum([model.weights[n].size for n in others])[:-1]
    w = {n: part.reshape(SHAPES[n]) for n, part in zip(others, np.split(flat, cuts))} | {"b": model.weights["b"].copy()}
    vectors = (flat, w["b"])
    first, second = ([np.zeros_like(a) for a in vectors] for _ in range(2))
    step, seen = 0, 0
    kept: list[tuple] = []

    def steps(x: np.ndarray, y: np.ndarray, most: int) -> None:
        nonlocal step, seen
        for lo in range(0, len(x), BATCH):
            if step >= most:
                return
            d, n = gradients(w, model.prior, x[lo:lo + BATCH], y[lo:lo + BATCH].reshape(-1))
            step, seen = step + 1, seen + n
            rate = RATE / (1 + turn) * min(1.0, step / 50)
            for a, g, m, v in zip(vectors, (np.concatenate([d[n].reshape(-1) for n in others]), d["b"]), first, second):
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.02) * (g ** 2 - v)
                a -= (rate * m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.98 ** step)) + 1e-8)).astype(np.float32)

    for block in blocks:
        chosen = np.repeat(block.learns, block.lengths)
        if not chosen.any():
            continue
        slots = model.slot[block.ids[chosen]]
        x, to = windows(slots, block.lengths[block.learns], model.start, 0, WINDOW)
        cls = np.append(model.cls.take(slots), -1)  # target -1: none

        def picked(some: np.ndarray) -> tuple:
            return x.take(some, 0), cls.take(to.take(some, 0), mode="wrap")

        at = fmix(np.arange(len(x), dtype=np.uint64) + np.uint64(block.number * 0x9E3779B97F4A7C15 % (1 << 64)))
        share, order = (at // np.uint64(ROUNDS)).argsort(), at % np.uint64(ROUNDS)
        mine = share[order[share] == turn]
        steps(*picked(mine), 1 << 62)
        if step < least and sum(len(a) for a, _ in kept) < least * BATCH:
            kept.append(picked(share[order[share] != turn][:least * BATCH]))
    while seen and step < least:
        before = step
        for x, y in kept:
            steps(x, y, least)
        if step == before:
            break
    return w, seen


def trained(blocks: DataFrame, model: Model) -> Model:
    """Rounds of local steps and averages; a row of the average is one weight, so all of it is Spark's sum."""
    spark = blocks.sparkSession
    sizes = {n: int(np.prod(s)) for n, s in SHAPES.items()}
    tasks = blocks.select(F.spark_partition_id().alias("task")).distinct().count()
    least = -(-LEAST_STEPS // max(1, tasks))
    for turn in range(ROUNDS):
        given = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, seen = train_task(given.value, block_rows(batches), turn, least)
            if seen:
                flat = np.concatenate([w[n].reshape(-1) for n in SHAPES] + [[1.0]]).astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                                                 names=["i", "x"])

        got = model_columns(blocks).mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        if len(got):
            flat = got.sort_values("i")["x"].to_numpy()
            flat = flat[:-1] / flat[-1]
            cuts = np.cumsum(list(sizes.values()))[:-1]
            model.weights = {n: part.reshape(SHAPES[n]).astype(np.float32) for n, part in zip(SHAPES, np.split(flat, cuts))}
    return model


def model_columns(blocks: DataFrame, *more: str) -> DataFrame:
    return blocks.select("block", "learns", "numbers", "doc_ends", "subwords", "subword_ends", *more)


def learn(blocks: DataFrame) -> Model:
    """Subword counts, pair counts, then training, each over all blocks."""
    def count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for b in batches:
            for learns, counts, sub, to in zip(*[b.column(c).to_pylist() for c in (
                    "learns", "counts", "subwords", "subword_ends")]):
                often = np.repeat(unpacked(counts), np.diff(unpacked(to), prepend=0))
                total += np.bincount(np.frombuffer(sub, np.uint16), often, IDS).astype(np.int64)
                total[END] += int(np.frombuffer(learns, bool).sum())
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int64)), pa.array(total[i])], names=["i", "n"])

    def summed(fn, size: int, *columns: str) -> np.ndarray:
        got = model_columns(blocks, *columns).mapInArrow(fn, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros(size)
        out[got["i"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
        return out

    ids = summed(count_ids, IDS, "counts")
    first = Model(ids)
    slot, start = first.slot, first.start

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS * SLOTS, np.int64)
        for block in block_rows(batches):
            now = slot[block.ids].astype(np.int64)
            before = np.empty_like(now)
            before[1:] = now[:-1]
            before[np.cumsum(block.lengths) - block.lengths] = start
            use = np.repeat(block.learns, block.lengths)
            total += np.bincount(before[use] * SLOTS + now[use], minlength=len(total))
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int64)), pa.array(total[i])], names=["i", "n"])

    return trained(blocks, Model(ids, summed(count_pairs, SLOTS * SLOTS).reshape(SLOTS, SLOTS)))


# ------------------------------------------------------------- word counts
def word_counts(blocks: DataFrame) -> DataFrame:
    """(block, range, c): learning counts of a block's words that lie in a hash range, in the block's order (int64).

    One more row for each range (range -1) holds its words' ``total`` and how many are ``known``.
    """
    words = blocks.agg(F.sum("distinct")).first()[0] or 0
    ranges = words // RANGE_WORDS + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, keys, counts in zip(*[b.column(c).to_pylist() for c in ("block", "keys", "counts")]):
                keys, counts = np.frombuffer(keys, "<u8").reshape(-1, 2), unpacked(counts)
                if not len(keys):
                    continue
                of = ((keys[:, 0] >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(keys)]
                parts = list(zip(cuts[:-1], cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(of[i]) for i, _ in parts], pa.int64()), pa.array([block] * len(parts), pa.int64()),
                     pa.array([keys[i:j].tobytes() for i, j in parts], pa.binary()),
                     pa.array([packed(counts[i:j]) for i, j in parts], pa.binary())],
                    names=["range", "block", "keys", "counts"])

    def add(t: pa.Table) -> pa.Table:
        sent = [np.frombuffer(k, "<u8").reshape(-1, 2) for k in t.column("keys").to_pylist()]
        keys = np.concatenate(sent)
        n = np.concatenate([unpacked(c) for c in t.column("counts").to_pylist()]).astype(np.int64)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys = keys[order]
        first = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1])
        sums = np.add.reduceat(n[order], first)
        back = np.empty(len(order), np.int64)
        back[order] = np.repeat(sums, np.diff(first, append=len(order)))
        parts = np.split(back, np.cumsum([len(k) for k in sent])[:-1])
        size = len(sent) + 1
        return pa.table({"block": pa.array([*t.column("block").to_pylist(), None], pa.int64()),
                         "range": pa.array([*t.column("range").to_pylist(), -1], pa.int64()),
                         "c": pa.array([*(p.tobytes() for p in parts), None], pa.binary()),
                         "total": pa.array([None] * (size - 1) + [int(sums.sum())], pa.int64()),
                         "known": pa.array([None] * (size - 1) + [int((sums > 0).sum())], pa.int64())})

    sent = blocks.select("block", "keys", "counts").mapInArrow(send, "range long, block long, keys binary, counts binary")
    return sent.groupBy("range").applyInArrow(add, "block long, range long, c binary, total long, known long")


# ------------------------------------------------------------------- scores
def score(docs: DataFrame, learns: Column, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """(row, learns, n_tokens, n_known, train_tokens, base_score, n_subwords, score); ``row``: the columns but the text.

    ``learns`` tells which documents the counts and the model learn from;
    ``path`` and ``pattern`` are the subword file and its splitting pattern.
    """
    spark = docs.sparkSession
    blocks = stage(blocks_of(docs, learns, path, pattern, text_col))
    counts = stage(word_counts(blocks))
    seen = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "known")]).first()
    ends = learning_docs(blocks).first()["n"]
    every, distinct = seen["total"] + ends, seen["known"] + (ends > 0)
    model = spark.sparkContext.broadcast(learn(blocks))

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = counts.where("range >= 0").repartition(tasks, "block").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("range", "c"))).alias("found"))
    joined = model_columns(blocks, "rows").repartition(tasks, "block").join(found, "block", "left")
    held = joined.schema["rows"].dataType.elementType
    kind = StructType([StructField("row", held), *StructType.fromDDL(
        "learns boolean, n_tokens long, n_known long, train_tokens long, base_score double, n_subwords long, score double"
    ).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                c = np.frombuffer(b"".join(f["c"] for f in b.column("found")[k].as_py() or []), np.int64)
                rows, at = b.column("rows")[k].values, 0
                logs10 = np.log10(c + 1)
                for part in block_rows([b.slice(k, 1)]):
                    n = part.n_words + 1
                    logs = np.concatenate([[0], np.cumsum(logs10[part.numbers])])
                    known = np.concatenate([[0], np.cumsum((c > 0)[part.numbers])])
                    lo = part.ends - part.n_words
                    base = logs[part.ends] - logs[lo] + np.log10(ends + 1) - n * np.log10(every + distinct + 1)
                    p = log_probabilities(model.value, part)
                    yield pa.RecordBatch.from_arrays(
                        [rows.slice(at, len(n)), pa.array(part.learns), pa.array(n.astype(np.int64)),
                         pa.array((known[part.ends] - known[lo] + (ends > 0)).astype(np.int64)),
                         pa.array(np.full(len(n), every, np.int64)), pa.array(base),
                         pa.array(part.lengths.astype(np.int64)),
                         pa.array(np.add.reduceat(p, np.cumsum(part.lengths) - part.lengths) / np.log(10))],
                        names=kind.names)
                    at += len(n)

    return joined.mapInArrow(run, kind)


def learning_docs(blocks: DataFrame) -> DataFrame:
    """Learning documents, counted from the blocks' flags."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(int(np.frombuffer(x, bool).sum()) for b in batches for x in b.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    return blocks.select("learns").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
