"""Benchmark decontamination: BM25 over an inverted index of test items, searched by block-max WAND.

Every training passage is a query.  A passage is two consecutive chunks of a
document's words, a chunk being as long as the longest item (64 words at
least), and a passage starts at every chunk, so an item that stands in a
document stands whole in one of its passages.

Index.  Words of the items (lower case, ASCII punctuation as space) have
postings of (item, impact).  The impact is the BM25 weight divided by the
item's own score, so a passage's score is the share of the item's weight that
it covers and one threshold serves all items.  Postings are cut into blocks
that know their largest impact.

Search.  All items at or above the threshold are retrieved, none is cut off:

* chunk bounds: the items are grouped into runs of similar length, first few
  runs, then more (``GROUPS``); each word's largest impact in each run is
  summed over a passage's words for whole batches of passages at once.  A
  passage whose bound is below the threshold in every run cannot retrieve
  anything, whatever the benchmark's size;
* block-max WAND walks the postings of the others: the pivot is the first item
  whose summed upper bounds reach the threshold, its blocks' maxima are
  checked before anything is scored, and whole blocks are skipped.

Verification.  A retrieved item counts only if its question and its answer
both stand in the passage: at least ``overlap`` (0.8) of the five-word shingles
of each.  The question ends at the last question mark, the rest is the answer.
An item without a question mark, or without words on one side of it, is one
part: ``overlap`` of the whole item's shingles must stand there, and its answer
is empty, with an overlap of 1.

The index is built of item shards of bounded bytes, each broadcast in turn, so
a benchmark of any size works; document frequencies are counted over all items
by Spark.  The documents are only scanned: no shuffle, no key.

Defined results: null or empty texts and items match nothing; an item shorter
than a shingle is one shingle; equal items are all reported; empty tables give
an empty result; documents with the same id are reported each on their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import extended

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
MIN_CHUNK = 64
BLOCK = 8
GROUPS = (32, 256)
SHARD_BYTES = 8 << 20
BATCH_WORDS = 65_536
GATHERED = 1 << 20
SLACK = 1e-9

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(PLAIN).split()


def parts_of(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of an item; all its words and nothing if it does not have both."""
    cut = text.rfind("?") + 1
    question, answer = words_of(text[:cut]), words_of(text[cut:])
    return (question, answer) if question and answer else (words_of(text), [])


def shingles(words: list[bytes]) -> set:
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def share(part: list[bytes], words: list[bytes]) -> float:
    """Share of the part's shingles that stand in the words (1 for an empty part)."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    n = min(SHINGLE, len(part))
    there = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
    return len(wanted & there) / len(wanted)


class Index:
    """Inverted index of one shard of items, with normalised BM25 impacts."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[bytes, int], n_items: int, mean_words: float):
        split = [(k, t, words_of(t)) for k, t in items]
        split = sorted((x for x in split if x[2]), key=lambda x: (len(x[2]), x[0] is None, x[0] or 0, x[1]))
        self.ids = [x[0] for x in split]
        self.parts = [parts_of(x[1]) for x in split]
        self.longest = max((len(x[2]) for x in split), default=0)
        self.vocabulary: dict[bytes, int] = {}
        found: list[list[tuple[int, float]]] = []
        for i, (_, _, words) in enumerate(split):
            weights = {}
            for w in set(words):
                tf, df = words.count(w), frequency[w]
                idf = math.log(1 + (n_items - df + 0.5) / (df + 0.5))
                weights[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            own = math.fsum(weights.values())
            for w, x in weights.items():
                t = self.vocabulary.setdefault(w, len(self.vocabulary))
                if t == len(found):
                    found.append([])
                found[t].append((i, x / own))
        self.items = [[i for i, _ in p] for p in found]
        self.impact = [[x for _, x in p] for p in found]
        self.bound = [max(p) for p in self.impact]
        self.block_max = [[max(p[k:k + BLOCK]) for k in range(0, len(p), BLOCK)] for p in self.impact]
        self.group_max = []
        for groups in GROUPS:
            size = max(1, -(-len(split) // groups))
            largest = np.zeros((len(found), max(1, -(-len(split) // size))), np.float32)
            for t, p in enumerate(found):
                for i, x in p:
                    largest[t, i // size] = max(largest[t, i // size], np.float32(x))
            self.group_max.append(largest)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item number, score) of all items that score at least the threshold, by block-max WAND."""
        end = len(self.ids)
        floor = threshold - SLACK
        at = {t: 0 for t in terms}

        def item(t: int) -> int:
            return self.items[t][at[t]] if at[t] < len(self.items[t]) else end

        def advance(t: int, to: int) -> None:
            k, postings = at[t], self.items[t]
            while k < len(postings) and postings[min(k | (BLOCK - 1), len(postings) - 1)] < to:
                k = (k | (BLOCK - 1)) + 1  # the whole block lies before the target
            while k < len(postings) and postings[k] < to:
                k += 1
            at[t] = k

        out = []
        while True:
            order = sorted((i, t) for t in terms if (i := item(t)) < end)
            total, pivot = 0.0, -1
            for k, (_, t) in enumerate(order):
                total += self.bound[t]
                if total >= floor:
                    pivot = k
                    break
            if pivot < 0:
                return out
            target = order[pivot][0]
            while pivot + 1 < len(order) and order[pivot + 1][0] == target:
                pivot += 1
            head = [t for _, t in order[:pivot + 1]]
            bound, leave = 0.0, end
            for t in head:
                postings, k = self.items[t], at[t]
                while k < len(postings) and postings[min(k | (BLOCK - 1), len(postings) - 1)] < target:
                    k = (k | (BLOCK - 1)) + 1
                if k < len(postings):
                    bound += self.block_max[t][k // BLOCK]
                    leave = min(leave, postings[min(k | (BLOCK - 1), len(postings) - 1)] + 1)
            if bound < floor:
                if pivot + 1 < len(order):
                    leave = min(leave, order[pivot + 1][0])
                leave = max(leave, target + 1)
                for t in head:
                    advance(t, leave)
            elif order[0][0] == target:
                score = math.fsum(self.impact[t][at[t]] for t in head)
                if score >= floor:
                    out.append((target, score))
                for t in head:
                    advance(t, target + 1)
            else:
                for t in head:
                    advance(t, target)


def batches_of(texts: Iterable[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Runs of split texts of bounded word number (a shorter text counts as a chunk); a long text is split whole."""
    at, held, n = 0, [], 0
    for k, t in enumerate(texts):
        words = words_of(t)
        held.append(words)
        n += max(len(words), MIN_CHUNK)
        if n >= BATCH_WORDS:
            yield at, held
            at, held, n = k + 1, [], 0
    if held:
        yield at, held


def passages(docs: list[list[bytes]], index: Index, chunk: int, threshold: float) -> Iterator[tuple[int, int, list]]:
    """(document number, first word, terms) of every passage whose bound reaches the threshold."""
    sizes = np.array([len(w) for w in docs], np.int64)
    if not sizes.sum() or not index.ids:
        return
    term = np.fromiter(map(index.vocabulary.get, chain.from_iterable(docs), repeat(-1)), np.int64, int(sizes.sum()))
    chunks = -(-sizes // chunk)
    first = np.cumsum(chunks) - chunks
    place = np.arange(len(term)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    of = np.repeat(first, sizes) + place // chunk
    known = term >= 0
    width = len(index.vocabulary)
    key = np.unique(of[known] * width + term[known])
    where, what = key // width, key % width
    n = int(chunks.sum())
    edge = np.searchsorted(where, np.arange(n + 1))
    doc = np.repeat(np.arange(len(docs)), chunks)
    same = np.append(doc[1:] == doc[:-1], False)
    open_at = np.ones(n, bool)
    for largest in index.group_max:
        needed = open_at | np.insert(open_at[:-1] & same[:-1], 0, False)
        used = np.flatnonzero(needed & (edge[1:] > edge[:-1]))
        if not len(used):
            return
        terms = what[needed[where]]
        ends = np.cumsum(edge[used + 1] - edge[used])
        bound = np.zeros((n, largest.shape[1]), np.float32)
        lo = 0
        while lo < len(used):  # rows of the table are gathered for some chunks at a time, one at least
            passed = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, passed + GATHERED // largest.shape[1], side="right")))
            starts = np.concatenate([[passed], ends[lo:hi - 1]]) - passed
            bound[used[lo:hi]] = np.add.reduceat(largest[terms[passed:ends[hi - 1]]], starts, axis=0)
            lo = hi
        bound[:-1] += np.where(same[:-1, None], bound[1:], 0)
        # Single precision sums are off by far less than this margin.
        open_at &= bound.max(axis=1) >= threshold - 1e-3
    for k in np.flatnonzero(open_at):
        last = k + 1 if same[k] else k
        terms = sorted(set(what[edge[k]:edge[last + 1]].tolist()))
        yield int(doc[k]), int(k - first[doc[k]]) * chunk, terms


def matches(docs: list[list[bytes]], index: Index, chunk: int, threshold: float, overlap: float) -> dict:
    """(document number, item number) -> (score, question share, answer share, first word), the best passage's."""
    out: dict = {}
    for d, start, terms in passages(docs, index, chunk, threshold):
        words = docs[d][start:start + 2 * chunk]
        for i, score in index.search(terms, threshold):
            question, answer = index.parts[i]
            q, a = share(question, words), share(answer, words)
            if q >= overlap and a >= overlap:
                new = (min(1.0, score), q, a, -start)
                if new > out.get((d, i), (-1.0,)):
                    out[d, i] = new
    return out


def shards_of(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, dict, int, float]]:
    """Shards of the items with the document frequencies of their words, the number of items, the mean length."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            split = [words_of(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(w) for w in split], pa.int64()),
                 pa.array([[x.decode("utf-8", "replace") for x in sorted(set(w))] for w in split],
                          pa.list_(pa.string()))], names=["n", "words"])

    texts = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    lengths = texts.select("text").mapInArrow(counted, "n long, words array<string>").where("n > 0")
    total = lengths.agg(F.count(F.lit(1)).alias("items"), F.avg("n").alias("mean")).first()
    if not total["items"]:
        return
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    frequency = lengths.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))
    for k in range(shards):
        rows = texts.where(shard == k).collect()
        own = sorted({w.decode("utf-8", "replace") for r in rows for w in words_of(r["text"])})
        wanted = items.sparkSession.createDataFrame([(w,) for w in own], "word string")
        found = {r["word"].encode(): r["df"] for r in frequency.join(wanted, "word").collect()}
        yield [(r["item_id"], r["text"]) for r in rows if r["text"]], found, total["items"], total["mean"]


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
                 overlap: float = OVERLAP) -> DataFrame:
    """One row for each document and each test item that stands in it.

    Returns (row struct of the document's columns without the text, item_id,
    score, question_overlap, answer_overlap, first_word).
    """
    keep = [docs[f"`{c}`"] for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*keep).alias("row"), docs[f"`{text_col}`"].alias("text"))
    kind = extended(rows.select("row"), "item_id long, score double, question_overlap double, answer_overlap double, "
                                        "first_word long")
    out = None
    for members, frequency, n_items, mean in shards_of(items, item_col, item_text):
        index = Index(members, frequency, n_items, mean)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        found = rows.mapInArrow(searcher(shared, max(MIN_CHUNK, index.longest), threshold, overlap), kind)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], kind)


def searcher(shared, chunk: int, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            for at, split in batches_of(x.as_py() for x in b.column(1)):
                hits = matches(split, index, chunk, threshold, overlap)
                if hits:
                    at_row, item, values = zip(*((at + d, index.ids[i], v) for (d, i), v in sorted(hits.items())))
                    score, q, a, start = zip(*values)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(at_row)), pa.array(item, pa.int64()), pa.array(score, pa.float64()),
                         pa.array(q, pa.float64()), pa.array(a, pa.float64()),
                         pa.array([-s for s in start], pa.int64())],
                        names=["row", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

    return run


def uncontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` in which no test item stands, unchanged; decided row by row, so ids play no part."""
    at = docs.columns.index(text_col)
    out = docs
    for members, frequency, n_items, mean in shards_of(items, item_col, item_text):
        index = Index(members, frequency, n_items, mean)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        out = out.mapInArrow(sieve(shared, at, max(MIN_CHUNK, index.longest), threshold, overlap), docs.schema)
    return out


def sieve(shared, column: int, chunk: int, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            clean = np.ones(b.num_rows, bool)
            for at, split in batches_of(x.as_py() for x in b.column(column)):
                for d, _ in matches(split, index, chunk, threshold, overlap):
                    clean[at + d] = False
            yield b.filter(pa.array(clean))

    return run
