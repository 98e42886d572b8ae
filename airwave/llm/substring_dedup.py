"""Substring deduplication by level-wise doubling.

A window is ``min_words`` consecutive words of one text.  Every window whose
word sequence also starts earlier (smaller document id, or earlier in the same
document) is a repeat, and the words it covers are removed.

Method.  Windows are examined level by level, each level twice as long as the
one before:

* Level 1 (half the length).  Each text is cut into words, words into 64-bit
  hashes, and hashes into windows by doubling (a window of 2n words is the mix
  of two windows of n words).  Only anchors travel: the smallest half-length
  window inside each full window.  Equal full windows have equal anchors, so a
  full window can only repeat if its anchor does.
* Level 2 (full length).  Only windows around an anchor that occurs at least
  twice are extended to the full length and compared, by 96 hash bits.
* ``longest_repeats`` goes on doubling (2x, 4x, ...) with the windows that
  repeated at the level before, until no candidate survives.

Distribution.  Documents are dealt into blocks of about ``block_bytes`` of
text by a hash of their id.  A block sends each *distinct* hash once, sorted
and packed, to a bucket given by the hash's leading bits; a bucket answers
each block with one bit per hash.  A passage that stands in a third of all
documents therefore costs a bucket one entry per block, never one per
document, so no key is hot.  Buckets and blocks both grow with the input, so
memory per task stays the same.  The text is shuffled once: all levels read
the same exchange.

Defined results: a null text has no words; a text shorter than the window
keeps all words; rows without an id come after all others; rows with the same
id are ordered by their text; an empty table gives an empty result.  Extra
columns travel in the struct column ``row`` and cannot clash.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import drop_stage, extended, fmix, rows_of, stage

BLOCK_BYTES = 8 << 20
BUCKET_HASHES = 2_000_000
PIECE = 65_536
LAST = np.iinfo(np.int64).max

HASHES = "block long, bucket long, level int, a binary, b binary, doc binary, docs binary"
ANSWERS = "block long, bucket long, level int, bits binary"


def windows(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` entries of ``h``, by doubling."""
    m = 1
    while m < n:
        step = min(m, n - m)
        if len(h) <= step:
            return h[:0]
        h = fmix(h[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
                 + (h[step:] ^ (h[step:] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(m))
        m += step
    return h


def sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over all runs of ``n`` entries, by doubling."""
    m = 1
    while m < n:
        step = min(m, n - m)
        if len(x) <= step:
            return x[:0]
        x = pick(x[:-step], x[step:])
        m += step
    return x


class Block:
    """The documents of one block, in (id, text) order, as one array of word hashes.

    The words themselves are not held: as objects they take many times the text.
    Rows and texts stay the Arrow buffers they came in.  What is computed for
    every word is computed for ``PIECE`` of them at a time, so that a task holds
    one number a word and what it found.
    """

    def __init__(self, rows: pa.Table, id_col: str, text_col: str):
        self.row = rows.column("row").combine_chunks()
        self.texts = self.row.field(text_col).cast(pa.binary())
        ids = [LAST if i is None else i for i in self.row.field(id_col).to_pylist()]
        twice = Counter(ids)
        self.order = sorted(range(len(ids)), key=lambda k: (ids[k], self.text(k) if twice[ids[k]] > 1 else b""))
        self.ids = np.array([ids[k] for k in self.order], dtype=np.int64)
        hashes, self.end = array("Q"), np.empty(len(ids), np.int64)
        for at, k in enumerate(self.order):
            hashes.extend(map(xxhash.xxh3_64_intdigest, self.text(k).split()))
            self.end[at] = len(hashes)
        self.n = np.diff(self.end, prepend=0)
        self.h = np.frombuffer(hashes, np.uint64)

    def text(self, k: int) -> bytes:
        return self.texts[k].as_py() or b""

    def doc(self, at: np.ndarray) -> np.ndarray:
        """Which documents positions lie in."""
        return np.searchsorted(self.end, at, side="right")

    def starts(self, at: np.ndarray, n: int) -> np.ndarray:
        """Which positions start a run of n words inside one document."""
        return at + n <= self.end[self.doc(at)]

    def anchors(self, full: int) -> tuple[np.ndarray, np.ndarray]:
        """Half-length windows that are the smallest within some full window: positions and hashes."""
        half = (full + 1) // 2
        span = full - half + 1
        places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for lo in range(0, len(self.h), PIECE):
            left = max(0, lo - span + 1)
            base = windows(self.h[left:lo + PIECE + full - 1], half)
            least = sliding(base, span, np.minimum)
            if not len(least):
                continue
            least = np.where(self.starts(np.arange(left, left + len(least)), full), least, np.uint64(0))
            pad = np.zeros(span - 1, np.uint64)
            best = sliding(np.concatenate([pad, least, pad]), span, np.maximum)
            at = np.flatnonzero((best == base)[:lo + PIECE - left])
            at = at[at >= lo - left]
            places.append(at + left)
            hashes.append(base[at])
        return np.concatenate(places), np.concatenate(hashes)

    def near(self, at: np.ndarray, full: int) -> np.ndarray:
        """Starts of full windows that contain a half-length window starting at one of the (ascending) positions."""
        span = full - (full + 1) // 2 + 1
        first = np.maximum(at - span + 1, np.concatenate([[0], at[:-1] + 1])) if len(at) else at
        size = at + 1 - first
        found = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        return found[self.starts(found, full)]

    def wide(self, at: np.ndarray, n: int) -> np.ndarray:
        """96-bit hashes of the runs of n words at (ascending) positions, as records that sort by both lanes."""
        out = np.empty(len(at), dtype=[("a", "<u8"), ("b", "<u4")])
        step = max(PIECE, n)
        for lo in range(0, len(self.h), step):
            i, j = np.searchsorted(at, [lo, lo + step])
            if i < j:
                h, here = self.h[lo:lo + step + n - 1], at[i:j] - lo
                out["a"][i:j] = windows(h, n, 1)[here]
                out["b"][i:j] = windows(h, n, 2)[here] >> np.uint64(32)
        return out


def cut(a: np.ndarray, buckets: int) -> np.ndarray:
    """Borders of the buckets in a sorted array of 64-bit hashes."""
    edges = (np.arange(1, buckets, dtype=object) << 64) // buckets
    return np.concatenate([[0], np.searchsorted(a, np.array(edges, dtype=np.uint64)), [len(a)]]).astype(np.int64)


def answered(unique: np.ndarray, buckets: int, answers: dict) -> np.ndarray:
    """The buckets' bits, in the order of the block's sorted distinct hashes."""
    out = np.zeros(len(unique), dtype=bool)
    edge = cut(unique["a"] if unique.dtype.names else unique, buckets)
    for k, bits in answers.items():
        lo, hi = edge[k], edge[k + 1]
        out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(hi - lo)).astype(bool)
    return out


def packed(block: int, level: int, unique: np.ndarray, docs: np.ndarray | None, buckets: int) -> Iterator[dict]:
    """One row per bucket: the block's distinct hashes there, and the first document of each."""
    a = unique["a"] if unique.dtype.names else unique
    edge = cut(a, buckets)
    for k in range(buckets):
        lo, hi = edge[k], edge[k + 1]
        if lo == hi:
            continue
        row = {"block": block, "bucket": k, "level": level, "a": np.ascontiguousarray(a[lo:hi]).tobytes(),
               "b": None, "doc": None, "docs": None}
        if docs is not None:
            ids, index = np.unique(docs[lo:hi], return_inverse=True)
            kind = np.uint16 if len(ids) <= 65536 else np.uint32
            row |= {"b": np.ascontiguousarray(unique["b"][lo:hi]).tobytes(), "doc": index.astype(kind).tobytes(),
                    "docs": ids.tobytes()}
        yield row


def hash_table(rows: list[dict]) -> pa.Table:
    kinds = {"block": pa.int64(), "bucket": pa.int64(), "level": pa.int32(), "a": pa.binary(), "b": pa.binary(),
             "doc": pa.binary(), "docs": pa.binary()}
    return pa.table({c: pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()})


def recurring(members: pa.Table) -> pa.Table:
    """Bucket, first level: which hashes of each block stand in another block too."""
    blobs = [np.frombuffer(x, np.uint64) for x in members.column("a").to_pylist()]
    every = np.concatenate(blobs)
    order = np.argsort(every, kind="stable")
    twin = every[order[1:]] == every[order[:-1]]
    flag = np.zeros(len(every), bool)
    flag[order[1:][twin]] = True
    flag[order[:-1][twin]] = True
    return answer_table(members, blobs, flag)


def preceded(members: pa.Table) -> pa.Table:
    """Bucket, later levels: two bits per hash, stands in another block / in an earlier document elsewhere."""
    blobs = [np.frombuffer(x, np.uint64) for x in members.column("a").to_pylist()]
    a = np.concatenate(blobs)
    b = np.concatenate([np.frombuffer(x, np.uint32) for x in members.column("b").to_pylist()])
    doc = []
    for n, index, ids in zip(map(len, blobs), members.column("doc").to_pylist(), members.column("docs").to_pylist()):
        kind = np.uint16 if len(index) == 2 * n else np.uint32
        doc.append(np.frombuffer(ids, np.int64)[np.frombuffer(index, kind)])
    order = np.lexsort((np.concatenate(doc), b, a))
    a, b = a[order], b[order]
    twin = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    later = np.zeros(len(a), bool)
    later[order[1:][twin]] = True
    shared = later.copy()
    shared[order[:-1][twin]] = True
    both = np.empty(2 * len(a), bool)
    both[0::2], both[1::2] = shared, later
    return answer_table(members, blobs, both, 2)


def answer_table(members: pa.Table, blobs: list, flag: np.ndarray, width: int = 1) -> pa.Table:
    edge = np.concatenate([[0], np.cumsum([len(x) for x in blobs])]) * width
    bits = [np.packbits(flag[lo:hi]).tobytes() for lo, hi in zip(edge[:-1], edge[1:])]
    return pa.table({"block": members.column("block"), "bucket": members.column("bucket"),
                     "level": members.column("level"), "bits": pa.array(bits, pa.binary())})


def two_bits(unique: np.ndarray, buckets: int, answers: dict) -> tuple[np.ndarray, np.ndarray]:
    shared = np.zeros(len(unique), bool)
    later = np.zeros(len(unique), bool)
    edge = cut(unique["a"], buckets)
    for k, bits in answers.items():
        lo, hi = edge[k], edge[k + 1]
        got = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(2 * (hi - lo))).astype(bool)
        shared[lo:hi], later[lo:hi] = got[0::2], got[1::2]
    return shared, later


def by_level(answers: pa.Table) -> dict:
    out: dict = {}
    for bucket, level, bits in zip(*(answers.column(c).to_pylist() for c in ("bucket", "level", "bits"))):
        out.setdefault(level, {})[bucket] = bits
    return out


class Survivors:
    """The candidates of one level in one block: positions, distinct hashes, and first document of each."""

    def __init__(self, block: Block, at: np.ndarray, length: int):
        self.at = at
        hashes = block.wide(at, length)
        order = np.lexsort((at, hashes["b"], hashes["a"]))
        ranked = hashes[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        group = np.cumsum(fresh) - 1
        self.unique = ranked[fresh]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = group
        self.first = order[fresh]
        self.times = np.bincount(group, minlength=len(self.unique))
        self.docs = block.ids[block.doc(at[self.first])]

    def repeated(self, shared: np.ndarray) -> np.ndarray:
        """Positions of windows that occur at least twice in all blocks together."""
        return self.at[(shared | (self.times > 1))[self.of]]

    def repeats(self, later: np.ndarray) -> np.ndarray:
        """Positions of windows that also start earlier."""
        again = np.ones(len(self.at), bool)
        again[self.first] = False
        return self.at[again | later[self.of]]


def first_level(block: Block, full: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, their distinct hashes, which hash each has, how often each stands in this block."""
    at, hashes = block.anchors(full)
    unique, of, times = np.unique(hashes, return_inverse=True, return_counts=True)
    return at, unique, of, times


def second_level(block: Block, full: int, buckets: int, answers: dict) -> Survivors:
    at, unique, of, times = first_level(block, full)
    keep = (answered(unique, buckets, answers) | (times > 1))[of]
    return Survivors(block, block.near(at[keep], full), full)


def doubled(block: Block, repeated: np.ndarray, length: int) -> np.ndarray:
    """Starts of windows of twice the length whose halves both repeat."""
    both = np.intersect1d(repeated, repeated - length, assume_unique=True)
    return both[block.starts(both, 2 * length)]


class Plan:
    """The blocks and buckets of one run, sized from the input's bytes."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, min_words: int, block_bytes: int,
                 bucket_hashes: int):
        n = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
        blocks = max(1, -(-n // block_bytes))
        self.buckets = max(1, -(-n // (6 * bucket_hashes)))
        self.id_col, self.text_col, self.full = id_col, text_col, min_words
        self.rows = rows_of(docs).withColumn(
            "block", F.pmod(F.xxhash64(F.col(f"row.`{id_col}`")), F.lit(blocks)))

    def anchors(self) -> DataFrame:
        id_col, text_col, full, buckets = self.id_col, self.text_col, self.full, self.buckets

        def emit(key, rows):
            _, unique, _, _ = first_level(Block(rows, id_col, text_col), full)
            return hash_table(list(packed(key[0].as_py(), 0, unique, None, buckets)))

        hashes = self.rows.groupBy("block").applyInArrow(emit, HASHES)
        return hashes.groupBy("bucket").applyInArrow(recurring, ANSWERS)

    def level(self, answers: DataFrame, k: int) -> DataFrame:
        """Answers for windows of ``min_words * 2**(k-1)`` words, given those of all shorter ones."""
        id_col, text_col, full, buckets = self.id_col, self.text_col, self.full, self.buckets

        def emit(key, rows, got):
            if not rows.num_rows:
                return hash_table([])
            block, got = Block(rows, id_col, text_col), by_level(got)
            now = replay(block, got, full, buckets, k)
            return hash_table(list(packed(key[0].as_py(), k, now.unique, now.docs, buckets)))

        hashes = self.rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(emit, HASHES)
        return hashes.groupBy("bucket").applyInArrow(preceded, ANSWERS)


def replay(block: Block, answers: dict, full: int, buckets: int, k: int) -> Survivors:
    """The candidates of level k, from the answers to all levels below it."""
    now = second_level(block, full, buckets, answers.get(0, {}))
    length = full
    for level in range(1, k):
        shared, _ = two_bits(now.unique, buckets, answers.get(level, {}))
        now = Survivors(block, doubled(block, now.repeated(shared), length), 2 * length)
        length *= 2
    return now


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20,
                     block_bytes: int = BLOCK_BYTES, bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """Remove every word covered by a window of ``min_words`` words that also starts earlier.

    Returns (row struct of the input's columns, n_words long, n_removed long,
    kept_text string): the kept words joined by one space.
    """
    plan = Plan(docs, id_col, text_col, min_words, block_bytes, bucket_hashes)
    full, buckets = min_words, plan.buckets
    halves = plan.anchors()
    answers = halves.unionByName(plan.level(halves, 1))
    out = extended(plan.rows.select("row"), "n_words long, n_removed long, kept_text string")

    def finish(key, rows, got):
        block, got = Block(rows, id_col, text_col), by_level(got)
        now = replay(block, got, full, buckets, 1)
        _, later = two_bits(now.unique, buckets, got.get(1, {}))
        at = now.repeats(later)
        size = len(block.order)
        n_words, removed, texts = np.empty(size, np.int64), np.zeros(size, np.int64), [b""] * size
        cuts = np.searchsorted(at, np.concatenate([[0], block.end]))
        for k, n, end, i, j in zip(block.order, block.n, block.end, cuts[:-1], cuts[1:]):
            kept = block.text(k).split()
            n_words[k] = n
            if i < j:
                edge = np.zeros(n + 1, np.int64)
                edge[at[i:j] - (end - n)] += 1
                edge[at[i:j] - (end - n) + full] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                removed[k] = gone.sum()
                kept = [w for w, off in zip(kept, gone) if not off]
            texts[k] = b" ".join(kept)
        return pa.table({"row": block.row, "n_words": pa.array(n_words), "n_removed": pa.array(removed),
                         "kept_text": pa.array(texts, pa.binary()).cast(pa.string())})

    def guarded(key, rows, got):
        return finish(key, rows, got) if rows.num_rows else finish_nothing(rows)

    def finish_nothing(rows):
        return pa.table({"row": rows.column("row"), "n_words": pa.array([], pa.int64()),
                         "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})

    return plan.rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(guarded, out)


def longest_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20,
                    block_bytes: int = BLOCK_BYTES, bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """Double the length until no candidate survives: for each row the longest level at which it repeats.

    Returns (row, longest_repeat long): the largest ``min_words * 2**k`` such
    that some window of that many words of the row's text occurs at least twice
    in the table; 0 if none does.
    """
    plan = Plan(docs, id_col, text_col, min_words, block_bytes, bucket_hashes)
    full, buckets = min_words, plan.buckets
    answers = stage(plan.anchors())
    k = 0
    while True:
        k += 1
        found = stage(plan.level(answers, k))
        if found.isEmpty():
            drop_stage(found)
            break
        answers = answers.unionByName(found)
    depth = k
    out = extended(plan.rows.select("row"), "longest_repeat long")

    def finish(key, rows, got):
        if not rows.num_rows:
            return pa.table({"row": rows.column("row"), "longest_repeat": pa.array([], pa.int64())})
        block, got = Block(rows, id_col, text_col), by_level(got)
        best = np.zeros(len(block.n), np.int64)
        for level in range(1, depth):
            now = replay(block, got, full, buckets, level)
            shared, _ = two_bits(now.unique, buckets, got.get(level, {}))
            best[np.array(block.order)[np.unique(block.doc(now.repeated(shared)))]] = full << (level - 1)
        return pa.table({"row": block.row, "longest_repeat": pa.array(best, pa.int64())})

    return plan.rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, out)
