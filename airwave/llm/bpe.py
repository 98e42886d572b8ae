"""BPE encoding and decoding over a public tokenizer file.

Encoding follows the tokenizer's own steps: special tokens are cut out of the
raw text, the rest is normalised (NFC, lower case, character by character),
cut into pieces by the pre-tokenizer's pattern, mapped to byte symbols with
the word-end mark on the last one, and merged.

Merging one piece: its symbols form a doubly linked list; a priority queue
holds (merge rank, position, left id, right id) for each adjacent pair.  The
lowest rank is popped; an entry whose pair no longer stands at its position is
stale and skipped; otherwise the right symbol is unlinked, the left one takes
the merged id, and the two new neighbour pairs are queued.  A piece of n
symbols takes O(n log n), so a text without any space is no problem.  Pieces of
at most ``SCANNED`` symbols are merged by looking for the lowest rank (the
leftmost if equal) among the pairs each time, the same order without a queue.
Short pieces are remembered per task (a bounded memo; it changes no result).

Decoding concatenates the vocabulary strings of the ids, with the join string
that the file's decoder implies (a file without a decoder joins by a space).

The vocabulary file is read once on the driver, from a path parameter, and
broadcast: its size is fixed by the file, not by the data.

Defined results: a null text counts as empty and has no ids; an empty table
gives an empty result; extra columns travel in the struct column ``row``.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from airwave.llm.common import extended, rows_of

MEMO = 200_000
MEMO_LENGTH = 64
SCANNED = 16

NO_MERGE = (float("inf"), -1)

# The white space of the pattern's \s.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
ASCII_SPACE = r"\t\n\x0b\x0c\r "


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def load(path: str) -> dict:
    """What encoding and decoding need of a tokenizer file, as plain values."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, vocab = spec["model"], spec["model"]["vocab"]
    split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings = [""] * (1 + max([*vocab.values(), *special.values()]))
    for text, k in [*vocab.items(), *special.items()]:
        strings[k] = text
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
    if spec["decoder"] is not None:
        raise ValueError("only files without a decoder are supported")
    end = model["end_of_word_suffix"] or ""
    symbols = byte_symbols()
    return {"pattern": split, "special": special, "strings": strings, "merges": merges, "glue": " ",
            "inner": [vocab[s] for s in symbols], "last": [vocab[s + end] for s in symbols]}


class Memo(dict):
    """Ids of short pieces; a piece that is not there is merged.

    Two generations of half of MEMO: the older one goes when the younger is full, and what is asked for again stays.
    """

    def __init__(self, merge):
        super().__init__()
        self.merge, self.older = merge, {}

    def __missing__(self, piece: str) -> Sequence[int]:
        got = self.older.pop(piece, None) or self.merge(piece)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = got = tuple(got)  # tuples of numbers leave the garbage collector
        return got


class Codec:
    """Encodes and decodes whole texts with the loaded values."""

    def __init__(self, spec: dict):
        self.merges, self.strings, self.special = spec["merges"], spec["strings"], spec["special"]
        self.inner, self.last, self.glue = spec["inner"], spec["last"], spec["glue"]
        self.pieces = regex.compile(spec["pattern"].replace(r"\s", SPACE)).findall
        # ASCII texts need no Unicode classes, and the plain module is faster.
        plain = spec["pattern"].replace(r"\s", ASCII_SPACE).replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
        self.ascii_pieces = re.compile(plain).findall if r"\p" not in plain else self.pieces
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({marks})").split if marks else lambda text: [text]
        self.memo = Memo(self.merge)
        self.piece_ids = self.memo.__getitem__

    def merge(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n = len(ids)
        if n <= SCANNED:
            return self.scan(ids)
        after = [*range(1, n), -1]
        before = list(range(-1, n - 1))
        merges = self.merges
        queue = [(hit[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (hit := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # stale: one of the two has been merged meanwhile
            ids[i] = merges[left, right][1]
            ids[j] = -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (hit := merges.get((ids[a], ids[b]))):
                    heapq.heappush(queue, (hit[0], a, ids[a], ids[b]))
        return [k for k in ids if k >= 0]

    def scan(self, ids: list[int]) -> list[int]:
        """Merge a short piece: the ranks of its adjacent pairs in a list, the lowest taken each time."""
        find = self.merges.get
        hits = [find(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
        while hits:
            best = min(hits)
            if best is NO_MERGE:
                break
            i = hits.index(best)
            ids[i] = best[1]
            del ids[i + 1], hits[i]
            if i:
                hits[i - 1] = find((ids[i - 1], ids[i]), NO_MERGE)
            if i < len(hits):
                hits[i] = find((ids[i], ids[i + 1]), NO_MERGE)
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.cut(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                part = unicodedata.normalize("NFC", part)
                part = part.lower() if "Σ" not in part else "".join(map(str.lower, part))
                pieces = self.ascii_pieces(part) if part.isascii() else self.pieces(part)
                out.extend(chain.from_iterable(map(self.piece_ids, pieces)))
        return out

    def decode(self, ids) -> str:
        return self.glue.join(map(self.strings.__getitem__, ids))


def tokenize(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(row struct of the input's columns, ids array<int>, decoded string): encode, then decode the ids."""
    spec = docs.sparkSession.sparkContext.broadcast(load(path))
    rows = rows_of(docs)
    kind = extended(rows, "ids array<int>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value)
        for b in batches:
            row = b.column(0)
            texts = row.field(text_col)
            for at in range(0, b.num_rows, 256):
                ids = [codec.encode(t or "") for t in texts.slice(at, 256).to_pylist()]
                flat = pa.array(np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=sum(map(len, ids))))
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [row.slice(at, 256), pa.ListArray.from_arrays(pa.array(ends), flat),
                     pa.array([codec.decode(x) for x in ids], pa.string())], names=["row", "ids", "decoded"])

    return rows.mapInArrow(run, kind)
