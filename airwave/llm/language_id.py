"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 in ``DIM`` dimensions, drawn from
a generator seeded with the letter's code point, so every task draws the same
one.  A 3-gram's vector binds (multiplies) its letters' vectors, the first
rotated by two places, the second by one.  A text's vector bundles (adds) its
3-gram vectors; a language's prototype bundles those of all its learning texts.
A text gets the language whose prototype has the largest cosine with it.

Texts are lower-cased; whatever is not a letter counts as one boundary symbol,
which has a vector of its own; 3-grams are centred on a letter.  A bundle is
computed as counts of 3-grams times their vectors, in blocks of texts and
3-grams, so memory is bounded for any alphabet and text length.

Learning: each task adds up its texts' integer vectors by language; Spark sums
them by (language, dimension) with map-side combine.  Integers make the sums
independent of order.  The model is one vector for each language.

Defined results: a null text or one without a letter is ``und`` with score 0;
equal cosines go to the alphabetically first language; the score is the cosine,
at least 0; without any learned language every text is ``und``.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import extended, rows_of

DIM = 1024
SEED = 20240229
CHUNK_CHARS = 1_000_000
CHUNK_TEXTS = 256
GRAM_BLOCK = 4096
UND = "und"
NO_LETTER = re.compile(r"\W")


def letter_vector(code: int) -> np.ndarray:
    """The random vector of a letter; code 0 is the boundary."""
    return np.random.Generator(np.random.Philox(key=[SEED, code])).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


class Grams:
    """Turns texts into (text number, 3-gram) counts and 3-grams into vectors."""

    def __init__(self):
        self.vectors: dict[int, np.ndarray] = {}
        self.is_letter: dict[int, bool] = {}

    def vector(self, code: int) -> np.ndarray:
        if code not in self.vectors:
            self.vectors[code] = letter_vector(code)
        return self.vectors[code]

    def letter(self, code: int) -> bool:
        if code not in self.is_letter:
            self.is_letter[code] = unicodedata.category(chr(code))[0] == "L"
        return self.is_letter[code]

    def bundles(self, texts: list[str], owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
        """(owners x DIM) bundles of the texts, each added to its owner's; and each owner's 3-gram count."""
        parts = [f"\n{t.lower()}\n" for t in texts]
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        of = np.repeat(owner.astype(np.int32), [len(p) for p in parts])
        present = np.flatnonzero(np.bincount(codes))
        letters = np.array([c for c in present if self.letter(int(c))], dtype=np.int64)
        lookup = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.int64)
        lookup[letters] = np.arange(1, len(letters) + 1)
        s = lookup[codes]
        mid = np.flatnonzero(s[1:-1])
        base = len(letters) + 1
        gram = (s[mid] * base + s[mid + 1]) * base + s[mid + 2]
        of = of[mid + 1].astype(np.int64)
        del codes
        if base ** 3 <= 1 << 22:
            seen = np.flatnonzero(np.bincount(gram, minlength=1))
            rank = np.zeros(base ** 3, np.int64)
            rank[seen] = np.arange(len(seen))
            gram = rank[gram]
        else:
            seen, gram = np.unique(gram, return_inverse=True)
        out = np.zeros((owners, DIM), np.float64)
        table = np.stack([self.vector(0), *(self.vector(int(c)) for c in letters)])
        first, second = np.roll(table, 2, axis=1), np.roll(table, 1, axis=1)
        for lo in range(0, len(seen), GRAM_BLOCK):
            block = seen[lo:lo + GRAM_BLOCK]
            vectors = first[block // (base * base)] * second[block // base % base] * table[block % base]
            here = (gram >= lo) & (gram < lo + GRAM_BLOCK) if len(seen) > GRAM_BLOCK else slice(None)
            counts = np.bincount(of[here] * len(block) + gram[here] - lo, minlength=owners * len(block))
            # Exact in single precision: whole numbers below 2**24 (a chunk has fewer 3-grams than that).
            out += counts.reshape(owners, -1).astype(np.float32) @ vectors.astype(np.float32)
        return out, np.bincount(of, minlength=owners)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of bounded number and length; a long text is a run of its own."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if k > at and (size + n > CHUNK_CHARS or k - at >= CHUNK_TEXTS):
            yield at, [x or "" for x in texts[at:k]]
            at, size = k, 0
        size += n
    if at < len(texts):
        yield at, [x or "" for x in texts[at:]]


def pieces(text: str) -> list[str]:
    """A very long text cut at characters that are no letters, which changes no 3-gram."""
    out, at = [], 0
    while len(text) - at > CHUNK_CHARS and (stop := NO_LETTER.search(text, at + CHUNK_CHARS)):
        out.append(text[at:stop.start()])
        at = stop.start()
    return [*out, text[at:]]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each language: the bundle of all texts that carry it."""
    rows = docs.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = Grams(), {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at, some in chunks(texts):
                own = langs[at:at + len(some)]
                names = sorted(set(own))
                slot = {name: k for k, name in enumerate(names)}
                cut = [(slot[name], p) for t, name in zip(some, own) for p in pieces(t)]
                for lo in range(0, len(cut), CHUNK_TEXTS):
                    part = cut[lo:lo + CHUNK_TEXTS]
                    got, _ = grams.bundles([p for _, p in part], np.array([k for k, _ in part]), len(names))
                    for name, k in slot.items():
                        sums[name] = sums.get(name, 0) + got[k]
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([sums[k].astype(np.int64).tolist() for k in names],
                                                    pa.list_(pa.int64()))], names=["lang", "v"])

    sums = rows.mapInArrow(run, "lang string, v array<long>").select("lang", F.posexplode("v").alias("i", "x"))
    out: dict[str, np.ndarray] = {}
    for r in sums.groupBy("lang", "i").agg(F.sum("x").alias("x")).collect():
        out.setdefault(r["lang"], np.zeros(DIM))[r["i"]] = r["x"]
    return out


def predict(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """(row struct of the input's columns, lang_pred string, score double)."""
    rows = rows_of(docs)
    kind = extended(rows, "lang_pred string, score double")
    names = sorted(model)
    prototypes = np.stack([model[k] / max(np.linalg.norm(model[k]), 1e-300) for k in names]) if names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in batches:
            langs, scores = [], []
            for _, some in chunks(b.column(0).field(text_col).to_pylist()):
                cut = [(k, p) for k, t in enumerate(some) for p in pieces(t)]
                vectors, counts = grams.bundles([p for _, p in cut], np.array([k for k, _ in cut]), len(some))
                norm = np.linalg.norm(vectors, axis=1)
                known = (norm > 0) & (counts > 0) & (prototypes is not None)
                cosine = (vectors @ prototypes.T if names else np.zeros((len(some), 1))) / np.maximum(norm, 1e-300)[
                    :, None]
                best = cosine.argmax(axis=1)
                langs += [names[j] if ok else UND for j, ok in zip(best, known)]
                scores += [float(min(1.0, max(0.0, row[j]))) if ok else 0.0 for row, j, ok in zip(cosine, best, known)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, kind)


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text, modulo ``folds``, is ``fold`` (a null id is never held out)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
