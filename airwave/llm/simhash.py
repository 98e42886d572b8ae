"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint.  A text is lower-cased (A-Z), cut into words and word shingles;
each shingle's XXH64 (seed 42) votes on 64 bits, and a bit is set where more
than half of the shingles set it.  Repeated shingles vote repeatedly.

Keys.  The 64 bits are cut into three segments.  Each segment, padded to 23
bits, is decoded with the binary Golay code [23, 12, 7]: to its centre, the one
codeword within 3 bits, and to every codeword within 4 bits (one if the centre
is at most 2 bits away, else six).  Words at most 2 bits apart share a codeword
within 4 bits; of words at most 1 bit apart, the centre of either is within 4
bits of the other.  Of at most 4 differing bits, pigeonhole leaves two cases:

* some segment is equal; then one of the other two differs in at most 2 bits:
  key (number, equal segment, codeword index of the other), 33 bits and more;
* every segment differs; then two of them differ in just 1 bit: key (number,
  two codeword indices), 24 bits, where one side sends its centres only.

Candidates are verified by their bit distance in the join itself.

Links.  Only distinct fingerprints take part, so exact copies cost nothing.  A
large group of near copies must not become all its pairs, hence two steps:

1. every fingerprint is compared with the least fingerprint of each of its keys
   of the first kind, which gives at most one link per key and fingerprint;
   components of these links are found by alternating stars;
2. keys that still hold several components are joined with themselves, on
   different components only, and the components are found again.

No link is lost: two fingerprints within the distance share a key, so they are
in one component after step 1 or linked in step 2.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; a text with fewer words than a shingle is one shingle; a null id
takes part in no component name (its ``component_id`` is the least non-null
id, or null if there is none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import binary_texts, drop_stage, extended, rows_of, stage
from airwave.llm.graph import components

MAX_BITS = 4

# Generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GOLAY = 0b101011100011

SEGMENTS = ((0, 22), (22, 21), (43, 21))


def fingerprint(text: bytes | None, shingle: int) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[i:j], 42) for i, j in zip(starts, stops)], dtype="<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        votes += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint of every whole text as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in binary_texts(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(row struct of the input's columns, fp)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in binary_texts(b.column(0).field(text_col))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["row", "fp"])

    rows = rows_of(docs)
    return rows.mapInArrow(run, extended(rows, "fp long"))


def remainder(x: np.ndarray) -> np.ndarray:
    """Syndrome of 23-bit words: the rest of the division by the generator polynomial."""
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= np.where(x >> bit & 1, GOLAY << (bit - 11), 0)
    return x


def coset_patterns(radius: int = 4) -> np.ndarray:
    """For each of the 2,048 syndromes the error patterns of at most ``radius`` bits, -1 where there are fewer."""
    patterns = np.array([sum(1 << p for p in places) for n in range(radius + 1)
                         for places in combinations(range(23), n)], dtype=np.int64)
    rest = remainder(patterns)
    out = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for p, s in zip(patterns, rest):
        out[s, filled[s]] = p
        filled[s] += 1
    return out


def nearby_indices(words: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """Codeword indices (12 bits) of every codeword near each 23-bit word; -1 fills the rest."""
    errors = patterns[remainder(words)]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


def golay_keys(fp: np.ndarray, patterns: np.ndarray, both_kinds: bool = True) -> Iterator[tuple]:
    """(keys, row numbers, whether the row may be the left side) by kind of key."""
    fp = fp.view(np.uint64)
    segment = [(fp >> np.uint64(lo) & np.uint64((1 << width) - 1)).astype(np.int64) for lo, width in SEGMENTS]
    near = [nearby_indices(x, patterns) for x in segment]
    row = np.arange(len(fp))
    for number, (i, j) in enumerate(permutations(range(len(SEGMENTS)), 2)):
        at, col = np.nonzero(near[j] >= 0)
        yield number << 34 | segment[i][at] << 12 | near[j][at, col], row[at], np.ones(len(at), bool)
    if both_kinds:
        for number, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2), 8):
            pairs = np.where((near[i] >= 0)[:, :, None] & (near[j] >= 0)[:, None, :],
                             near[i][:, :, None] << 12 | near[j][:, None, :], -1).reshape(len(fp), -1)
            at, col = np.nonzero(pairs >= 0)
            # The first pattern of a coset is its lightest, so column 0 holds both centres.
            yield number << 34 | pairs[at, col], row[at], col == 0


def keyed(fps: DataFrame, both_kinds: bool) -> DataFrame:
    """(key, fp, root, centre): the fuzzy hash keys of each fingerprint (fp, root).

    A fingerprint becomes about a hundred rows, so the input is spread out first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = coset_patterns()
        for b in batches:
            for at in range(0, b.num_rows, 20_000):
                fp, root = (b.column(k).slice(at, 20_000).to_numpy(zero_copy_only=False).astype(np.int64)
                            for k in (0, 1))
                for key, row, centre in golay_keys(fp, patterns, both_kinds):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(fp[row]), pa.array(root[row]), pa.array(centre)],
                        names=["key", "fp", "root", "centre"])

    spread = fps.select("fp", "root").repartition(
        int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    return spread.mapInArrow(run, "key long, fp long, root long, centre boolean")


def close(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def linked(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root): the component of each distinct fingerprint, named by its least fingerprint."""
    if not 0 <= max_bits <= 4:
        raise ValueError("three Golay segments find up to 4 differing bits")
    own_key = Window.partitionBy("key")
    heads = keyed(fps.select("fp", F.col("fp").alias("root")), False).select(
        "fp", F.min("fp").over(own_key).alias("head"))
    to_head = heads.where((F.col("fp") != F.col("head")) & close("fp", "head", max_bits)).select(
        F.col("fp").alias("a"), F.col("head").alias("b")).distinct()
    first = stage(components(to_head))
    named = stage(fps.join(first, fps.fp == first.node, "left").select("fp", F.coalesce("component", "fp").alias("root")))

    mixed = keyed(named, True).select(
        "*", F.min("root").over(own_key).alias("lo"), F.max("root").over(own_key).alias("hi"),
        F.max("centre").over(own_key).alias("any")).where("lo < hi AND any").select("key", "fp", "root", "centre")
    left = mixed.where("centre").select("key", F.col("fp").alias("x"), F.col("root").alias("a"))
    right = mixed.select("key", F.col("fp").alias("y"), F.col("root").alias("b"))
    rest = left.join(right, "key").where((F.col("a") < F.col("b")) & close("x", "y", max_bits)).select(
        "a", "b").distinct()
    second = stage(components(rest))
    out = named.join(second, named.root == second.node, "left").select(
        "fp", F.coalesce("component", "root").alias("root"))
    drop_stage(first)
    return out


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, component_id) of every distinct fingerprint."""
    marks = stage(fingerprints(docs, id_col, text_col, shingle))
    distinct = stage(marks.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = stage(linked(distinct, max_bits))
    least = distinct.join(roots, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    return marks, roots.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id reachable over links, itself included."""
    marks, names = grouped(docs, id_col, text_col, shingle, max_bits)
    # A hot fingerprint (a third of all rows) stays on its own tasks: names has one row for each.
    return marks.join(names.drop("root"), "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component, unchanged: the smallest id (none comes last), then the smallest text.

    Every row is judged by its own fingerprint, so ids may repeat or be null.
    Rows equal in both are ordered by their other columns.
    """
    marks, names = grouped(docs, id_col, text_col, shingle, max_bits)
    names = stage(names)
    marked = with_fingerprint(docs, text_col, shingle).withColumn("id", F.col(f"row.`{id_col}`").cast("long"))
    ordered = [text_col, *[c for c in docs.columns if c != text_col]]
    least = F.min(F.struct(*[F.col(f"row.`{c}`").alias(c) for c in ordered])).alias("row")

    named = marks.join(names, "fp").where("doc_id = component_id").select(
        F.col("doc_id").alias("id"), "fp", "root").distinct()
    first = marked.join(named, ["id", "fp"]).groupBy("root").agg(least)
    # Copies without an id may be many, so they are combined on the map side before they are joined.
    bare = marked.where("id IS NULL").groupBy("fp").agg(least).join(
        names.where("component_id IS NULL"), "fp").groupBy("root").agg(least)
    return first.unionByName(bare).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
