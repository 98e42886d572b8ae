"""Nearest neighbours by a block matrix join with int8 tiles and exact error bounds.

Vectors are packed into blocks: queries into rows of ``QUERY_BLOCK``,
candidates into rows of ``CANDIDATE_BLOCK``.  A block holds, for each vector,
its int8 code q with a scale s (x is near s*q), the norm r of what the code
leaves out (x - s*q), and the original numbers.  A tile is one query block
against one candidate block.  Tiles are dealt out on a grid: every candidate
block is sent once for each group of query blocks and every query block once
for each group of candidate blocks, so a tile group meets in one task of
bounded size and the number of tasks grows with the data.

In a tile one integer matrix product gives all distances between the coded
vectors; the triangle inequality bounds the true distance to within r of the
query plus r of the candidate.  The k-th smallest upper bound of a query is a
limit that none of its k nearest can exceed, so pairs whose lower bound lies
above it are dropped without loss.  The survivors' distances are recomputed
from the original vectors in double precision.

Each query keeps a heap of k per task; the heaps of all tasks are merged by
query.  Ties go to the smaller vector id, so the result is exact.

The products of int8 codes are formed in single precision, which is exact as
long as every sum stays below 2**24, that is for up to 1,040 dimensions; wider
vectors are summed in slices of 1,024.

Defined results: a vector that is null, empty, all zero, or holds a null or
non-finite component takes no part; so does one without an id, or whose number
of components is not that of the query.  A query with fewer than k candidates
gets all of them.  A repeated row (same id, same vector) is one query and one
candidate, so copies never push others out of a list.  Different vectors under
one id are all candidates, but never of a query with that id; as queries each
has a list of its own.  Distances beyond double precision are infinite and
rank last, by id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import stage

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
GROUP_QUERIES = 8
GROUP_CANDIDATES = 8
SLICE = 1024

BLOCK = "block long, dim int, ids binary, values binary"
# ``query`` and ``mark`` tell vectors under one id apart.
FOUND = "query_id long, query long, vec_id long, mark long, score double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>, dim) of the vectors that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(
        ~bad & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Pack rows into blocks of one dimension; a block's number is unique."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        n = 0

        def packed(dim: int, ids: list, parts: list) -> pa.RecordBatch:
            nonlocal n
            n += 1
            number = (TaskContext.get().partitionId() << 32) + n
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(parts, np.float64).tobytes()], pa.binary())], names=["block", "dim", "ids", "values"])

        for b in batches:
            for i, v, dim in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids, parts = held.setdefault(dim, ([], []))
                ids.append(i)
                parts.append(v)
                if len(ids) >= size:
                    yield packed(dim, *held.pop(dim))
        for dim, (ids, parts) in held.items():
            yield packed(dim, ids, parts)

    return rows.select("vec_id", "v", "dim").mapInArrow(run, BLOCK)


class Coded:
    """One block's distinct rows: ids, original vectors and their marks, int8 codes, scales, squared code norms, residual norms."""

    def __init__(self, ids: bytes, values: bytes, dim: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.x = np.frombuffer(values, np.float64).reshape(-1, dim) + 0.0  # -0.0 is 0.0
        self.marks = np.array([xxhash.xxh3_64_intdigest(v) for v in self.x], np.uint64).view(np.int64)
        _, first = np.unique(np.stack([self.ids, self.marks], axis=1), axis=0, return_index=True)
        if len(first) < len(self.ids):
            first.sort()
            self.ids, self.x, self.marks = self.ids[first], self.x[first], self.marks[first]
        top = np.abs(self.x).max(axis=1)
        self.scale = np.maximum(top, np.finfo(np.float64).tiny) / 127
        self.code = np.rint(self.x / self.scale[:, None]).astype(np.int8)
        whole = self.code.astype(np.float64)
        self.square = (whole * whole).sum(axis=1) * self.scale * self.scale
        self.rest = np.sqrt(((self.x - whole * self.scale[:, None]) ** 2).sum(axis=1))


def int8_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows."""
    out = np.zeros((len(q), len(c)), np.float64)
    for at in range(0, q.shape[1], SLICE):
        out += q[:, at:at + SLICE].astype(np.float32) @ c[:, at:at + SLICE].astype(np.float32).T
    return out


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, components added in order."""
    return np.sqrt(np.cumsum((x - y) ** 2, axis=1)[:, -1])


def survivors(query: Coded, candidate: Coded, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (its row): the rows and exact distances of the candidates that may be among its k nearest."""
    product = int8_products(query.code, candidate.code) * query.scale[:, None] * candidate.scale[None, :]
    square = query.square[:, None] + candidate.square[None, :]
    # Rounding of the coded distance itself is covered by a margin relative to the terms it is made of.
    between = np.sqrt(np.maximum(square - 2 * product, 0))
    margin = query.rest[:, None] + candidate.rest[None, :] + 1e-6 * np.sqrt(square)
    own = query.ids[:, None] == candidate.ids[None, :]
    # A bound that overflowed (not a number) limits nothing and drops nothing.
    upper = np.where(own | np.isnan(between + margin), np.inf, between + margin)
    if upper.shape[1] > k:
        limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
    else:
        limit = np.full(len(upper), np.inf)
    keep = ~(between - margin > limit[:, None]) & ~own
    for i in np.flatnonzero(keep.any(axis=1)):
        at = np.flatnonzero(keep[i])
        yield i, at, exact(np.broadcast_to(query.x[i], (len(at), query.x.shape[1])), candidate.x[at])


def tile(query: Coded, candidate: Coded, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``survivors`` with the candidates' ids."""
    for i, at, score in survivors(query, candidate, k):
        yield i, candidate.ids[at], score


def smallest(held: list, more, k: int) -> list:
    """The k smallest of both; equal entries are one."""
    return heapq.nsmallest(k, {*held, *more})


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of all rows for every row that ``is_query`` holds for.

    ``is_query`` is an expression over the column ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    cores = spark.sparkContext.defaultParallelism
    candidates = stage(blocks(rows, candidate_block))
    queries = stage(blocks(rows.where(is_query).coalesce(cores), query_block))
    n_query, n_candidate = queries.count(), candidates.count()
    # Fewer candidates in a group when there are few blocks, so that all cores get a tile group.
    wide = max(1, min(GROUP_CANDIDATES, n_candidate // (2 * cores)))
    across, down = max(1, -(-n_query // GROUP_QUERIES)), max(1, -(-n_candidate // wide))

    # Both sides' keys must be of one type: Spark hashes an int and a long apart, so tile groups would not meet.
    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("block"), F.lit(parts)).cast("long")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))

    left = queries.withColumn("g", dealt(across)).withColumn("h", every(down))
    right = candidates.withColumn("h", dealt(down)).withColumn("g", every(across))

    def search(key, own, others):
        heaps: dict[tuple, list] = {}
        queries: dict[int, list[Coded]] = {}
        for ids, values, dim in zip(*(own.column(c).to_pylist() for c in ("ids", "values", "dim"))):
            queries.setdefault(dim, []).append(Coded(ids, values, dim))
        for ids, values, dim in zip(*(others.column(c).to_pylist() for c in ("ids", "values", "dim"))):
            if dim not in queries:
                continue
            other = Coded(ids, values, dim)
            for query in queries[dim]:
                for i, at, score in survivors(query, other, k):
                    name = int(query.ids[i]), int(query.marks[i])
                    more = zip(score.tolist(), other.ids[at].tolist(), other.marks[at].tolist())
                    heaps[name] = smallest(heaps.get(name, ()), more, k)
        return found_table(heaps)

    partial = left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInArrow(search, FOUND)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, list] = {}
        for b in batches:
            found: dict[tuple, list] = {}
            for q, of, v, mark, x in zip(*(c.to_pylist() for c in b.columns)):
                found.setdefault((q, of), []).append((x, v, mark))
            for name, more in found.items():
                heaps[name] = smallest(heaps.get(name, ()), more, k)
        flat = [(q, r, v, x) for (q, _), heap in heaps.items() for r, (x, v, _) in enumerate(heap, 1)]
        for at in range(0, len(flat), 50_000):
            q, r, v, s = zip(*flat[at:at + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(r, pa.int32()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                names=["query_id", "rank", "vec_id", "score"])

    return partial.repartition("query_id").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


def found_table(heaps: dict[tuple, list]) -> pa.Table:
    rows = [(*name, v, mark, x) for name, heap in heaps.items() for x, v, mark in heap]
    columns = list(zip(*rows)) or [()] * 5
    return pa.table({field.split()[0]: pa.array(column, pa.float64() if field.endswith("double") else pa.int64())
                     for field, column in zip(FOUND.split(", "), columns)})
