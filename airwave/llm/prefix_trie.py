"""Prefix trie of conversations by vertical bitmaps.

A conversation is its turns in order; a node at depth d stands for a distinct
sequence of first d turns, the root for the empty one.

Turns are reduced to a 128-bit digest of (role, text) and the text's length in
bytes, so texts are read once and never shuffled.  All rows are sorted by
(conversation, place) over range partitions, with a mark before and after each
conversation.  Each task reads its sorted rows as a stream and closes a *shard*
every ``SHARD_CONVS`` conversations or ``SHARD_ROWS`` rows:

* **Index.** (position, turn) -> bitset of the shard's conversations, and
  position -> bitset of those that end there.
* **Depth-first intersection.** A node is its members' bitset.  The lowest
  member not yet served names a turn; the intersection of the parent's bitset
  with that turn's posting is a child.  Popcounts, smallest member and the list
  of conversations that end in a node come from the bitsets.

Shards share nodes, and a node's key is the same in all of them (a polynomial
hash of its turns' digests modulo the prime 2**127 - 1).  One exchange by key
brings a node's parts together, at most a few rows from each shard, in shard
order, and streams them: members are added, end lists (ascending, as shards
are) run through SHA-256.  The part of the first shard is the node's *owner*.
A second exchange returns each part to its shard, where owners' values are
added up from the leaves to the root; a last aggregate by key adds the shards'
sums.  Every group is bounded by a shard's size, whatever turn, text, first
turn or conversation is frequent.

A conversation longer than a shard, or cut by a range partition, goes on in the
next shard as a chain of its own: the chain starts with a copy (of no members)
of the node where it was cut.  A chain that starts in another partition is
keyed relative to its start; the starts, one row for each partition, are put
together on the driver.  What lies in later pieces of a cut conversation is
added to the earlier pieces by a window over its pieces.

Defined results: rows without a conversation id take no part; null role or text
counts as empty; null turns come first; equal turn numbers go by role, the
text's first 64 characters, then digest; repeated rows are repeated turns; an
empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import stage

SHARD_CONVS = 4096
SHARD_ROWS = 65_536
HEAD = 64
LAST = (1 << 63) - 1
PRIME = (1 << 127) - 1
BASE = 0x2F0B4C47D1A6E95B8C3D7F1E5A90B3C7

PARTS = ("shard long, local int, parent int, key binary, depth long, conv_id long, members long, bytes long, "
         "ends array<bigint>, started boolean, tail_of long, chain_of long")
MERGED = ("shard long, local int, parent int, key binary, depth long, first_conv long, tail_of long, chain_of long, "
          "n_convs long, n_ends long, ends_sha256 string, leaves long, saved long")
SUMS = ("key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_ends long, ends_sha256 string, "
        "children long, leaves long, saved long")


@dataclass
class Trie:
    """``nodes``: one row for each node; ``ends``: (node_key, shard, conv_ids) lists of the conversations ending there."""

    nodes: DataFrame
    ends: DataFrame


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, head, digest, bytes) of every row with a conversation id."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"), F.unhex(F.substring(digest, 1, 32)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, bytes), numbered over range partitions: a long conversation spans several.

    A task numbers what it holds; the conversation that goes on from an earlier
    partition gets its offset from a table of one row for each partition.
    """
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest")]
    ordered = rows.repartitionByRange(tasks(rows), *keys).sortWithinPartitions(*keys).select("conv_id", "digest", "bytes")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last, held = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])
            place = np.arange(1, len(ids) + 1) - np.repeat(first, np.diff([*first, len(ids)]))
            if ids[0] == last:
                place[ids == last] += held
            last, held = ids[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.int64()),
                                              pa.array(np.full(len(ids), run, np.int32))],
                                             names=["conv_id", "digest", "bytes", "place", "run"])

    placed = stage(ordered.mapInArrow(count, "conv_id long, digest binary, bytes long, place long, run int"))
    edges = placed.groupBy("run").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place")).alias("last"))
    offsets, before, held = [], None, 0
    for e in sorted(edges.collect()):  # one row for each range partition
        if e["first"] == before:
            offsets.append((e["run"], before, held))
        else:
            held = 0
        held = e["last"]["place"] + (held if e["first"] == e["last"]["conv_id"] else 0)
        before = e["last"]["conv_id"]
    shifts = rows.sparkSession.createDataFrame(offsets, "run int, conv_id long, shift long")
    return placed.join(F.broadcast(shifts), ["run", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("shift", F.lit(0))).alias("place"), "digest", "bytes")


class Piece:
    """What a shard holds of one conversation; ``started`` if its beginning is here."""

    __slots__ = ("conv", "started", "ended", "depth", "key", "power", "digests", "sizes")

    def __init__(self, conv: int, started: bool, depth: int = 0, key: int = 0, power: int = 1):
        self.conv, self.started, self.ended = conv, started, False
        self.depth, self.key, self.power = depth, key, power
        self.digests: list[bytes] = []
        self.sizes: list[int] = []


class Parts:
    """The nodes of one shard, in an order in which parents come first."""

    def __init__(self, shard: int, absolute: bool):
        self.shard, self.absolute = shard, absolute
        self.rows: list[tuple] = []

    def add(self, parent: int, key: int, depth: int, conv: int, members: int, size: int, ends: list[int],
            absolute: bool = True, tail_of: int | None = None, chain_of: int | None = None) -> int:
        self.rows.append((self.shard, len(self.rows), parent, key.to_bytes(16, "big"), depth, conv, members, size,
                          ends or None, absolute, tail_of, chain_of))
        return len(self.rows) - 1


def step(key: int, power: int, digest: bytes) -> tuple[int, int]:
    """Key and power of the child that a turn leads to."""
    power = power * BASE % PRIME
    return (key + int.from_bytes(digest, "big") * power) % PRIME, power


def chain(parts: Parts, piece: Piece, absolute: bool) -> None:
    """The nodes of a conversation that began in an earlier shard: a copy of the cut node, then its turns."""
    key, power, depth = piece.key, piece.power, piece.depth
    last = len(piece.digests)
    cut = None if piece.ended else piece.conv
    at = parts.add(-1, key, depth, piece.conv, 0, 0, [piece.conv] if piece.ended and not last else [], absolute,
                   cut if not last else None)
    for k, (digest, size) in enumerate(zip(piece.digests, piece.sizes), 1):
        key, power = step(key, power, digest)
        depth += 1
        at = parts.add(at, key, depth, piece.conv, 1, size, [piece.conv] if piece.ended and k == last else [], absolute,
                       cut if k == last else None, piece.conv)


def search(parts: Parts, pieces: list[Piece]) -> None:
    """Depth-first over the conversations that begin in this shard: parent bitset AND posting = child."""
    index: dict[tuple[int, bytes], int] = {}
    ending: dict[int, int] = {}
    for i, p in enumerate(pieces):
        bit = 1 << i
        for d, digest in enumerate(p.digests, 1):
            index[d, digest] = index.get((d, digest), 0) | bit
        if p.ended:
            ending[len(p.digests)] = ending.get(len(p.digests), 0) | bit
    cut = next((i for i, p in enumerate(pieces) if not p.ended), None)
    todo = [((1 << len(pieces)) - 1, 0, 0, 1, -1, 0)]
    while todo:
        bits, depth, key, power, parent, size = todo.pop()
        low = (bits & -bits).bit_length() - 1
        done = bits & ending.get(depth, 0)
        rest, ends = bits & ~done, []
        while done:
            bit = done & -done
            ends.append(pieces[bit.bit_length() - 1].conv)
            done ^= bit
        tail = None
        if cut is not None and bits >> cut & 1 and len(pieces[cut].digests) == depth:
            tail = pieces[cut].conv
            rest &= ~(1 << cut)
        at = parts.add(parent, key, depth, pieces[low].conv, bits.bit_count(), size, ends, True, tail)
        while rest:
            named = pieces[(rest & -rest).bit_length() - 1]
            digest = named.digests[depth]
            child = rest & index[depth + 1, digest]
            rest ^= child
            todo.append((child, depth + 1, *step(key, power, digest), at, named.sizes[depth]))


def shard_parts(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The nodes of all shards of one range partition; a last row (local -1) tells where a cut conversation stands."""
    run, number = TaskContext.get().partitionId(), 0
    pieces: list[Piece] = []
    rows, absolute = 0, True

    def close() -> pa.RecordBatch:
        nonlocal pieces, rows, number
        parts = Parts(run << 32 | number, absolute)
        fresh = [p for p in pieces if p.started]
        for p in pieces:
            if not p.started:
                chain(parts, p, absolute)
        if fresh:
            search(parts, fresh)
        number, rows = number + 1, 0
        pieces = []
        return table_of(parts.rows)

    def table_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def onward(p: Piece) -> Piece:
        """The start of the next piece of a conversation that is cut here."""
        key, power = p.key, p.power
        for digest in p.digests:
            key, power = step(key, power, digest)
        return Piece(p.conv, False, p.depth + len(p.digests), key, power)

    at = None
    for b in batches:
        ids, places = b.column("conv_id").to_pylist(), b.column("place").to_pylist()
        digests, sizes = b.column("digest").to_pylist(), b.column("bytes").to_pylist()
        for conv, place, digest, size in zip(ids, places, digests, sizes):
            if place == 0:
                at = Piece(conv, True)
                pieces.append(at)
            elif at is None:  # goes on from another partition: keyed relative to an unknown start
                at, absolute = Piece(conv, False), False
                pieces.append(at)
            if place == LAST:
                at.ended = True
            elif place:
                at.digests.append(digest)
                at.sizes.append(size)
            rows += 1
            if rows >= SHARD_ROWS or (len(pieces) >= SHARD_CONVS and at.ended):
                following = None if at.ended else onward(at)
                begun = absolute or at.started
                yield close()
                absolute = begun
                if following is not None:
                    at = following
                    pieces.append(at)
    if pieces:
        last = None if at.ended else onward(at)
        begun = absolute or at.started
        yield close()
        if last is not None:
            yield table_of([(run << 32 | number, -1, -1, last.key.to_bytes(16, "big"), last.depth, last.conv, 0, 0,
                             None, begun, None, None)])


def started_at(parts: DataFrame) -> dict[int, tuple[int, int]]:
    """partition -> (depth, key) at which the conversation that a later partition goes on with was cut."""
    edges = parts.where("local = -1").select("shard", "started", "depth", "key").collect()  # at most one for each partition
    depth, key, out = 0, 0, {}
    for e in sorted(edges):
        own = int.from_bytes(e["key"], "big")
        if e["started"]:
            depth, key = e["depth"], own
        else:
            depth, key = depth + e["depth"], (key + pow(BASE, depth, PRIME) * own) % PRIME
        out[e["shard"] >> 32] = depth, key
    return out


def rekeyed(parts: DataFrame) -> DataFrame:
    """Parts with absolute depths and keys."""
    starts = started_at(parts)
    known, runs = parts.where("local >= 0 AND started"), sorted(starts)

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            depths, keys = [], []
            for shard, depth, key in zip(b.column("shard").to_pylist(), b.column("depth").to_pylist(),
                                         b.column("key").to_pylist()):
                of = runs[np.searchsorted(runs, shard >> 32) - 1]
                depth0, key0 = starts[of]
                depths.append(depth0 + depth)
                keys.append(((key0 + pow(BASE, depth0, PRIME) * int.from_bytes(key, "big")) % PRIME).to_bytes(16, "big"))
            at = b.schema.get_field_index
            yield b.set_column(at("depth"), b.schema.field("depth"), pa.array(depths, pa.int64())).set_column(
                at("key"), b.schema.field("key"), pa.array(keys, pa.binary()))

    return known.unionByName(parts.where("local >= 0 AND NOT started").mapInArrow(shift, parts.schema))


def merge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the parts of each node in shard order: the first one, its owner, gets the node's totals."""
    own, totals, digest = None, None, None
    out: list[tuple] = []

    def finish() -> None:
        n_convs, n_ends = totals
        out.append((*own[:8], n_convs, n_ends, digest.hexdigest(), int(n_convs == n_ends), (n_convs - 1) * own[8]))

    def table_of() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.int64()]
        names = [f.split()[0] for f in MERGED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    for b in batches:
        for r in zip(*[b.column(c).to_pylist() for c in ("shard", "local", "parent", "key", "depth", "conv_id", "tail_of",
                                                         "chain_of", "bytes", "members", "ends")]):
            if own is None or r[3] != own[3]:
                if own is not None:
                    finish()
                own, totals, digest = r, [0, 0], hashlib.sha256()
            else:
                out.append((*r[:5], own[5], *r[6:8], None, None, None, 0, 0))
            totals[0] += r[9]
            if r[10]:
                digest.update(("," if totals[1] else "").encode() + ",".join(map(str, r[10])).encode())
                totals[1] += len(r[10])
        if out:
            yield table_of()
            out = []
    if own is not None:
        finish()
        yield table_of()


def beyond(merged: DataFrame) -> DataFrame:
    """(shard, local, leaves, saved): what the later pieces of a cut conversation hold, for the node above the cut."""
    tails = merged.where("tail_of IS NOT NULL").select("shard", "parent", F.col("tail_of").alias("conv"))
    held = merged.where("chain_of IS NOT NULL").groupBy(F.col("chain_of").alias("conv"), "shard").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    later = Window.partitionBy("conv").orderBy(F.desc("shard")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = tails.join(held, ["conv", "shard"], "full").select(
        "shard", F.col("parent").alias("local"), F.sum("leaves").over(later).alias("leaves"),
        F.sum("saved").over(later).alias("saved"))
    return pieces.where("local >= 0 AND leaves IS NOT NULL")


def upsweep(t: pa.Table) -> pa.Table:
    """Adds up one shard's nodes from the leaves to the root; parents stand before their children."""
    extra = t.filter(pa.compute.is_null(t.column("key")))
    t = t.filter(pa.compute.is_valid(t.column("key"))).sort_by("local")
    leaves, saved = t.column("leaves").to_pylist(), t.column("saved").to_pylist()
    for at, x, y in zip(*[extra.column(c).to_pylist() for c in ("local", "leaves", "saved")]):
        leaves[at] += x
        saved[at] += y
    parent, owned = t.column("parent").to_pylist(), t.column("n_convs").to_pylist()
    children, first = [0] * len(parent), t.column("first_conv").to_pylist()
    above = [None if p < 0 or n is None else first[p] for p, n in zip(parent, owned)]
    for k in range(len(parent) - 1, -1, -1):
        if (p := parent[k]) >= 0:
            leaves[p] += leaves[k]
            saved[p] += saved[k]
            children[p] += owned[k] is not None
    own = pa.array([n is not None for n in owned], pa.bool_())
    nothing = pa.nulls(len(parent), pa.int64())
    out = pa.table({
        "key": t.column("key"), "conv_id": pa.compute.if_else(own, t.column("first_conv"), nothing),
        "depth": pa.compute.if_else(own, t.column("depth"), nothing), "parent_conv_id": pa.array(above, pa.int64()),
        "n_convs": t.column("n_convs"), "n_ends": t.column("n_ends"), "ends_sha256": t.column("ends_sha256"),
        "children": pa.array(children, pa.int64()), "leaves": pa.array(leaves, pa.int64()),
        "saved": pa.array(saved, pa.int64())})
    return out


def nodes(turns: DataFrame, members: DataFrame) -> Trie:
    """Trie of conversations given as (conv_id, place, digest, bytes), places from 1 up to below 2**63 - 1.

    ``members``: the distinct conversation ids, those without turns included.
    """
    marks = members.select("conv_id", F.explode(F.array(F.lit(0), F.lit(LAST))).alias("place")).select(
        "conv_id", "place", F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    every = turns.select("conv_id", "place", "digest", "bytes").unionByName(marks)
    n = tasks(turns)
    ordered = every.repartitionByRange(n, "conv_id", "place").sortWithinPartitions("conv_id", "place")
    schema = pa.schema([("shard", pa.int64()), ("local", pa.int32()), ("parent", pa.int32()), ("key", pa.binary()),
                        ("depth", pa.int64()), ("conv_id", pa.int64()), ("members", pa.int64()), ("bytes", pa.int64()),
                        ("ends", pa.list_(pa.int64())), ("started", pa.bool_()), ("tail_of", pa.int64()),
                        ("chain_of", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return shard_parts(batches, schema)

    parts = rekeyed(stage(ordered.mapInArrow(run, PARTS)))
    merged = stage(parts.repartition(n, "key").sortWithinPartitions("key", "shard", "conv_id", "local").mapInArrow(
        merge_parts, MERGED))
    returned = merged.unionByName(beyond(merged), allowMissingColumns=True)
    summed = returned.groupBy("shard").applyInArrow(upsweep, SUMS)
    found = summed.groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "ends_sha256")],
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = parts.where("ends IS NOT NULL").select(F.col("key").alias("node_key"), "shard", F.col("ends").alias("conv_ids"))
    return Trie(found.withColumnRenamed("key", "node_key"), ends)


def prefix_trie(conversations: DataFrame) -> Trie:
    """Trie of a table with conv_id, turn, role and text."""
    turns = numbered(turn_rows(conversations))
    return nodes(turns, turns.where("place = 1").select("conv_id"))


def with_shared_heads(turns: DataFrame, group: int, head: F.Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Numbered turns in which conversation c starts with turns of conversation c - c % ``group``.

    ``head`` (a column over ``conv_id``, at most ``most``) tells how many: c's own
    turns up to that place give way to as many of the other's (all it has, if
    fewer).  Returns the turns, in new places, and the conversation ids.
    """
    members = turns.where("place = 1").select("conv_id")
    lent = turns.where((F.col("conv_id") % group == 0) & (F.col("place") <= most)).withColumnRenamed("conv_id", "lender")
    borrowed = members.where(F.col("conv_id") % group != 0).withColumn(
        "lender", F.col("conv_id") - F.col("conv_id") % group).join(lent, "lender").where(F.col("place") <= head)
    own = turns.where((F.col("conv_id") % group == 0) | (F.col("place") > head)).withColumn("place", F.col("place") + most)
    columns = ["conv_id", "place", "digest", "bytes"]
    return borrowed.select(*columns).unionByName(own.select(*columns)), members
