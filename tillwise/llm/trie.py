"""Prefix trie of conversations by range minima over sorted common prefixes.

Conversations are sorted by the digests of their turns, equal ones by id; a node of depth d is then a run of rows whose
neighbours have d turns or more in common. A chunk of the sorted rows builds sparse tables of range minima over the common
prefix lengths (and over the ids). Every candidate prefix finds the ends of its run by two binary searches of its own,
independently of the others and without a stack; sums over the run are differences of running sums.

Runs that touch the first or last row of a chunk may go on in the next one. These nodes, two paths a chunk, are added up by
the digest of their prefix, with what the border between two chunks adds: the turns saved there, and the leaf that ends there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.llm.common import slices, stored

DIGEST = 16               # bytes of a turn's digest
CHUNK_TURNS = 400_000     # turns of a chunk: bounds a worker's memory, but for one longer conversation
PIECE = 4096              # ids of one text in the list of a node's members
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
WORD = "[^\\x20\\x09-\\x0D]+"

_PARTS = {"kind": "string", "key": "binary", "parent_key": "binary", "conv_id": "long", "depth": "int", "parent_conv_id": "long", "n_convs": "long",
          "n_children": "long", "n_leaves": "long", "saved_tokens": "long", "ends_sha256": "string", "part": "int", "chunk": "int", "piece": "int",
          "ids": "string", "first": "binary", "first_tokens": "array<long>", "last": "binary"}
_ARROW = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``seq`` (the digests of its turns, one after another), ``tokens`` (words per turn): the first h turns of the
    conversation ``conv_id - conv_id % 20``, then the own turns after the first h; h = crc32(conv_id) % 4.

    Turns are ordered by ``turn``, null first, turns of one number by their digest. Rows without a ``conv_id`` are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("own"))  # 24 bytes a turn, no text
    own = stored(own.select("conv_id", F.transform("own", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("own"),
                            (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 4).cast("int").alias("h")), "conversations")
    heads = own.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("own", 1, 3).alias("head"))
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("base"), "left")
    after = F.when(F.size("own") > F.col("h"), F.slice("own", F.col("h") + 1, F.size("own"))).otherwise(F.slice("own", 1, 0))
    seq = F.concat(F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h"))).otherwise(F.slice("own", 1, 0)), after)
    whole = joined.select("conv_id", seq.alias("seq"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("seq", lambda t: t["digest"]), "")).alias("seq"),
                        F.transform("seq", lambda t: t["words"]).alias("tokens"))


def common(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with in common."""
    most = min(len(a), len(b)) // DIGEST
    low = 0
    while low < most:
        step = (low + most + 1) // 2
        if a[low * DIGEST:step * DIGEST] == b[low * DIGEST:step * DIGEST]:
            low = step
        else:
            most = step - 1
    return low


def path_keys(seq: bytes) -> list[bytes]:
    """A 128-bit key for every prefix, the empty one first; each is formed from the one before."""
    out = [bytes(DIGEST)]
    for at in range(0, len(seq), DIGEST):
        out.append(xxhash.xxh3_128_digest(out[-1] + seq[at:at + DIGEST]))
    return out


class RangeMinimum:
    """Sparse table: level k holds the minimum of 2^k values from each position on."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The minima of the values from ``a`` to ``b``, both inclusive."""
        out = np.empty(len(a), self.levels[0].dtype)
        level = np.frexp(b - a + 1)[1] - 1
        for k, values in enumerate(self.levels):
            at = level == k
            out[at] = np.minimum(values[a[at]], values[b[at] - (1 << k) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """How far to the right of each row all neighbours have ``depth`` or more in common: powers of two, largest first."""
        at = at.copy()
        for k, values in reversed(list(enumerate(self.levels))):
            fits = at + (1 << k) < len(self.levels[0])
            go = fits & (values[np.where(fits, at + 1, 0)] >= depth)
            at += go * (1 << k)
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The same to the left. Value i stands between rows i - 1 and i."""
        at = at.copy()
        for k, values in reversed(list(enumerate(self.levels))):
            fits = at - (1 << k) >= 0
            go = fits & (values[np.where(fits, at - (1 << k) + 1, 0)] >= depth)
            at -= go * (1 << k)
        return at


def chunk_nodes(ids: list[int], seqs: list[bytes], tokens: list[list[int]], part: int, chunk: int) -> Iterator[dict]:
    """Nodes of one chunk of sorted rows: ``node`` is whole, ``open`` may go on in another chunk, ``ends`` holds the members of
    an open node that end there, ``edge`` the chunk's first and last row."""
    n = len(ids)
    lens = np.asarray([len(s) // DIGEST for s in seqs])
    lcp = np.asarray([-1] + [common(a, b) for a, b in zip(seqs, seqs[1:])])
    at = np.cumsum(lens + 1) - (lens + 1)   # place of a row in the running word counts, each row's with a 0 before it
    running = np.concatenate([np.concatenate(([0], np.cumsum(t, dtype=np.int64))) for t in tokens]).astype(np.int64)
    saved = np.concatenate(([0], np.cumsum(np.where(lcp >= 0, running[at + np.maximum(lcp, 0)], 0))))
    leaf = np.append(lcp[1:] < lens[:-1], False)  # whether the chunk's last row is a leaf is for the border to say
    leaves = np.concatenate(([0], np.cumsum(leaf)))
    shared, numbers = RangeMinimum(lcp), RangeMinimum(np.asarray(ids, np.int64))
    fresh = lens - lcp                      # prefixes that a row is the first to have
    base = np.cumsum(fresh) - fresh
    row = np.repeat(np.arange(n), fresh)
    depth = np.arange(fresh.sum()) - base[row] + lcp[row] + 1
    first, last = shared.left(row, depth), shared.right(row, depth)
    before = np.where(depth > 0, running[at[first] + np.maximum(depth - 1, 0)], 0)
    conv = numbers.least(first, last)
    is_open = (first == 0) | (last == n - 1)
    up = shared.left(row, depth - 1)
    parent = np.where(depth > 0, base[up] + depth - 1 - lcp[up] - 1, -1)
    children = np.bincount(parent[(parent >= 0) & ~is_open], minlength=len(row))
    members, leaf_count = last - first + 1, leaves[last + 1] - leaves[first]
    spared = saved[last + 1] - saved[first + 1] - (last - first) * before
    ends_here = lens[first] == depth
    paths = {0: path_keys(seqs[0]), n - 1: path_keys(seqs[-1])}

    def key(node: int) -> bytes:  # only for open nodes: they are on one of the two paths
        return paths[0 if first[node] == 0 else n - 1][depth[node]]

    yield {"kind": "edge", "part": part, "chunk": chunk, "first": seqs[0], "first_tokens": tokens[0], "last": seqs[-1]}
    for node in range(len(row)):
        out = {"conv_id": int(conv[node]), "depth": int(depth[node]), "n_convs": int(members[node]), "n_children": int(children[node]),
               "n_leaves": int(leaf_count[node]), "saved_tokens": int(spared[node])}
        above = int(parent[node])
        if above >= 0:
            out["parent_key" if is_open[above] else "parent_conv_id"] = key(above) if is_open[above] else int(conv[above])
        mine: list[str] = []
        if ends_here[node]:
            end = a = int(first[node])
            while end <= last[node] and lens[end] == depth[node]:
                end += 1
            mine = [str(i) for i in ids[a:end]]
        if not is_open[node]:
            yield {"kind": "node", "ends_sha256": hashlib.sha256(",".join(mine).encode()).hexdigest() if mine else EMPTY_SHA, **out}
            continue
        yield {"kind": "open", "key": key(node), **out}
        for piece in range(0, len(mine), PIECE):
            yield {"kind": "ends", "key": key(node), "part": part, "chunk": chunk, "piece": piece // PIECE, "ids": ",".join(mine[piece:piece + PIECE])}


def _table(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], _ARROW[t]) for c, t in _PARTS.items()], names=list(_PARTS))


def _scan(batches: Iterator[pa.RecordBatch], chunk_turns: int) -> Iterator[pa.RecordBatch]:
    part, chunk, turns = TaskContext.get().partitionId(), 0, 0
    ids, seqs, tokens = [], [], []
    for batch in slices(batches):
        for i, s, t in zip(*(c.to_pylist() for c in batch.columns)):
            ids.append(i)
            seqs.append(s)
            tokens.append(t)
            turns += len(t) + 1
            if turns >= chunk_turns:
                yield _table(list(chunk_nodes(ids, seqs, tokens, part, chunk)))
                chunk, turns, ids, seqs, tokens = chunk + 1, 0, [], [], []
    if ids:
        yield _table(list(chunk_nodes(ids, seqs, tokens, part, chunk)))


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the border after a chunk adds to the nodes on its two sides: keys, saved tokens, leaves."""
    for batch in batches:
        for last, after, tokens in zip(*(c.to_pylist() for c in batch.columns)):
            shared = -1 if after is None else common(last, after)
            keys, saved, leaf = path_keys(last), [], []
            whole = np.concatenate(([0], np.cumsum(tokens or [], dtype=np.int64)))
            for d in range(len(keys)):
                saved.append(int(whole[shared] - whole[max(d - 1, 0)]) if d <= shared else 0)
                leaf.append(int(shared < len(keys) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(saved, pa.int64()), pa.array(leaf, pa.int64())],
                                             names=["key", "saved_tokens", "n_leaves"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of each key. Rows come in order and go one by one, so that the longest list needs no memory."""
    now, sha = None, hashlib.sha256()

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    for batch in slices(batches):
        for key, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "ids"))):
            if key != now:
                if now is not None:
                    yield done()
                now, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
    if now is not None:
        yield done()


def prefix_trie(conversations: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """One row per distinct sequence of the first d turns of the rebuilt conversations, the empty one included:
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Null roles and texts are empty; repeated rows are turns of their own; other columns are not read. Without any
    conversation there is no row. A conversation is one row of 24 bytes a turn from the sort on (texts stay behind), and the
    hash over the members that end at one node reads them in order, piece by piece.
    """
    schema = ", ".join(f"{c} {t}" for c, t in _PARTS.items())
    rows = stored(rebuilt(conversations), "rebuilt")
    ordered = rows.repartitionByRange(F.col("seq"), F.col("conv_id")).sortWithinPartitions("seq", "conv_id")
    parts = stored(ordered.mapInArrow(lambda b: _scan(b, chunk_turns), schema), "trie-parts")
    order = W.orderBy("part", "chunk")  # one row a chunk
    edges = parts.where("kind = 'edge'").select("last", F.lead("first").over(order).alias("after"), F.lead("first_tokens").over(order).alias("tokens"))
    borders = edges.mapInArrow(_borders, "key binary, saved_tokens long, n_leaves long")
    pieces = parts.where("kind = 'ends'").select("key", "part", "chunk", "piece", "ids").repartition("key").sortWithinPartitions("key", "part", "chunk", "piece")
    digests = pieces.mapInArrow(_digests, "key binary, ends_sha256 string")
    some = parts.where("kind = 'open'").select("key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
    whole = some.unionByName(borders, allowMissingColumns=True).groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    whole = stored(whole.join(digests, "key", "left"), "open-nodes")
    below = whole.groupBy("parent_key").agg(F.count("*").alias("open_children")).withColumnRenamed("parent_key", "key")
    whole = whole.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
    out = ["conv_id", "depth", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = whole.select(*out, F.lit(None).cast("long").alias("parent_conv_id")).unionByName(parts.where("kind = 'node'").select(*out, "parent_conv_id"))
    above = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    known, asked = nodes.where("parent_key is null"), nodes.where("parent_key is not null")
    met = known.withColumn("above", F.lit(None).cast("long")).unionByName(asked.join(above, "parent_key", "left"))
    return met.select("conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs",
                      "n_children", "n_leaves", "saved_tokens", "ends_sha256")
