"""Prefix trie of conversations from padded turn-id matrices.

A conversation is the sequence of its turns' ids (a digest of role and text). Conversations are dealt into
range shards by that sequence, so a shard holds neighbouring branches. Inside a shard numpy sorts the
padded matrix of turn ids by lexsort; a mask of the columns that change from one row to the next, OR-ed
along the columns, marks where the nodes of every depth begin, and reduceat aggregates them.

Only nodes on the path that a shard shares with the one before or after lie in several shards. Each shard
knows its neighbours' nearest sequences and counts what is first (children, a node's own saving) or last
(leaves) its own, so parts of such a node simply add up.

A conversation's ids (24 bytes a turn) must fit into one task. Conversations with the same turns are spread
over shards like any others; only the digest of their ids, a sequential one by nature, streams through one
task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import BYTES, LONG, SPACED_WORD, TEXT, ships_by_value, struct_of, text_of
from plumbline.operators.groups import attach_small
from plumbline.session import materialize

# A turn's record: 16 bytes of its digest, 8 bytes for the words of its text.
RECORD = 24
# Turns and conversations in a shard, on average; columns of the matrix that are sorted at a time.
SHARD_CELLS = 1 << 19
BAND = 8
# Conversation ids in one row of the digest's input.
CHUNK_IDS = 512

NODE = struct_of(
    conv_id=LONG, depth=LONG, parent_conv_id=LONG, n_convs=LONG, n_children=LONG, n_leaves=LONG,
    saved_tokens=LONG, ends_sha256=TEXT, turn_id=BYTES)
_PART = T.StructType([*NODE.fields, T.StructField("key", BYTES), T.StructField("parent_key", BYTES),
                      T.StructField("first_end", LONG), T.StructField("ends", TEXT)])
_ARROW = pa.schema([(f.name, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[
    f.dataType.simpleString()]) for f in _PART.fields])


def conversation_paths(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row (conv_id, path) per conversation: the records of its turns, ordered by ``turn``.

    A null turn comes first; equal turns are ordered by role and record. Null role and text are empty.
    Repeated rows are turns of their own. Rows without a conversation belong to none and are left out.
    Other columns are ignored.
    """
    role, text = text_of("role"), text_of()
    ident = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    words = F.regexp_count(text, F.lit(SPACED_WORD)).cast("long")
    return turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.struct(F.col("turn"), role.alias("role"),
                 F.concat(ident, F.lpad(F.hex(words), 16, "0")).alias("record")).alias("step")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps")) \
        .select("conv_id", F.unhex(F.array_join("steps.record", "")).alias("path"))


def turns_of(path: Column) -> Column:
    """Number of turns of a path."""
    return F.call_function("div", F.octet_length(path), F.lit(RECORD))


def first_turns(path: Column, n: Column) -> Column:
    return F.substr(path, F.lit(1), (n * RECORD).cast("int"))


def turns_after(path: Column, n: Column) -> Column:
    return F.substr(path, (n * RECORD + 1).cast("int"))


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, from the empty one at depth 0.

    ``paths`` has one row (conv_id, path) per conversation, as ``conversation_paths`` returns them; a path
    may be empty. Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's
    conv_id, null at the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the subtree),
    ``saved_tokens`` (over the subtree, words of the last turn times the members beyond the first),
    ``ends_sha256`` (digest of the ids that end here, ascending) and ``turn_id``, by which a turn's text is
    found again. An empty table has no nodes.
    """
    paths = materialize(paths.select("conv_id", "path"), "trie-paths")
    cells = paths.agg(F.coalesce(F.sum(turns_of(F.col("path")) + 1), F.lit(0))).first()[0]
    shards = materialize(paths.repartitionByRange(-(-cells // SHARD_CELLS) or 1, "path", "conv_id")
                         .withColumn("shard", F.spark_partition_id()), "trie-shards")
    # One row per shard: the sequences next to it.
    along = Window.partitionBy().orderBy("shard")
    near = shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")).select(
        "shard", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))
    parts = materialize(
        shards.groupBy("shard").cogroup(near.groupBy("shard")).applyInArrow(_shard_nodes, _PART), "trie-parts")
    return _recombined(parts)


def _recombined(parts: DataFrame) -> DataFrame:
    """Parts of shared nodes added up, and what names them as parents looked up."""
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    shared = parts.where(F.col("key").isNotNull() & F.col("n_convs").isNotNull()).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.first("parent_key").alias("parent_key"), F.first("turn_id").alias("turn_id"),
        *[F.sum(c).alias(c) for c in sums])
    digests = parts.where(F.col("ends").isNotNull()).select("key", "first_end", "ends") \
        .repartition("key").sortWithinPartitions("key", "first_end") \
        .mapInArrow(_digests, struct_of(key=BYTES, ends_sha256=TEXT))
    shared = materialize(shared.join(digests, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))), "trie-shared")
    names = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    n_names = names.count()
    named = lambda nodes: attach_small(
        nodes.drop("parent_conv_id"), names, ["parent_key"], n_names, 100)
    columns = [f.name for f in NODE.fields]
    inner = parts.where(F.col("key").isNull())
    return inner.where(F.col("parent_key").isNull()).select(*columns) \
        .unionByName(named(inner.where(F.col("parent_key").isNotNull())).select(*columns)) \
        .unionByName(named(shared).select(*columns))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of rows that arrive by key and in order."""
    key, state = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])],
                                          ["key", "ends_sha256"])
    for batch in batches:
        for at, ends in zip(batch.column(0).to_pylist(), batch.column(2)):
            if at != key:
                if state is not None:
                    yield done()
                key, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.as_buffer())
    if state is not None:
        yield done()


# --- one shard -------------------------------------------------------------------------------------

class Rows:
    """Conversations of a shard: ids, and their turns' records end to end."""

    def __init__(self, conv_ids: np.ndarray, paths: pa.Array):
        paths = paths.cast(pa.large_binary())
        bounds = np.frombuffer(paths.buffers()[1], np.int64)[paths.offset:paths.offset + len(paths) + 1]
        data = paths.buffers()[2]
        run = memoryview(data)[int(bounds[0]):int(bounds[-1])] if data is not None else b""
        self.records = np.frombuffer(run, ">u8").reshape(-1, RECORD // 8).astype(np.uint64)
        self.begin = (bounds[:-1] - bounds[0]) // RECORD
        self.size = np.diff(bounds) // RECORD
        self.conv_ids = conv_ids

    def path(self, row: int) -> bytes:
        begin, size = int(self.begin[row]), int(self.size[row])
        return self.records[begin:begin + size].astype(">u8").tobytes()


def sort_rows(rows: Rows) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Order of the rows by turns, then id, and for every depth from 1 the places of the rows that reach
    it and which of them begin a node.

    The padded matrix is made band by band, of the rows that reach the band only, so one very long
    conversation does not widen it for all. Rows that end come before those that go on.
    """
    order = np.argsort(rows.conv_ids, kind="stable")
    order = order[np.argsort(rows.size[order] > 0, kind="stable")]
    places = np.flatnonzero(rows.size[order] > 0)
    group = np.zeros(len(places), np.int64)
    depths = []
    for first in range(0, int(rows.size.max(initial=0)), BAND):
        row = order[places]
        left = rows.size[row] - first
        width = min(BAND, int(left.max()))
        matrix = np.zeros((2 * width, len(row)), np.uint64)
        for j in range(width):
            reach = left > j
            matrix[2 * j:2 * j + 2, reach] = rows.records[rows.begin[row[reach]] + first + j, :2].T
        goes_on = left > width
        by = np.lexsort((goes_on, *matrix[::-1], group))
        order[places], left, goes_on, group, matrix = row[by], left[by], goes_on[by], group[by], matrix[:, by]
        change = np.ones((width, len(row)), bool)
        change[:, 1:] = (matrix[:, 1:] != matrix[:, :-1]).reshape(width, 2, -1).any(axis=1)
        change[0, 1:] |= group[1:] != group[:-1]
        change = np.logical_or.accumulate(change, axis=0)
        for j in range(width):
            reach = left > j
            depths.append((places[reach], change[j, reach]))
        group = np.cumsum(change[-1])[goes_on]
        places = places[goes_on]
    return order, depths


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // RECORD
    x, y = (np.frombuffer(p, np.uint8, n * RECORD).reshape(n, RECORD) for p in (a, b))
    same = (x == y).all(axis=1)
    return n if same.all() else int(same.argmin())


def _keys(path: bytes, depth: int) -> list[bytes]:
    """Digests of the path's first 0 .. depth turns."""
    state, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(state.digest()[:16])
        state.update(path[d * RECORD:(d + 1) * RECORD])
    return out


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _shard_nodes(shard: pa.Table, near: pa.Table) -> pa.Table:
    shard = shard.combine_chunks()
    if not shard.num_rows:
        return _ARROW.empty_table()
    rows = Rows(shard["conv_id"].to_numpy(), shard["path"].combine_chunks())
    order, depths = sort_rows(rows)
    ids, size = rows.conv_ids[order], rows.size[order]
    n = len(order)
    first, last = rows.path(order[0]), rows.path(order[-1])
    before, after = near["before"][0].as_py(), near["after"][0].as_py()
    # The path shared with the shard before or after, -1 without one: not even the root.
    back = -1 if before is None else common_turns(first, before)
    ahead = -1 if after is None else common_turns(last, after)
    first_keys, last_keys = _keys(first, max(back, 0)), _keys(last, max(ahead, 0))

    depths = [(np.arange(n), np.arange(n) == 0), *depths]
    node_at = np.zeros(n, np.int64)
    levels = []
    for depth, (places, starts) in enumerate(depths):
        heads = np.flatnonzero(starts)
        row = order[places[heads]]
        level = {
            "places": places, "parent": node_at[places[heads]],
            "conv_id": np.minimum.reduceat(ids[places], heads), "n_convs": np.diff(np.append(heads, len(places))),
            "ends": np.add.reduceat((size[places] == depth).astype(np.int64), heads)}
        words = np.zeros(len(heads), np.int64)
        level["turn_id"] = [None] * len(heads)
        if depth:
            records = rows.records[rows.begin[row] + depth - 1]
            words = records[:, 2].astype(np.int64)
            level["turn_id"] = [records[i, :2].astype(">u8").tobytes() for i in range(len(heads))]
        node_at[places] = np.cumsum(starts) - 1
        level["new"] = np.ones(len(heads), np.int64)
        level["new"][0] = depth > back
        over = np.ones(len(heads), np.int64)
        over[-1] = depth > ahead
        level["n_leaves"] = (level["ends"] == level["n_convs"]) * over
        level["saved_tokens"] = level["n_convs"] * words - level["new"] * words
        level["n_children"] = np.zeros(len(heads), np.int64)
        levels.append(level)
    for above, level in zip(levels[-2::-1], levels[:0:-1]):
        np.add.at(above["n_children"], level["parent"], level["new"])
        for name in ("n_leaves", "saved_tokens"):
            np.add.at(above[name], level["parent"], level[name])

    nothing = hashlib.sha256().hexdigest()
    out = []
    shared_above: dict[int, bytes] = {}
    for depth, level in enumerate(levels):
        m = len(level["conv_id"])
        shared = {}
        if depth <= back:
            shared[0] = first_keys[depth]
        if depth <= ahead:
            shared[m - 1] = last_keys[depth]
        digests, chunks = [nothing] * m, []
        ended = ids[level["places"][size[level["places"]] == depth]]
        at = 0
        for i in np.flatnonzero(level["ends"]).tolist():
            mine = ended[at:at + int(level["ends"][i])]
            at += len(mine)
            if i in shared:
                for j in range(0, len(mine), CHUNK_IDS):
                    chunks.append((shared[i], int(mine[j]), _joined(mine[j:j + CHUNK_IDS])))
            else:
                digests[i] = hashlib.sha256(_joined(mine).encode()).hexdigest()
        above = levels[depth - 1] if depth else None
        parents = pa.array(above["conv_id"][level["parent"]]) if depth else pa.nulls(m, pa.int64())
        parent_keys = [shared_above.get(i) for i in level["parent"].tolist()] if depth else [None] * m
        out.append(pa.Table.from_arrays([
            pa.array(level["conv_id"]), pa.array(np.full(m, depth)), parents,
            *[pa.array(level[c]) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            pa.array(digests), pa.array(level["turn_id"], pa.binary()),
            pa.array([shared.get(i) for i in range(m)], pa.binary()), pa.array(parent_keys, pa.binary()),
            pa.nulls(m, pa.int64()), pa.nulls(m, pa.string())], schema=_ARROW))
        if chunks:
            keys, begins, texts = zip(*chunks)
            given = {"key": pa.array(keys, pa.binary()), "first_end": pa.array(begins), "ends": pa.array(texts)}
            out.append(pa.Table.from_arrays(
                [given.get(f.name, pa.nulls(len(keys), f.type)) for f in _ARROW], schema=_ARROW))
        shared_above = shared
    return pa.concat_tables(out)


ships_by_value(__name__)
