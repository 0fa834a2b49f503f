"""Prefix trie of conversations, from sorted matrices of turn ids in range shards."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialspark.llm.common import crc32_text, ranges, written

#: Turns of a shard, which one task sorts: about 150 bytes for each.
SHARD_TURNS = 400_000
#: Columns of a padded matrix; longer conversations go on in further matrices.
WIDTH = 8
#: Rows of a batch that leaves a task.
BATCH_ROWS = 20_000
#: Kinds of the rows of a shard: a node that it holds whole, its share of a node that may go on in others, an edge.
WHOLE, PIECE, EDGE = 0, 1, 2

_FIELDS = [
    ("kind", pa.int8()), ("shard", pa.int32()), ("slot", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
    ("p1", pa.int64()), ("p2", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("ids", pa.binary()), ("words", pa.binary()),
]
_DDL = (
    "kind tinyint, shard int, slot long, k1 long, k2 long, p1 long, p2 long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids binary, words binary"
)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_sequences(conversations: DataFrame, family: int = 20) -> DataFrame:
    """Each conversation's turns in order: ``base, conv_id, turns`` (array of ``id`` and ``words``).

    Turns go by ``turn`` (null first), ties by role, then by the md5 of the text. ``id`` is the md5 of
    role and text, ``words`` counts the text's words. Rows without ``conv_id`` belong to no
    conversation. Conversations of one ``base`` (``conv_id - conv_id % family``) share a partition.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.md5(text.cast("binary"))).alias("tie"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
    )
    turns = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).repartition("base")
    gathered = F.sort_array(F.collect_list(F.struct("turn", "role", "tie", "id", "words")))
    return turns.groupBy("base", "conv_id").agg(
        F.transform(gathered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns")
    )


def with_shared_starts(sequences: DataFrame, most: int = 4) -> DataFrame:
    """The first h turns come from the conversation ``base``, h being crc32 of the decimal id modulo ``most``.

    All of its turns if it has fewer, none if it is absent; the conversation's own turns after its
    first h follow.
    """
    starts = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, most - 1))
    donor = F.first(starts, ignorenulls=True).over(Window.partitionBy("base"))
    h = (crc32_text("conv_id") % most).cast("int")
    return sequences.withColumn("donor", donor).withColumn("h", h).select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("donor", F.lit(1), F.col("h")), F.slice("turns", 1, 0)), F.slice("turns", F.col("h") + 1, F.size("turns"))
        ).alias("turns"),
    )


def sorted_rows(
    conv: np.ndarray, starts: np.ndarray, lengths: np.ndarray, high: np.ndarray, low: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The rows by their turn ids, then ``conv``, and how many leading turns each shares with the one before.

    Rows are padded matrices of ``WIDTH`` columns, sorted by ``lexsort``; only rows that still tie and
    have further turns go on to the next columns. The first row shares -1 turns.
    """
    m = len(conv)
    order = np.argsort(conv, kind="stable")
    group = np.zeros(m, np.int64)
    shared = np.zeros(m, np.int64)
    at = np.arange(m)
    done = 0
    while len(at):
        rows, own = order[at], group[at]
        column = np.arange(done, done + WIDTH)
        present = column < lengths[rows][:, None]
        place = np.where(present, starts[rows][:, None] + column, 0)
        h, lo = (np.where(present, x[place], 0) if len(x) else np.zeros(place.shape, np.uint64) for x in (high, low))
        keys = [conv[rows], *(x[:, j] for j in range(WIDTH - 1, -1, -1) for x in (lo, h)), own]
        by = np.lexsort(keys)
        rows, h, lo = rows[by], h[by], lo[by]
        order[at] = rows
        # a change in one column starts a node at that depth and at all deeper ones
        starts_node = np.logical_or.accumulate((h[1:] != h[:-1]) | (lo[1:] != lo[:-1]), axis=1)
        same = own[1:] == own[:-1]
        kept = at[1:][same]
        shared[kept] = done + (~starts_node[same]).sum(axis=1)
        first = np.ones(len(at), bool)
        first[1:] = ~same | starts_node[:, -1]
        heads = np.flatnonzero(first)
        size = np.diff(heads, append=len(at))
        group[at] = np.repeat(at[heads], size)
        done += WIDTH
        more = (size > 1) & (np.maximum.reduceat(lengths[rows], heads) > done)
        at = at[np.repeat(more, size)]
    shared[1:] = np.minimum(shared[1:], np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    shared[:1] = -1
    return order, shared


class Nodes:
    """Every node of the sorted rows of one shard, by depth and then by its first row.

    An entry is one row at one depth; the entries of a node stand together in depth order, so
    ``reduceat`` sums over all nodes of all depths at once. Sums over a subtree are sums over its rows:
    a leaf belongs to the last of its rows, and of a row's turns those count as saved that the row
    before has too.
    """

    def __init__(self, conv, lengths, words, shared):
        m = len(conv)
        size = lengths + 1
        self.offsets = np.concatenate([[0], np.cumsum(size)])
        row = np.repeat(np.arange(m), size)
        depth = np.arange(self.offsets[-1]) - self.offsets[row]
        by = np.argsort(depth, kind="stable")
        r, d = row[by], depth[by]
        starts = d > shared[r]
        self.at = np.flatnonzero(starts)
        self.number = np.empty(len(by), np.int64)
        self.number[by] = np.cumsum(starts) - 1
        first = by[self.at]
        self.depth = d[self.at]
        self.parent = np.where(self.depth > 0, self.number[np.maximum(first - 1, 0)], -1)
        self.n_convs = np.diff(self.at, append=len(by))
        self.conv_id = np.minimum.reduceat(conv[r], self.at)
        self.n_children = np.add.reduceat(((d < lengths[r]) & (d + 1 > shared[r])).astype(np.int64), self.at)
        leaf = lengths > np.append(shared[1:], -1)
        self.n_leaves = np.add.reduceat(leaf[r].astype(np.int64), self.at)
        weight = np.zeros(len(by), np.int64)
        weight[depth > 0] = words
        before = np.concatenate([[0], np.cumsum(weight)])
        base = self.offsets[r]
        saved = before[base + np.maximum(d, shared[r] + 1)] - before[base + d]
        self.saved_tokens = np.add.reduceat(saved, self.at)
        self.n_ends = np.add.reduceat((lengths[r] == d).astype(np.int64), self.at)
        # rows that end at a node come first among its rows, by conv_id
        self.ends = conv[r]

    def ends_of(self, node: int) -> np.ndarray:
        return self.ends[self.at[node] : self.at[node] + self.n_ends[node]]


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _path_keys(ids: bytes) -> np.ndarray:
    """128 bits for each prefix of a row, the empty one first."""
    state = hashlib.blake2b(digest_size=16)
    keys = [state.digest()]
    for k in range(0, len(ids), 16):
        state.update(ids[k : k + 16])
        keys.append(state.digest())
    return np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)


def _rows(**columns) -> Iterator[pa.RecordBatch]:
    """Batches of the shard schema; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in _FIELDS]
    whole = pa.RecordBatch.from_arrays(arrays, [name for name, _ in _FIELDS])
    for k in range(0, n, BATCH_ROWS):
        yield whole.slice(k, BATCH_ROWS)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    shard = TaskContext.get().partitionId()
    conv = table.column("conv_id").to_numpy()
    lists = table.column("ids").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = b"".join(lists.flatten().to_pylist())
    words = table.column("words").combine_chunks().flatten().to_numpy().astype(np.int64)
    halves = np.frombuffer(flat, ">u8").astype(np.uint64).reshape(-1, 2)
    starts = np.cumsum(lengths) - lengths
    order, shared = sorted_rows(conv, starts, lengths, halves[:, 0], halves[:, 1])
    conv, starts, lengths = conv[order], starts[order], lengths[order]
    words = words[ranges(starts, lengths)]
    nodes = Nodes(conv, lengths, words, shared)
    ends = np.flatnonzero(nodes.n_ends)

    # nodes on the path of the first or the last row may go on in other shards
    slot = np.full(len(nodes.at), -1, np.int64)
    keys = np.zeros((len(nodes.at), 2), np.int64)
    edges = []
    for side, row in ((1, len(conv) - 1), (0, 0)):
        path = nodes.number[nodes.offsets[row] : nodes.offsets[row + 1]]
        own = flat[16 * starts[row] : 16 * (starts[row] + lengths[row])]
        slot[path] = 2 * np.arange(len(path)) + side
        keys[path] = _path_keys(own)
        at = int(nodes.offsets[row]) - row
        edges.append((side, own, words[at : at + lengths[row]].tobytes()))

    whole = np.flatnonzero(slot < 0)
    digest = np.full(len(nodes.at), _EMPTY_SHA, object)
    for k in ends[slot[ends] < 0].tolist():
        digest[k] = hashlib.sha256(_joined(nodes.ends_of(k))).hexdigest()
    common = lambda x: {n: getattr(nodes, n)[x] for n in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")}
    parent = nodes.parent[whole]
    open_parent = slot[parent] >= 0
    if len(whole):
        yield from _rows(
            kind=np.full(len(whole), WHOLE), shard=np.full(len(whole), shard),
            slot=pa.array(slot[parent], mask=~open_parent), parent_conv_id=pa.array(nodes.conv_id[parent], mask=open_parent),
            ends_sha256=digest[whole], **common(whole),
        )
    piece = np.flatnonzero(slot >= 0)
    parent = nodes.parent[piece]
    root = parent < 0
    yield from _rows(
        kind=np.full(len(piece), PIECE), shard=np.full(len(piece), shard), slot=slot[piece],
        k1=keys[piece, 0], k2=keys[piece, 1],
        p1=pa.array(keys[parent, 0], mask=root), p2=pa.array(keys[parent, 1], mask=root),
        ids=[nodes.ends_of(k).tobytes() if nodes.n_ends[k] else None for k in piece.tolist()], **common(piece),
    )
    yield from _rows(
        kind=[EDGE, EDGE], shard=[shard, shard], slot=[e[0] for e in edges], ids=[e[1] for e in edges], words=[e[2] for e in edges]
    )


def _corrected(group: pa.Table) -> pa.Table:
    """What two neighbouring shards count twice or not at all, for each node on the path that they share."""
    names = ["k1", "k2", "n_children", "n_leaves", "saved_tokens"]
    if group.num_rows < 2:
        return pa.table({n: pa.array([], pa.int64()) for n in names})
    found = {s: (i, w) for s, i, w in zip(*(group.column(c).to_pylist() for c in ("slot", "ids", "words")))}
    last, first = (np.frombuffer(found[s][0], np.uint64).reshape(-1, 2) for s in (1, 0))
    n = min(len(last), len(first))
    differ = np.flatnonzero((last[:n] != first[:n]).any(axis=1))
    common = int(differ[0]) if len(differ) else n
    keys = _path_keys(found[0][0][: 16 * common])
    weight = np.concatenate([[0], np.frombuffer(found[0][1], np.int64)[:common]])
    return pa.table({
        "k1": keys[:, 0], "k2": keys[:, 1],
        "n_children": -(np.arange(common + 1) < common).astype(np.int64),
        "n_leaves": np.full(common + 1, -int(len(last) == common)),
        "saved_tokens": np.cumsum(weight[::-1])[::-1],
    })


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash over the ids of each key; rows come by key and shard, one after the other."""
    current, state, found = None, None, []
    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            text = _joined(np.frombuffer(ids, np.int64))
            if key != current:
                if current is not None:
                    found.append((*current, state.hexdigest()))
                current, state = key, hashlib.sha256(text)
            else:
                state.update(b"," + text)
    if current is not None:
        found.append((*current, state.hexdigest()))
    columns = list(zip(*found)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["k1", "k2", "ends_sha256"]
    )


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of all prefixes of turn sequences (``conv_id``, ``turns`` of ``id`` and ``words``).

    A node is a distinct sequence of ``depth`` leading turns; its members are the conversations that
    start with it. Returns for each node ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree: words of a node's last
    turn, once for each member but one) and ``ends_sha256`` (over the ids of the members that end there).

    Conversations are dealt by range of (turn ids, conv_id), so equal ones are spread too. Each shard
    sorts its rows and sums all its nodes in memory. Only nodes on the path of its first or last row can
    go on in a neighbour: their shares are added up by key, and what two shards count twice is taken off
    by comparing the edge rows of neighbours. A digest over ids takes them in order, so the ids that end
    at one such node stream through one task, packed, a shard at a time.

    A task holds the ids of its shard, about 150 bytes a turn; one conversation is never split. A
    repeated ``conv_id`` counts as often as it is given. No conversation gives no node. Other columns
    are not read.
    """
    spark = sequences.sparkSession
    flat = written(
        sequences.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words")), "trie-rows"
    )
    turns = flat.agg(F.sum(F.size("ids") + 1).alias("n")).first()["n"] or 0
    shards = max(math.ceil(turns / shard_turns), int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = written(flat.repartitionByRange(shards, "ids", "conv_id").mapInArrow(_shard, _DDL), "trie-nodes")
    whole, pieces, edges = (made.where(F.col("kind") == k) for k in (WHOLE, PIECE, EDGE))

    # neighbours among the shards that have rows; the driver sees their numbers only
    used = sorted(r["shard"] for r in edges.select("shard").distinct().collect())
    ranks = spark.createDataFrame(list(zip(used, range(len(used)))), "shard int, rank int")
    meeting = edges.join(ranks, "shard").withColumn("boundary", F.col("rank") + F.col("slot") - 1)
    taken = meeting.select("boundary", "slot", "ids", "words").groupBy("boundary").applyInArrow(
        _corrected, "k1 long, k2 long, n_children long, n_leaves long, saved_tokens long"
    )
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    shares = pieces.select("k1", "k2", "p1", "p2", "depth", "conv_id", *sums)
    added = shares.unionByName(taken, allowMissingColumns=True).groupBy("k1", "k2").agg(
        *(F.max(c).alias(c) for c in ("p1", "p2", "depth")), F.min("conv_id").alias("conv_id"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums),
    )
    ended = pieces.where(F.col("ids").isNotNull()).select("k1", "k2", "shard", "ids")
    ended = ended.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "shard")
    digests = ended.mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")
    open_nodes = written(
        added.join(digests, ["k1", "k2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY_SHA))), "trie-open"
    )
    names = ["conv_id", "depth", "parent_conv_id", *sums, "ends_sha256"]
    smallest = open_nodes.select("k1", "k2", F.col("conv_id").alias("parent_conv_id"))
    parents = smallest.withColumnsRenamed({"k1": "p1", "k2": "p2"})
    slots = pieces.select("shard", "slot", "k1", "k2").join(smallest, ["k1", "k2"]).drop("k1", "k2")
    below = whole.where(F.col("slot").isNotNull()).drop("parent_conv_id").join(slots, ["shard", "slot"])
    top = open_nodes.join(parents, ["p1", "p2"], "left")
    return (
        whole.where(F.col("slot").isNull()).select(*names).unionByName(below.select(*names)).unionByName(top.select(*names))
    )
