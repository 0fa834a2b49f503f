"""SimHash near-duplicates: BK-trees over shards of fingerprints, then connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import text_blocks, texts_of, words_of, written

#: Differing bits at which two fingerprints still link.
RADIUS = 3
#: Widths of the bit blocks; of five blocks two at least are equal when three bits differ.
BLOCKS = (13, 13, 13, 13, 12)
#: Rows whose trees are built together, and queries that walk them together.
TREE_ROWS, WALK_ROWS = 200_000, 50_000


def simhash(words: list[bytes], size: int = 3, seed: int = 42) -> int:
    """The majority bits of the XXH64 of all word shingles, repeats included; 0 without words.

    Fewer words than a shingle are one shingle.
    """
    from xxhash import xxh64_intdigest as digest

    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    total = np.zeros(64, np.int64)
    for i in range(0, len(starts), 65_536):
        hashes = np.fromiter(
            (digest(joined[a:b], seed) for a, b in zip(starts[i : i + 65_536], stops[i : i + 65_536])), np.uint64
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    majority = np.packbits(2 * total > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, *texts_too: str) -> DataFrame:
    """``doc_id`` and ``fp``, the 64 bits as a signed long, of each text with A-Z in lower case.

    Named string columns come along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, more in text_blocks(batches, 4_000_000):
            fps = np.array([simhash(words_of(t.translate(_LOWER))) for t in texts], np.uint64).view(np.int64)
            extra = [pa.array(more[n], pa.string()) for n in texts_too]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps), *extra], ["doc_id", "fp", *texts_too])

    return texts_of(docs, *texts_too).mapInArrow(run, ", ".join(["doc_id long, fp long", *[f"{n} string" for n in texts_too]]))


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


class Trees:
    """BK-trees of many groups at once: a node's children are keyed by their distance to it."""

    def __init__(self, group: np.ndarray, fps: np.ndarray):
        """``group`` is sorted; the first member of a group is its root."""
        self.fps = fps
        new = np.concatenate([[True], group[1:] != group[:-1]])
        node = np.cumsum(new) - 1
        self.root = node.copy()
        members = np.arange(len(fps))
        pivots, keys, children = [], [], []
        made = 0
        while len(members):
            first = np.concatenate([[True], node[1:] != node[:-1]])
            pivots.append(members[first])
            count = int(first.sum())
            local = np.cumsum(first) - 1
            rest = ~first
            distance = np.bitwise_count(fps[members[rest]] ^ fps[pivots[-1][local[rest]]]).astype(np.int64)
            key = (made + local[rest]) * 65 + distance
            order = np.argsort(key, kind="stable")
            key = key[order]
            members = members[rest][order]
            fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
            made += count
            node = made + np.cumsum(fresh) - 1
            keys.append(key[fresh])
            children.append(node[fresh])
        self.pivot = np.concatenate(pivots)
        self.keys = np.concatenate(keys)
        self.children = np.concatenate(children)

    def links(self, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of members within the radius, following only edges within it."""
        for start in range(0, len(self.fps), WALK_ROWS):
            asked = np.arange(start, min(start + WALK_ROWS, len(self.fps)))
            node = self.root[asked]
            while len(asked):
                pivot = self.pivot[node]
                distance = np.bitwise_count(self.fps[asked] ^ self.fps[pivot]).astype(np.int64)
                hit = (distance <= radius) & (pivot < asked)
                if hit.any():
                    yield asked[hit], pivot[hit]
                next_asked, next_node = [], []
                for step in range(-radius, radius + 1):
                    key = node * 65 + distance + step
                    key[(distance + step < 0) | (distance + step > 64)] = -1
                    at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
                    there = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
                    next_asked.append(asked[there])
                    next_node.append(self.children[at[there]] if len(self.keys) else at[there])
                asked, node = np.concatenate(next_asked), np.concatenate(next_node)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of each pair; a class is known by its smallest member."""
    while True:
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: the links of each shard's tree, thinned to one per member of a class."""
    held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def flush(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        sizes = np.diff(np.append(np.flatnonzero(new), len(key)))
        shared = np.repeat(sizes > 1, sizes)
        key, fp = key[shared], fp[shared]
        label = np.arange(len(fp))
        if len(fp):
            for a, b in Trees(key, fp.view(np.uint64)).links():
                label = _merge(label, a, b)
        linked = label != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], ["u", "v"])

    for batch in batches:
        held_key = np.concatenate([held_key, batch.column("shard").to_numpy()])
        held_fp = np.concatenate([held_fp, batch.column("fp").to_numpy()])
        if len(held_key) >= TREE_ROWS:
            cut = int(np.searchsorted(held_key, held_key[-1]))  # the last shard may go on
            if cut:
                yield flush(held_key[:cut], held_fp[:cut])
                held_key, held_fp = held_key[cut:], held_fp[cut:]
    if len(held_key):
        yield flush(held_key, held_fp)


def links(distinct: DataFrame) -> DataFrame:
    """``u, v`` links that connect all fingerprints within :data:`RADIUS` of each other.

    Two fingerprints within the radius agree in two blocks of bits at least, so they share a shard: a
    pair of blocks and its bits. Each shard is a BK-tree in one task. Trees go to their shard by the
    shuffle, as no bound is known for their size together that would allow to broadcast them.
    """
    starts = np.cumsum([0, *BLOCKS[:-1]]).tolist()
    parts = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(starts, BLOCKS)]
    shards = F.array(
        *[
            F.shiftleft(F.lit(n).cast("long"), 32).bitwiseOR(F.shiftleft(parts[i], 13)).bitwiseOR(parts[j])
            for n, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
        ]
    )
    rows = distinct.select("fp", F.explode(shards).alias("shard"))
    return (
        rows.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(_forest, "u long, v long").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: each node of an edge with the smallest node it is connected to.

    Large-star and small-star steps in turn: each takes a node's smallest neighbour and hangs the
    others on it. The minimum is an aggregate with partial sums and comes back by a join, so a node
    with very many neighbours does not gather them. Each step is written to the shared folder.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = written(
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(),
            "edges",
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(hung.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row for each row of ``docs``.

    Documents link when their fingerprints differ in at most three bits; a component is known by its
    smallest ``doc_id``. Equal fingerprints are one node, so copies make no links. Null text is
    empty; texts without words share fingerprint zero and link to each other. Other columns are not
    read, an empty table gives no rows.
    """
    prints = written(fingerprints(docs), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    member = components(links(distinct))
    named = distinct.join(member, distinct["fp"] == member["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = written(named, "simhash-classes")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = named.join(smallest, "root").select("fp", "component_id")
    return prints.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, all columns as they are.

    It is the row with the smallest ``doc_id`` (null last), of several the one whose text has the smallest
    hash; of rows that are equal in both, one. So rows of one id with different texts are told apart, and a
    row without an id stays only where its component has no id at all.
    """
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    prints = written(fingerprints(docs.withColumn("_digest", digest), "_digest"), "simhash-rows")
    distinct = prints.select("fp").distinct()
    member = written(components(links(distinct)), "simhash-members")
    rooted = prints.join(member, prints["fp"] == member["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_digest")).alias("r"))
    kept = first.select(F.col("r.doc_id").alias("_kept"), F.col("r._digest").alias("_kept_digest"))
    rows = docs.withColumn("_digest", digest)
    same = rows["doc_id"].eqNullSafe(kept["_kept"]) & (rows["_digest"] == kept["_kept_digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_digest"]).select(*docs.columns)
