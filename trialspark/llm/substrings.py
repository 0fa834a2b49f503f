"""Removal of word windows that stand in an earlier document already."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import slices_by_size, text_blocks, words_of, written
from trialspark.llm.recompress import WINDOW, Block, word_names

#: Characters of the documents that are named together.
BLOCK_CHARS = 4_000_000
#: Bytes of compressed texts whose windows are made together; a word of them takes some hundred bytes.
SQUEEZED_BYTES = 800_000
#: Stands for a null id, as the smallest one.
NULL_ID = -(1 << 63)


def _digest(words: list[bytes]) -> tuple[int, int]:
    """128 bits of a word sequence."""
    d = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def anchored(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each document its words' hash, number and digest, and the distinct anchors of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in text_blocks(batches, BLOCK_CHARS):
            split = [words_of(t) for t in texts]
            block = Block([word_names(w) for w in split], window)
            anchor, owner = block.anchors().view(np.int64), block.doc_of
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            anchor, owner = anchor[new], owner[new]
            order = np.lexsort((anchor, owner))
            anchor, owner = anchor[order], owner[order]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            anchor, owner = anchor[new], owner[new]
            offsets = np.searchsorted(owner, np.arange(len(ids) + 1)).astype(np.int32)
            hashes = [_digest(w) for w in split]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([h[0] for h in hashes], pa.int64()),
                    pa.array([h[1] for h in hashes], pa.int64()),
                    pa.array([len(w) for w in split], pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in split]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(anchor)),
                ],
                ["doc_id", "h1", "h2", "n_words", "words_sha256", "anchors"],
            )

    return _keyed(docs).mapInArrow(
        run, "doc_id long, h1 long, h2 long, n_words long, words_sha256 string, anchors array<long>"
    )


def _squeezed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``squeezed``: texts compressed before they are moved, with no other column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for ids, texts, _ in text_blocks(batches, BLOCK_CHARS):
            raw = [squeeze(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "squeezed"])

    return _keyed(docs).mapInArrow(run, "doc_id long, squeezed binary")


def _text(raw: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(raw).decode("utf-8", "surrogatepass")


def _suspects(named: DataFrame, window: int) -> DataFrame:
    """Windows whose anchor occurs in several documents: their place and the hash of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices_by_size(whole, "squeezed", SQUEEZED_BYTES, 500):
                names = [word_names(words_of(_text(t))) for t in batch.column("squeezed").to_pylist()]
                block = Block(names, window)
                anchor = block.anchors().view(np.int64)
                suspect = np.zeros(len(anchor), bool)
                edges = np.searchsorted(block.doc_of, np.arange(len(names) + 1))
                for i, shared in enumerate(batch.column("shared")):
                    a, b = edges[i], edges[i + 1]
                    suspect[a:b] = np.isin(anchor[a:b], np.array(shared.as_py(), np.int64))
                chosen = np.flatnonzero(suspect)
                w1, w2 = block.window_hashes(chosen)
                owner = block.doc_of[chosen]
                place = (block.starts[chosen] - block.offsets[owner]).astype(np.int32)
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(take), batch.column("doc_id").take(take), pa.array(place), pa.array(w1),
                     pa.array((w2 >> 32).astype(np.int32))],
                    ["row", "doc_id", "place", "w1", "w2"],
                )

    return named.mapInArrow(run, "row long, doc_id long, place int, w1 long, w2 int")


def _cut(covered: DataFrame, window: int) -> DataFrame:
    """The words that no repeated window covers, with the hash of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, removed, kept = [], [], []
            for raw, starts in zip(batch.column("squeezed"), batch.column("starts")):
                words = words_of(_text(raw.as_py()))
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.array(starts.as_py(), np.int64))
                edge[at] += 1
                edge[at + window] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                hashes.append(_digest(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([h[i] for h in hashes], pa.int64()) for i in (0, 1)],
                 pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "h1", "h2", "n_removed", "kept"],
            )

    return covered.mapInArrow(run, "doc_id long, h1 long, h2 long, n_removed long, kept string")


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """What stays of each document when every word in a window that a smaller id has too is removed.

    Returns ``doc_id, h1, h2, n_words, words_sha256, n_removed, kept``; ``kept`` is null where nothing
    is removed, else the kept words joined by one space. ``h1, h2`` hash the word sequence.

    1. Recompression names the runs and pairs of words in rounds, in place, by hashes of what they
       name, so a name means the same in every document. Each window's anchor is the highest symbol
       that depends on its own words only: equal windows have equal anchors.
    2. Spark counts in how many documents an anchor occurs; only windows with a shared anchor go on.
    3. Those are compared by 96-bit hashes of all their words: the smallest id of each is found and
       comes back to the windows of the other documents.

    Of documents with equal words only the smallest id is compared; the others lose all, if they hold a
    window at all. An anchor or window that very many documents share is counted with partial sums and
    met by a join that the planner can split. Null text is empty, a null id counts as the smallest, an
    equal id is not smaller; an empty table gives no rows; other columns are not read.
    """
    key = ["doc_id", "h1", "h2"]
    base = written(anchored(docs, window), "anchors")
    firsts = base.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    copies = base.select(*key).join(firsts, ["h1", "h2"]).where(F.col("doc_id") > F.col("first")).select(*key).distinct()
    copies = written(copies, "copies")
    alone = base.select(*key, "anchors").join(copies, key, "left_anti")
    rows = alone.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = rows.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    flagged = rows.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared"))
    # a document is known by its row in the written table: shorter than its id and hash
    held = _squeezed(docs).join(flagged, "doc_id").withColumn("row", F.monotonically_increasing_id())
    held = written(held, "suspects")
    windows = _suspects(held, window)
    earliest = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"))
    late = windows.join(earliest, ["w1", "w2"]).where(F.col("doc_id") > F.col("first"))
    starts = late.groupBy("row").agg(F.collect_list("place").alias("starts"))
    cut = _cut(held.select("row", "doc_id", "squeezed").join(starts, "row"), window).dropDuplicates(key)
    cut = cut.unionByName(
        base.join(copies, key, "left_semi").where(F.col("n_words") >= window).select(
            *key, F.col("n_words").alias("n_removed"), F.lit("").alias("kept")
        ).distinct()
    )
    return base.drop("anchors").join(cut, key, "left").select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "h1", "h2", "n_words", "words_sha256",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "kept",
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every repeated window cut out of ``text``; ``n_chars`` follows where it exists.

    A text of which nothing is removed stays as it is, white space included. All rows stay.
    """
    cut = repeated_windows(docs, window).where(F.col("n_removed") > 0).select(
        F.col("doc_id").alias("_id"), F.col("kept").alias("_kept"), "h1", "h2"
    )
    # rows of one id and other words are other documents
    cut = cut.groupBy("_id").agg(F.collect_set(F.struct("h1", "h2", "_kept")).alias("_cuts"))
    joined = docs.join(cut, docs["doc_id"].eqNullSafe(cut["_id"]), "left")

    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            changed = [False] * len(texts)
            for i, cuts in enumerate(batch.column("_cuts").to_pylist()):
                if cuts:
                    own = _digest(words_of(texts[i] or ""))
                    for c in cuts:
                        if (c["h1"], c["h2"]) == own:
                            texts[i], changed[i] = c["_kept"], True
            columns = []
            for name in names:
                column = batch.column(name)
                if name == "text":
                    column = pa.array(texts, column.type)
                elif name == "n_chars" and any(changed):
                    old = column.to_pylist()
                    column = pa.array([len(t) if c else o for t, c, o in zip(texts, changed, old)], column.type)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*names, "_cuts").mapInArrow(run, schema)
