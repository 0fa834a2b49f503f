"""Best-fit packing of token sequences in bulk-synchronous rounds."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import ranges, removed, text_blocks, texts_of, written
from trialspark.session import run_dir

#: Tokens of a packed sequence.
CAPACITY = 2048
#: Text chunks whose ids a worker keeps; those that come later are encoded where they occur.
CACHED_CHUNKS = 500_000

#: Rows of a file that a round writes, about.
ROUND_ROWS = 20_000

ITEM, GAP, PLACED = 0, 1, 2

_PIECE = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"
# a space beside other white space (of any script): there a cut at the space could move the borders of pre-tokens
_WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN = f"{_WHITE} | {_WHITE}"


class ChunkEncoder:
    """Token ids of texts, encoding each distinct chunk (a word with the space before it) once.

    A byte-level pre-tokenizer never joins a single space to what stands before it, so ids of a text
    are the ids of its chunks. Texts with uneven white space or special tokens are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        plain = [(i, t) for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        #: a token that can stand between chunks without touching them
        self.border = plain[0] if plain else None
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks, one after the other, and how many each has."""
        if self.border is None:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths
        border, token = self.border
        (found,) = self.tokenizer.encode_batch_fast([token.content.join(chunks)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        between = np.concatenate([[-1], np.flatnonzero(ids == border), [len(ids)]])
        return ids[ids != border], np.diff(between) - 1

    def _learn(self, chunks: list[str]) -> None:
        found = [self._encoded(chunks[at : at + 20_000]) for at in range(0, len(chunks), 20_000)]
        lengths = np.concatenate([f[1] for f in found])
        self.index.update(zip(chunks, range(len(self.index), len(self.index) + len(chunks))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, *(f[0] for f in found)])

    def _forget(self, kept: int) -> None:
        """Back to the first ``kept`` chunks."""
        for chunk in list(islice(self.index, kept, None)):
            del self.index[chunk]
        self.flat = self.flat[: int(self.lengths[:kept].sum())].copy()
        self.starts, self.lengths = self.starts[:kept].copy(), self.lengths[:kept].copy()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) > CACHED_CHUNKS:
            self._forget(CACHED_CHUNKS)
        whole = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(whole, _UNEVEN)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(whole, s))
        uneven = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        # split and numbered by Arrow: only the distinct words of the block become Python strings
        parts = pc.split_pattern(pc.if_else(odd, pa.scalar("", pa.large_string()), whole), " ")
        edges = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        codes, heads = coded.indices.to_numpy(), edges[:-1]
        inner = np.ones(len(codes), bool)
        inner[heads] = False
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        spaced = np.flatnonzero(np.bincount(codes[inner], minlength=len(words)))
        chunks = [*map(" ".__add__, words[spaced].tolist()), *words[codes[heads]].tolist()]
        known = self.index
        if new := [c for c in dict.fromkeys(chunks) if c not in known]:
            self._learn(new)
        number = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        place = np.zeros(len(words), np.int64)
        place[spaced] = number[: len(spaced)]
        at = place[codes]
        at[heads] = number[len(spaced) :]
        lengths = self.lengths[at]
        ids = self.flat[ranges(self.starts[at], lengths)]
        out = np.split(ids, np.concatenate([[0], np.cumsum(lengths)])[edges[1:-1]])
        for i in uneven:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out


@cache
def encoder(path: str) -> ChunkEncoder:
    """One for each worker, kept from task to task."""
    return ChunkEncoder(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document cut into pieces of at most ``capacity``.

    A document is its token ids followed by id 0, so an empty or null text is one piece of one token.
    Of a longer document the first piece takes what is left over, all others are full.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = encoder(tokenizer_path)
        for docs_, texts, _ in text_blocks(batches, 4_000_000):
            found = chunks.encode(texts)
            sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
            # all documents one after the other, each with its id 0; pieces are cut by their places there
            zero = np.zeros(1, np.uint32)
            whole = np.concatenate([part for ids in found for part in (ids, zero)]).astype("<u4", copy=False)
            first = (sizes - 1) % capacity + 1
            pieces = (sizes - first) // capacity + 1
            document = np.repeat(np.arange(len(sizes)), pieces)
            piece = ranges(np.zeros(len(sizes), np.int64), pieces)
            start = np.where(piece > 0, first[document] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[document])
            begin = (np.cumsum(sizes) - sizes)[document] + start
            raw = memoryview(whole).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs_, pa.int64()).take(pa.array(document)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts_of(docs).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _plan(counts: dict[int, np.ndarray], capacity: int, first: bool, stuck: bool):
    """What one round does, from the number of documents and of gaps of each size.

    Sizes are bounded by the capacity, so this is as small for any input. Documents and gaps are
    numbered in the order of size. Returns the numbers of the documents that open a sequence and the
    matches: (first document, gap is an opener's, first gap or opener, how many).
    """
    items, gaps = counts[ITEM].copy(), counts[GAP]
    sizes = np.arange(capacity + 1)
    before = np.cumsum(items) - items
    gap_before = np.cumsum(gaps) - gaps
    opened = np.zeros_like(items)
    if first:  # no two of these fit one sequence
        opened[capacity // 2 + 1 :] = items[capacity // 2 + 1 :]
    left = items - opened
    room = int((gaps * sizes).sum() + (opened * (capacity - sizes)).sum())
    need = -(-(int((left * sizes).sum()) - room) // capacity)
    if stuck and need <= 0:
        need = -(-int((left * sizes).sum()) // capacity)
    for size in range(capacity, 0, -1):
        if need <= 0:
            break
        take = min(int(left[size]), need)
        opened[size] += take
        left[size] -= take
        need -= take
    opens = [
        (int(before[s] + items[s] - opened[s]), int(opened[s])) for s in np.flatnonzero(opened).tolist()
    ]
    # ascending sweep: a gap takes the largest document that is still free and fits, in bulk by class
    free: list[list[int]] = []
    matches: list[tuple[int, bool, int, int]] = []
    for size in range(1, capacity + 1):
        if left[size]:
            free.append([int(before[size]), int(left[size])])
        sources = [(False, int(gap_before[size]), int(gaps[size]))]
        if size < capacity and opened[capacity - size]:
            s = capacity - size
            sources.append((True, int(before[s] + items[s] - opened[s]), int(opened[s])))
        for by_opener, start, count in sources:
            while count and free:
                top = free[-1]
                take = min(count, top[1])
                matches.append((top[0] + top[1] - take, by_opener, start, take))
                top[1] -= take
                start += take
                count -= take
                if not top[1]:
                    free.pop()
    smallest = min((int(s) for s in np.flatnonzero(left)), default=capacity + 1)
    return opens, matches, smallest


def _lookup(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the interval that holds it (-1: none) and its place there."""
    if not len(starts):
        return np.full(len(values), -1), np.zeros(len(values), np.int64)
    at = np.searchsorted(starts, values, "right") - 1
    place = values - starts[np.maximum(at, 0)]
    at[(at >= 0) & (place >= counts[np.maximum(at, 0)])] = -1
    return at, place


def _settle(state: DataFrame, segments: dict[str, np.ndarray], plan, capacity: int) -> DataFrame:
    """Roles of the numbered rows in this round: matched by a common ``pair``, opening, or left over."""
    opens, matches, smallest = plan
    open_start, open_count = (np.array(x, np.int64) for x in (zip(*opens) if opens else ([], [])))
    base = np.cumsum([0, *(m[3] for m in matches)])
    item_side = sorted((m[0], m[3], b) for m, b in zip(matches, base))
    gap_side = sorted((m[2], m[3], b) for m, b in zip(matches, base) if not m[1])
    opener_side = sorted((m[2], m[3], b) for m, b in zip(matches, base) if m[1])
    sides = [
        tuple(np.array(c, np.int64) for c in (zip(*side) if side else ([], [], [])))
        for side in (item_side, gap_side, opener_side)
    ]

    def pairs(numbers, side):
        starts, counts, first = side
        at, place = _lookup(numbers, starts, counts)
        if not len(first):
            return np.full(len(numbers), -1)
        return np.where(at >= 0, first[np.maximum(at, 0)] + place, -1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, size, kind = (batch.column(c).to_numpy() for c in ("m", "size", "kind"))
            uid, payload = batch.column("uid"), batch.column("p")
            segment = np.searchsorted(segments["m"], m, "right") - 1
            number = m - segments["m"][segment] + segments["before"][segment]
            is_item = kind == ITEM
            opening = is_item & (_lookup(number, open_start, open_count)[0] >= 0)
            pair = np.where(is_item, pairs(number, sides[0]), pairs(number, sides[1]))
            pair[opening] = -1
            keep = is_item | (size >= smallest) | (pair >= 0)
            extra = np.flatnonzero(opening)  # the gap behind a document that opens a sequence
            extra_pair = pairs(number[extra], sides[2])
            extra_gap = capacity - size[extra]
            useful = (extra_pair >= 0) | (extra_gap >= smallest)
            extra, extra_pair, extra_gap = extra[useful], extra_pair[useful], extra_gap[useful]
            rows = np.flatnonzero(keep)
            order = np.concatenate([rows, extra])
            new = np.arange(len(order)) >= len(rows)
            out_kind = np.where(opening, PLACED, kind)[order]
            out_kind[new] = GAP
            out_size = size[order].copy()
            out_size[new] = extra_gap
            out_pair = np.concatenate([pair[rows], extra_pair])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_pair, pa.int64()),
                    pa.array(out_size, pa.int32()),
                    pa.array(out_kind, pa.int32()),
                    uid.take(pa.array(order)),
                    pc.if_else(pa.array(new), pa.scalar(None, payload.type), payload.take(pa.array(order))),
                ],
                ["pair", "size", "kind", "uid", "p"],
            )

    return state.mapInArrow(assign, f"pair long, size int, kind int, uid long, p {_PIECE}")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces so that sequences hold at most ``capacity`` tokens.

    Rounds: documents and gaps are range-sorted by size together; an ascending sweep matches each gap
    with the largest free document that fits it (best fit from the side of the gap); documents of one
    size that want gaps of one size are told apart by their rank; gaps shrink; the rest goes round
    again. When documents outweigh all gaps, the largest of them open new sequences. The sweep itself
    works on one count for each size and partition; rows only look up their rank, so neither ties
    (one length may be shared by a third of all rows) nor size order put work in one task.

    Pieces of the full capacity are a sequence each. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    payload = F.struct("doc_id", "piece", "start", "length", "ids_crc32").alias("p")
    start = written(
        pieces.select(
            F.col("length").cast("int").alias("size"), F.monotonically_increasing_id().alias("uid"), payload
        ),
        "pack-pieces",
    )
    done = [
        start.where(F.col("size") == capacity).select(F.col("uid").alias("sequence_id"), F.lit(0).alias("offset"), "p")
    ]
    state = start.where(F.col("size") < capacity).select("size", F.lit(ITEM).alias("kind"), "uid", "p")
    first, stuck = True, False
    while True:
        order = ("size", "kind", "uid")
        path = run_dir(spark, "pack-sorted")
        ranked = state.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("m", F.monotonically_increasing_id())
        ranked.write.option("compression", "zstd").parquet(path)
        ranked = spark.read.schema(ranked.schema).parquet(path)
        # one row for each (partition, size, kind) that occurs: bounded by the sizes and partitions
        found = (
            ranked.groupBy(F.shiftright("m", 33).alias("part"), "size", "kind")
            .agg(F.min("m").alias("m"), F.count("*").alias("n"))
            .orderBy("m")
            .collect()
        )
        kinds = np.array([r["kind"] for r in found], np.int64)
        if not (kinds == ITEM).any():
            removed(spark, path)
            break
        n = np.array([r["n"] for r in found], np.int64)
        size = np.array([r["size"] for r in found], np.int64)
        number = np.zeros(len(found), np.int64)
        counts = {}
        for kind in (ITEM, GAP):
            own = kinds == kind
            number[own] = np.cumsum(n[own]) - n[own]
            counts[kind] = np.bincount(size[own], n[own], capacity + 1).astype(np.int64)
        segments = {"m": np.array([r["m"] for r in found], np.int64), "before": number}
        plan = _plan(counts, capacity, first, stuck)
        roles = _settle(ranked, segments, plan, capacity)
        matched = F.col("pair") >= 0
        items = roles.where(matched & (F.col("kind") == ITEM)).select("pair", F.col("size").alias("own"), F.col("p"))
        gaps = roles.where(matched & (F.col("kind") == GAP)).select("pair", "size", F.col("uid").alias("sequence_id"))
        placed = items.join(gaps, "pair").select(
            F.lit(PLACED).alias("kind"), (F.col("size") - F.col("own")).alias("size"), F.col("sequence_id").alias("uid"),
            (capacity - F.col("size")).alias("offset"), "p",
        )
        others = roles.where(~matched).select(
            "kind", F.when(F.col("kind") == PLACED, 0).otherwise(F.col("size")).alias("size"), "uid", F.lit(0).alias("offset"), "p"
        )
        # few rows are few files, whatever the number of shuffle partitions; the sorted rows are used up
        after = written(placed.unionByName(others).coalesce(max(1, int(n.sum()) // ROUND_ROWS)), "pack-round")
        removed(spark, path)
        done.append(after.where(F.col("kind") == PLACED).select(F.col("uid").alias("sequence_id"), "offset", "p"))
        state = after.where((F.col("kind") != PLACED) | (F.col("size") > 0)).select(
            "size",
            F.when(F.col("kind") == PLACED, GAP).otherwise(F.col("kind")).alias("kind"),
            "uid",
            F.when(F.col("kind") == ITEM, F.col("p")).alias("p"),
        )
        first, stuck = False, not plan[1] and not plan[0]
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select("p.*", "sequence_id", F.col("offset").cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack whole documents; see :func:`token_pieces` and :func:`pack_pieces`.

    Repeated rows are packed as often as they occur. Columns other than ``doc_id`` and ``text`` are
    not read.
    """
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity), capacity)
