"""Benchmark passages in documents, by one Aho-Corasick automaton over all windows of the benchmark."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import written

#: Consecutive words whose repeat counts.
WINDOW = 10
#: Characters of the windows in one automaton, which takes about 100 bytes for each in a worker. A larger
#: benchmark is dealt over several automata, and texts are scanned once for each.
SHARD_CHARS = 4_000_000

#: Bytes of words stay (A-Z in lower case); every other ASCII byte becomes a space. Multi-byte characters are words.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
FOUND = "array<struct<first:int,last:int>>"
SPANS = "array<struct<first:int,last:int,start:int,end:int>>"


def plain_words(raw: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z in lower case."""
    return raw.translate(_TABLE).split() if raw else []


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``window`` (words with a space before and after each), its number of words and ``item``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found, sizes = [], [], []
            for item, raw in zip(batch.column("item").to_pylist(), batch.column("raw").to_pylist()):
                words = plain_words(raw)
                size = min(window, len(words))
                for k in range(len(words) - size + 1 if words else 0):
                    items.append(item)
                    found.append(b" %s " % b" ".join(words[k : k + size]))
                    sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(found, pa.binary()), pa.array(sizes, pa.int32())],
                ["item", "window", "size"],
            )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("raw"))
    return rows.mapInArrow(run, "item string, window binary, size int").distinct()


_kept: dict[str, tuple] = {}


def _automaton(name: str, shipped: Broadcast) -> tuple:
    """The automaton of a shard, with the size and the items of each window; a worker keeps the last one."""
    import ahocorasick

    if name not in _kept:
        numbers: dict[bytes, int] = {}
        sizes: list[int] = []
        items: list[list[str]] = []
        built = ahocorasick.Automaton()
        for window, size, item in zip(*(c.to_pylist() for c in shipped.value.columns)):
            at = numbers.setdefault(window, len(numbers))
            if at == len(sizes):
                built.add_word(window.decode("latin-1"), at)
                sizes.append(size)
                items.append([])
            if item is not None:
                items[at].append(item)
        built.make_automaton()
        _kept.clear()
        _kept[name] = built, np.array(sizes, np.int64), items
    return _kept[name]


def _spans(raw: bytes, hit: np.ndarray) -> list[dict]:
    """Stretches of hit words with their places in the text as given, in code points; ends are exclusive."""
    edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    data = np.frombuffer(raw, np.uint8)
    word = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [
        {"first": f, "last": e, "start": s, "end": t}
        for f, e, s, t in zip(
            first.tolist(), last.tolist(), before[starts[first]].tolist(), before[ends[last - 1]].tolist()
        )
    ]


def _scan(docs: DataFrame, shipped: Broadcast | None) -> DataFrame:
    """Adds the hits of one shard to ``spans`` and ``items``."""

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, sizes, items_of = _automaton(name, shipped) if shipped is not None else (None, None, None)
        for batch in batches:
            counts, spans, items = [], [], []
            for raw, old_spans, old_items in zip(
                batch.column("raw").to_pylist(), batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            ):
                words = plain_words(raw)
                counts.append(len(words))
                found = []
                if automaton is not None and words:
                    joined = b" %s " % b" ".join(words)
                    found = list(automaton.iter(joined.decode("latin-1")))
                if found:
                    ends, numbers = (np.array(c, np.int64) for c in zip(*found))
                    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
                    end = np.searchsorted(spaces, ends)
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, end - sizes[numbers], 1)
                    np.add.at(change, end, -1)
                    for s in old_spans:
                        change[s["first"]] += 1
                        change[s["last"]] -= 1
                    old_spans = _spans(raw, np.cumsum(change)[:-1] > 0)
                    own = set(old_items)
                    for at in np.unique(numbers).tolist():
                        own.update(items_of[at])
                    old_items = sorted(own)
                spans.append(old_spans)
                items.append(old_items)
            columns = {
                "doc_id": batch.column("doc_id"), "raw": batch.column("raw"), "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, batch.schema.field("spans").type), "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, f"doc_id long, raw binary, n_words long, spans {SPANS}, items array<string>")


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """Where documents hold ``window`` consecutive words of a benchmark item.

    Words are runs of ASCII letters, digits and characters beyond ASCII; A-Z count as a-z. An item of
    fewer words, but not none, is one window. Returns for each row of ``docs``: ``doc_id``,
    ``n_words``, ``spans`` (stretches of hit words: numbers of the first word and the one after the
    last, start and end in the text as given, in code points) and ``items`` (the ids of the items with
    a window there, as sorted strings).

    The windows of all items are one automaton that every task loads once and runs over each of its
    texts once; nothing is shuffled, so common passages cost no more than their own characters. The
    size of what is broadcast is counted first: a benchmark over ``shard_chars`` is dealt by hash over
    several automata of that size, and the texts with what was found so far are scanned again for each.

    A null text has no words; repeated rows each give a row, a null ``doc_id`` stays null. Items
    without words hit nothing; an item without an id hits words, but is not listed; repeated items
    are one. An empty benchmark hits nothing, an empty table gives no rows. Other columns of either
    table are not read.
    """
    spark = docs.sparkSession
    windows = written(benchmark_windows(benchmark, window), "benchmark-windows")
    chars = windows.agg(
        F.sum(F.length("window") + F.coalesce(F.length("item"), F.lit(0))).alias("n")
    ).first()["n"] or 0
    shards = math.ceil(chars / shard_chars)
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    if not shards:
        return _scan(found, None).drop("raw")
    for shard in range(shards):
        mine = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(shards)) == shard)
        found = _scan(found, spark.sparkContext.broadcast(mine.select("window", "size", "item").toArrow()))
        if shard + 1 < shards:
            found = written(found, "benchmark-hits")
    return found.drop("raw")
