"""Periodic runs of words inside documents, by internal pattern matching."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import crc32_text, ranges, text_blocks, texts_of, words_of
from trialspark.llm.recompress import mix

#: A run is at least so many words and so many periods long.
LEAST, TIMES = 24, 3
#: Length of the shortest dyadic blocks: every run of ``LEAST`` words holds one and its copy a period later.
BLOCK = 8
#: Characters of the documents that are searched together.
BLOCK_CHARS = 4_000_000

#: No further occurrence.
NONE = 1 << 62
RUNS = "array<struct<start:long,length:long,period:long>>"


class Wavelet:
    """A wavelet matrix over numbers below ``len(values)``; all queries are arrays."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length()) if len(values) else 1
        self.zeros, self.middle = [], []
        for b in range(self.bits - 1, -1, -1):
            zero = (values >> b & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            self.middle.append(int(zero.sum()))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers at the places from ``left`` up to ``right`` are under ``x``."""
        found, every = np.zeros(len(x), np.int64), right - left
        for level, (zeros, middle) in enumerate(zip(self.zeros, self.middle)):
            one = (x >> (self.bits - 1 - level) & 1) == 1
            a, b = zeros[left].astype(np.int64), zeros[right].astype(np.int64)
            found += np.where(one, b - a, 0)
            left, right = np.where(one, middle + left - a, a), np.where(one, middle + right - b, b)
        return np.where(x >= 1 << self.bits, every, found)

    def smallest(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number with ``k`` smaller ones at the places from ``left`` up to ``right``."""
        found = np.zeros(len(k), np.int64)
        for level, (zeros, middle) in enumerate(zip(self.zeros, self.middle)):
            a, b = zeros[left].astype(np.int64), zeros[right].astype(np.int64)
            one = k >= b - a
            found |= one.astype(np.int64) << (self.bits - 1 - level)
            k = np.where(one, k - (b - a), k)
            left, right = np.where(one, middle + left - a, a), np.where(one, middle + right - b, b)
        return found

    def after(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest number over ``x`` at those places, or ``NONE``."""
        rank = self.below(left, right, x + 1)
        there = rank < right - left
        found = np.full(len(x), NONE, np.int64)
        found[there] = self.smallest(left[there], right[there], rank[there])
        return found


def _repeating(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Documents in which some ``BLOCK`` words occur twice (by a hash, so a few others too)."""
    n = len(codes) - BLOCK + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    c = mix(codes.astype(np.uint64))
    h = c[:n].copy()
    for j in range(1, BLOCK):
        h = h * np.uint64(0x9E3779B97F4A7C15) + c[j : n + j]
    inside = owner[:n] == owner[BLOCK - 1 :]
    h = h[inside] + owner[:n][inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    own = owner[:n][inside]
    by = np.argsort(h)
    return np.unique(own[by[1:][h[by][1:] == h[by][:-1]]])


def _suffixes(codes: np.ndarray, owner: np.ndarray, ends: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of all documents, and the aligned dyadic blocks that occur again.

    Suffixes are told apart by doubling, each only as far as its document can hold a run of that
    period. A block is a row (place, length, first and last place of its occurrences in the array);
    equal blocks of other documents are not occurrences.
    """
    n = len(codes)
    place = np.arange(n)
    key = owner * (int(codes.max()) + 1) + codes
    suffix = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def renamed(at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Gives the sorted suffixes at ``at`` their new ranks; returns which stand in groups of several."""
        first = np.ones(len(at), bool)
        first[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(first)
        size = np.diff(heads, append=len(at))
        rank[suffix[at]] = np.repeat(at[heads], size)
        return np.repeat(size, size)

    at = place
    size = renamed(at, key[suffix])
    length, blocks = 1, []
    reach = (ends - begins) // TIMES
    while True:
        keep = size > 1
        at, size = at[keep], size[keep]
        if length >= BLOCK:
            # at higher levels a document takes part while a period of that length fits
            p = suffix[at]
            fits = reach[p] >= length
            at, size, p = at[fits], size[fits], p[fits]
            aligned = (p - begins[p]) % length == 0
            q = p[aligned]
            blocks.append(np.stack([q, np.full(len(q), length), rank[q], rank[q] + size[aligned]]))
        if not len(at):
            return suffix, blocks
        p = suffix[at]
        beyond = p + length >= ends[p]
        follow = np.where(beyond, 0, rank[np.minimum(p + length, n - 1)] + 1)
        key = rank[p] * (n + 1) + follow
        by = np.argsort(key, kind="stable")
        suffix[at] = p[by]
        size = renamed(at, key[by])
        length *= 2


def _extents(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray, period: np.ndarray):
    """The longest stretch with ``period`` around each place, whose document is ``begin`` to ``end``.

    Empty where the word a period later differs. Places in one stretch are extended once.
    """
    first, last = at.copy(), at.copy()
    by = np.lexsort((at, period))
    places, periods = at[by], period[by]
    group_end = np.searchsorted(periods, periods, side="right").tolist()
    listed = list(zip(places.tolist(), periods.tolist(), begin[by].tolist(), end[by].tolist()))
    k = 0
    while k < len(listed):
        i, q, low, high = listed[k]
        stop, step, right = high - q, 32, i
        while right < stop:
            n = min(step, stop - right)
            differ = codes[right : right + n] != codes[right + q : right + q + n]
            miss = int(differ.argmax())
            if differ[miss]:
                right += miss
                break
            right, step = right + n, step * 2
        if right <= i:
            k += 1
            continue
        left, step = i, 32
        while left > low:
            n = min(step, left - low)
            differ = codes[left - n : left][::-1] != codes[left - n + q : left + q][::-1]
            miss = int(differ.argmax())
            if differ[miss]:
                left -= miss
                break
            left, step = left - n, step * 2
        upto = k + int(np.searchsorted(places[k : group_end[k]], right))
        first[by[k:upto]] = left
        last[by[k:upto]] = right + q
        k = upto
    return first, last


def _candidates(codes, begins, ends, suffix, blocks) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that some run may have.

    A run holds an aligned block and its copy one period later, within two lengths of the block. The
    occurrences of a block there form progressions whose difference is the block's own period, if that
    is at most half its length; a run's period is such a difference or the distance of the first, or of
    the last, members of two progressions.
    """
    at, length, left, right = (np.concatenate(c) for c in zip(*blocks))
    tree = Wavelet(suffix)
    found_at, found_period = [], []

    def progression(who, start, period):
        """First and last occurrence of the progression through ``start``."""
        a, e = _extents(codes, begins[start], ends[start], start, period)
        return start - (start - a) // period * period, start + (e - length[who] - start) // period * period

    who = np.arange(len(at))
    start = at.copy()
    own = np.zeros(len(at), np.int64)
    first0, last0 = at.copy(), at.copy()
    step = 0
    while len(who):
        following = tree.after(left[who], right[who], start)
        gap = following - start
        many = gap <= length[who] // 2
        first, last = start.copy(), start.copy()
        if many.any():
            first[many], last[many] = progression(who[many], start[many], gap[many])
            fresh = many & (own[who] == 0)
            if fresh.any():
                w = who[fresh]
                own[w] = gap[fresh]
                if step:
                    first0[w], last0[w] = progression(w, at[w], own[w])
        if step == 0:
            first0[who], last0[who] = first, last
            found_at.append(at[who[many]])
            found_period.append(gap[many])
        else:
            for period in (first - first0[who], last - last0[who]):
                found_at.append(at[who])
                found_period.append(period)
        following[many] = tree.after(left[who[many]], right[who[many]], last[many])
        near = following < at[who] + 2 * length[who]
        who, start, step = who[near], following[near], step + 1
    return np.concatenate(found_at), np.concatenate(found_period)


def runs_in(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start in it, length and smallest period of every run; by document, start, period.

    ``codes`` are the words of all documents one after the other, ``lengths`` the documents' numbers of words.
    """
    none = (np.zeros(0, np.int64),) * 4
    starts = np.cumsum(lengths) - lengths
    chosen = _repeating(codes, np.repeat(np.arange(len(lengths)), lengths))
    chosen = chosen[lengths[chosen] >= LEAST]
    if not len(chosen):
        return none
    size = lengths[chosen]
    codes = codes[ranges(starts[chosen], size)]
    _, codes = np.unique(codes, return_inverse=True)
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    begins, ends = begin[owner], (begin + size)[owner]
    suffix, blocks = _suffixes(codes, owner, ends, begins)
    if not any(b.shape[1] for b in blocks):
        return none
    at, period = _candidates(codes, begins, ends, suffix, blocks)
    good = (period > 0) & (period * TIMES <= ends[at] - begins[at])
    at, period = at[good], period[good]
    first, last = _extents(codes, begins[at], ends[at], at, period)
    good = last - first >= np.maximum(LEAST, TIMES * period)
    first, last, period = first[good], last[good], period[good]
    # one stretch has one smallest period; any other is a multiple of it
    by = np.lexsort((period, last, first))
    first, last, period = first[by], last[by], period[by]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    first, last, period = first[new], last[new], period[new]
    by = np.lexsort((period, first))
    first, last, period = first[by], last[by], period[by]
    return chosen[owner[first]], first - begins[first], last - first, period


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The periodic runs of each document's words, and its words without the repeats.

    A run is a stretch of words with smallest period q (words q apart are equal) of at least 24 words
    and 3 q, that no neighbouring word extends. Returns for each row ``doc_id``, ``n_words``, ``runs``
    (``start``, ``length``, ``period``; by start, then period), ``words_sha256`` (words joined by one
    space) and ``collapsed``: the words that no run holds beyond its first period, null if that is all.

    Every document is searched where it is: nothing is shuffled. Those in which some 8 words repeat get
    a suffix array by doubling; aligned blocks of 8, 16, 32 ... words find their occurrences in the
    neighbouring window by range successors in a wavelet matrix over that array, progressions of
    occurrences give candidate periods, and each candidate is extended to its whole stretch and checked
    word by word. One document is never split: a task takes about 400 bytes for each of its words.

    A null text has no words, repeated rows each give a row, a null id stays null, an empty table gives
    no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in text_blocks(batches, BLOCK_CHARS):
            words = [words_of(t) for t in texts]
            lengths = np.array([len(w) for w in words], np.int64)
            numbers: dict[bytes, int] = {}
            codes = np.fromiter(
                (numbers.setdefault(x, len(numbers)) for w in words for x in w), np.int64, int(lengths.sum())
            )
            doc, start, length, period = runs_in(codes, lengths)
            edges = np.searchsorted(doc, np.arange(len(ids) + 1))
            collapsed, digests = [], []
            for k, own in enumerate(words):
                digests.append(hashlib.sha256(b" ".join(own)).hexdigest())
                a, b = edges[k], edges[k + 1]
                if a == b:
                    collapsed.append(None)
                    continue
                kept = np.zeros(len(own) + 1, np.int64)
                np.add.at(kept, start[a:b] + period[a:b], 1)
                np.add.at(kept, start[a:b] + length[a:b], -1)
                kept = (np.cumsum(kept)[:-1] == 0).tolist()
                collapsed.append(b" ".join(w for w, stays in zip(own, kept) if stays).decode("utf-8", "surrogatepass"))
            found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), found),
                 pa.array(digests), pa.array(collapsed, pa.string())],
                ["doc_id", "n_words", "runs", "words_sha256", "collapsed"],
            )

    return texts_of(docs).mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, words_sha256 string, collapsed string"
    )


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first in order."""
    return F.aggregate(
        F.slice(runs, F.lit(2), F.size(runs)), runs[0],
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; one document in ten has its words from some place on made periodic.

    With h the crc32 of the decimal id, g = h // 10: where h % 10 is 0, each word i >= a = g % n becomes
    word a + (i - a) % p, with p = 1 + (n - a) // (3 + g % 8). A null id changes nothing.
    """
    h = crc32_text("doc_id")
    g = F.floor(h / 10).cast("long")

    def changed(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        # places are bound once, not worked out again for each word
        return F.transform(
            F.array(F.struct(words.alias("w"), n.alias("n"), a.alias("a"), p.alias("p"))),
            lambda v: F.array_join(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), v["n"] - 1),
                    lambda i: F.get(v["w"], F.when(i < v["a"], i).otherwise(v["a"] + (i - v["a"]) % v["p"]).cast("int")),
                ), " ",
            ),
        )[0]

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, changed(w)))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(made, "text")).otherwise(F.col("text")).alias("text"))
