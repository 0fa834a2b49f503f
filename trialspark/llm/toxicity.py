"""Toxicity scores from class-conditional Kneser-Ney models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import slices, text_blocks, texts_of, words_of, written
from trialspark.llm.labelled import held_out, labelled_sample, linear, logistic, sigmoid
from trialspark.llm.recompress import mix, word_names

#: Labelled documents of each class that are learned from, at most (documented sample bound).
SAMPLE_ROWS = 20_000
#: Of those, one in so many is kept from the counts to calibrate the score.
CALIBRATION = 4
#: Discounts: each gives a pair of models of its own, the larger ones trust only frequent expressions. None is
#: under 1, so an expression of one document is left to the backoff, and the tables need not hold it.
DISCOUNTS = (1.0, 2.0, 4.0, 8.0)
THRESHOLD = 0.7
_EDGES = b".,!?;:\"'()[]"
_START = np.uint64(3)


def _names(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word names of all texts, one after the other, and the number of words of each."""
    split = [[w.strip(_EDGES) or w for w in words_of(t.lower())] for t in texts]
    return word_names([w for words in split for w in words]), np.fromiter(map(len, split), np.int64, len(split))


def _before(names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The word before each word, or the start."""
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[(np.cumsum(counts) - counts)[counts > 0]] = _START
    return before


def _pair(before: np.ndarray, names: np.ndarray) -> np.ndarray:
    return mix(mix(before) * np.uint64(3) + names)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class with a word (kind 0) or with a pair of words (kind 1, ``before`` its first)."""
    for _, texts, more in text_blocks(batches, 3_000_000):
        names, counts = _names(texts)
        doc = np.repeat(np.arange(len(texts)), counts)
        y = np.array(more["y"], np.int64)
        before = _before(names, counts)
        for kind, keys in ((0, names), (1, _pair(before, names))):
            key, at, of = np.unique(keys, return_index=True, return_inverse=True)
            seen = np.unique(of * len(texts) + doc)
            own, toxic = seen // max(1, len(texts)), y[seen % max(1, len(texts))] == 1
            columns = [key, names[at], before[at]]
            n = [np.bincount(own[m], minlength=len(key)) for m in (~toxic, toxic)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), kind, np.int32)), *[pa.array(c.view(np.int64)) for c in columns], *[pa.array(c.astype(np.int64)) for c in n]],
                ["kind", "key", "word", "before", "n0", "n1"],
            )


@dataclass
class Counts:
    """Class counts of words, of pairs and of contexts (first words of pairs); keys are sorted.

    Expressions that no discount leaves anything of are not held: their probability is the backoff's.
    """

    words: np.ndarray
    word_n: np.ndarray
    shared: np.ndarray
    pairs: np.ndarray
    pair_n: np.ndarray
    contexts: np.ndarray
    context_n: np.ndarray
    context_mass: np.ndarray
    total: np.ndarray
    total_mass: np.ndarray

    def ratios(self, names: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log P(word | the one before, toxic) - log P(... ordinary), a row for each discount."""

        def found(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
            out = np.zeros((len(wanted), *values.shape[1:]))
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[at] == wanted
                out[hit] = values[at[hit]]
            return out

        word, pair, context = (
            found(self.words, names, self.word_n), found(self.pairs, _pair(before, names), self.pair_n),
            found(self.contexts, before, self.context_n),
        )
        share = np.maximum(found(self.words, names, self.shared), self.shared.min(initial=1.0))
        mass = found(self.contexts, before, self.context_mass)
        seen = context > 0
        out = np.empty((len(DISCOUNTS), len(names)))
        for k, d in enumerate(DISCOUNTS):
            p = (np.maximum(word - d, 0) + self.total_mass[k] * share[:, None]) / self.total
            p = np.where(seen, (np.maximum(pair - d, 0) + mass[:, k] * p) / np.where(seen, context, 1), p)
            out[k] = np.log(p[:, 1] / p[:, 0])
        return out


def features(counts: Counts, texts: list[str]) -> np.ndarray:
    """Per discount the length-normalised difference of log-likelihoods, and what stands out of a text's median.

    A text's median ratio is what its language and topic weigh; expressions over it by more than 1 are
    added up, over all words and as they are.
    """
    names, sizes = _names(texts)
    ratio = counts.ratios(names, _before(names, sizes)) if len(names) else np.zeros((len(DISCOUNTS), 0))
    out = np.zeros((len(texts), 3 * len(DISCOUNTS) + 1))
    out[:, -1] = np.log1p(sizes)
    ends = np.cumsum(sizes)
    for i, (a, b) in enumerate(zip(ends - sizes, ends)):
        if b > a:
            own = ratio[:, a:b]
            high = np.maximum(own - np.median(own, axis=1)[:, None] - 1, 0).sum(1)
            out[i, :-1] = np.concatenate([own.mean(1), high / (b - a), np.log1p(high)])
    return out


@dataclass
class Model:
    """Counts as every worker has them, and the few numbers of the logistic fit."""

    counts: Broadcast
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(linear((features(self.counts.value, texts) - self.mean) / self.scale, self.weights))


def _columns(table: pa.Table, *names: str) -> np.ndarray:
    return np.stack([table.column(n).to_numpy().astype(np.float64) for n in names], axis=1)


def count_classes(chosen: DataFrame) -> Counts | None:
    """Word and pair counts of labelled texts (``doc_id``, ``text``, ``y``); none unless both classes have words."""
    counted = (
        chosen.mapInArrow(_count, "kind int, key long, word long, before long, n0 long, n1 long")
        .groupBy("kind", "key", "word", "before")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    counted = written(counted, "toxicity-counts")
    pairs = counted.where("kind = 1")
    # a word's row names the word before it somewhere; only pairs are told apart by it
    words = counted.where("kind = 0").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    mass = lambda n, d: F.sum(F.least(F.col(n).cast("double"), F.lit(d)))
    masses = [mass(n, d).alias(f"{n}_{k}") for k, d in enumerate(DISCOUNTS) for n in ("n0", "n1")]
    sums = words.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), *masses).first()
    distinct_pairs = pairs.count()
    if not (sums["n0"] and sums["n1"] and distinct_pairs):
        return None
    least = min(DISCOUNTS)
    held = (F.col("n0") > least) | (F.col("n1") > least)
    followed = pairs.groupBy("word").agg(F.count("*").alias("before"))
    word = words.where(held).join(followed, "word").select("word", "n0", "n1", "before").toArrow().sort_by("word")
    pair = pairs.where(held).select("key", "n0", "n1").toArrow().sort_by("key")
    frequent = pairs.groupBy("before").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.bool_or(held).alias("held"), *masses
    ).where("held")
    context = frequent.drop("held").toArrow().sort_by("before")
    names = [f"{n}_{k}" for k in range(len(DISCOUNTS)) for n in ("n0", "n1")]

    def keyed(table: pa.Table, key: str) -> tuple[np.ndarray, np.ndarray]:
        keys = table.column(key).to_numpy().view(np.uint64)
        order = np.argsort(keys)
        return keys[order], order

    w, by_word = keyed(word, "word")
    p, by_pair = keyed(pair, "key")
    c, by_context = keyed(context, "before")
    return Counts(
        w, _columns(word, "n0", "n1")[by_word].astype(np.float32),
        (_columns(word, "before")[by_word, 0] / distinct_pairs) if len(w) else np.array([1 / distinct_pairs]),
        p, _columns(pair, "n0", "n1")[by_pair].astype(np.float32),
        c, _columns(context, "n0", "n1")[by_context].astype(np.float32),
        _columns(context, *names)[by_context].reshape(-1, len(DISCOUNTS), 2).astype(np.float32),
        np.array([sums["n0"], sums["n1"]], float), np.array([sums[n] for n in names]).reshape(-1, 2),
    )


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Kneser-Ney models of both classes with one shared backoff.

    P_c(v | u) = (max(n_c(u v) - D, 0) + g_c(u) P_c(v)) / n_c(u), and below it
    P_c(v) = (max(n_c(v) - D, 0) + g_c S(v)) / N_c: n_c counts the documents of class c that hold the
    expression, D is discounted from each count and g is the discounted mass. S(v) is v's share of the
    continuation counts (distinct words before it) over both classes. So an expression that is rare in
    both has nearly the same probability in both. Equal texts count once. All words and pairs of the
    sample count; the sample (:data:`SAMPLE_ROWS` of each class) is the only bound. A logistic fit on a
    part of it that was not counted turns length-normalised differences into a probability. None without
    labels of both classes in both parts.
    """
    sample, sizes = labelled_sample(labels, "toxic", rows)
    if not (sizes.get(0) and sizes.get(1)):
        return None
    # at most 2 * rows ids, by the bound of the sample
    chosen = texts_of(docs).join(F.broadcast(sample), "doc_id")
    chosen = chosen.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("h")).agg(
        F.min("doc_id").alias("doc_id"), F.max("y").alias("y"), F.first("text").alias("text")
    )
    chosen = written(chosen, "toxicity-sample")
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(CALIBRATION))
    counts = count_classes(chosen.where(part > 0).select("doc_id", "text", "y"))
    if counts is None:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    del counts
    width = 3 * len(DISCOUNTS) + 1

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, more in text_blocks(batches, 1_000_000):
            x = features(shared.value, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(more["y"], pa.int32()), *[pa.array(c) for c in x.T]],
                ["doc_id", "y", *[f"x{k}" for k in range(width)]],
            )

    found = chosen.where(part == 0).select("doc_id", "text", "y").mapInArrow(
        described, "doc_id long, y int, " + ", ".join(f"x{k} double" for k in range(width))
    )
    found = found.toArrow().sort_by("doc_id")
    y = found.column("y").to_numpy().astype(float)
    if not (0 < y.sum() < len(y)):
        return None
    # each class counts as often as it occurs among the labels, not in the sample
    share = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (len(y) - y.sum())) * len(y) / (sizes[0] + sizes[1])
    x = _columns(found, *[f"x{k}" for k in range(width)])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    return Model(shared, mean, scale, logistic((x - mean) / scale, y, share, 1.0))


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each whole text.

    Labels are learned only from documents outside the held-out fold; the score sees the text alone.
    Null and empty texts get the score of no evidence; without labels of both classes every score is 0.
    The counts go to the workers once; they are bounded by the sample. All rows stay; an empty table gives no rows.
    """
    model = fit(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in text_blocks(batches, 1_000_000):
            score = model.score(texts) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(score)], ["doc_id", "score"])

    scored = texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns as they are; see :func:`score_toxicity`."""
    model = fit(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 300):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(model.score(texts) < threshold)) if model else batch

    return docs.mapInArrow(run, docs.schema)
