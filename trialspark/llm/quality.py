"""A quality classifier trained by two views that teach each other."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import slices, text_blocks, words_of
from trialspark.llm.labelled import held_out, labelled_sample, linear, logistic, sigmoid

#: Labelled documents of each class and documents without a usable label that are learned from, at most.
SAMPLE_ROWS, UNLABELLED_ROWS = 8_000, 8_000
ROUNDS = 3
#: A view hands on its judgement where it is at least so sure; such a row weighs less than a label.
CONFIDENT, PSEUDO_WEIGHT = 0.95, 0.3
THRESHOLD = 0.5
#: Hashed places of languages and sources.
PLACES = 32

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LETTERS = _UPPER + _UPPER.lower()
_DIGITS = b"0123456789"
_MARKS = b"!?*#|<>{}[]=_~^$%&@/\\+"
_POINTS = b".,;:"


def content_features(text: str) -> list[float]:
    """What the text itself shows: repetition, letters, marks, word lengths."""
    raw = text.encode("utf-8", "surrogatepass")
    words = words_of(text)
    n, size = max(1, len(words)), max(1, len(raw))
    lower = [w.lower() for w in words]
    distinct = set(lower)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    without = lambda marks: 1 - len(raw.translate(None, marks)) / size
    upper = size - len(raw.translate(None, _UPPER))
    letters = size - len(raw.translate(None, _LETTERS))
    return [
        np.log1p(len(words)),
        len(distinct) / np.sqrt(n),
        len(distinct) / n,
        sum(map(operator.eq, lower, lower[1:])) / n,
        sum(map(operator.eq, lower, lower[2:])) / n,
        upper / max(1, letters),
        without(_DIGITS),
        without(_MARKS),
        without(_POINTS),
        sum(map(len, words)) / n,
        float(np.std([len(w) for w in words[:]])) if words else 0.0,
        len(lines) / np.sqrt(n),
        1 - len(set(lines)) / max(1, len(lines)),
        max(map(len, words), default=0) / 100.0,
        float(not words),
    ]


CONTENT = 15


def metadata_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """What is known of a document besides its text: hashed language and source, and its length in steps."""
    out = np.zeros((len(lang), 2 * PLACES + 24))
    for i, (a, b, c) in enumerate(zip(lang, source, n_chars)):
        out[i, xxhash.xxh32_intdigest(f"l{a}") % PLACES] = 1
        out[i, PLACES + xxhash.xxh32_intdigest(f"s{b}") % PLACES] = 1
        out[i, 2 * PLACES + (0 if c is None or c < 0 else min(23, 1 + int(c).bit_length()))] = 1
    return out


@dataclass
class Model:
    """Scaling and weights of both views, and how their logits are put together."""

    mean: np.ndarray
    scale: np.ndarray
    content: np.ndarray
    metadata: np.ndarray
    together: np.ndarray

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        a = linear(np.clip((content - self.mean) / self.scale, -8, 8), self.content)
        b = linear(metadata, self.metadata)
        return np.column_stack([sigmoid(a), sigmoid(b), sigmoid(linear(np.column_stack([a, b]), self.together))])


def co_train(content: np.ndarray, metadata: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> Model:
    """``y`` is 1, 0 or, without a label, nan. A fourth of the labels is kept to calibrate the combination."""
    mean, scale = content.mean(0), content.std(0) + 1e-9
    views = [np.clip((content - mean) / scale, -8, 8), metadata]
    known = ~np.isnan(y)
    kept = known & (np.cumsum(known) % 4 == 0)
    learned = known & ~kept
    taught = [np.full(len(y), np.nan), np.full(len(y), np.nan)]
    weights = [np.zeros(1), np.zeros(1)]
    for step in range(rounds):
        for v in (0, 1):
            pseudo = ~known & ~np.isnan(taught[v])
            use = learned | pseudo
            target = np.where(known, y, taught[v])[use]
            weights[v] = logistic(views[v][use], target, np.where(pseudo, PSEUDO_WEIGHT, weight)[use], 1.0)
        if step + 1 < rounds:
            for v in (0, 1):  # each view teaches the other what it is sure of
                p = sigmoid(linear(views[v], weights[v]))
                taught[1 - v] = np.where(p >= CONFIDENT, 1.0, np.where(p <= 1 - CONFIDENT, 0.0, np.nan))
    logits = np.column_stack([linear(x, w) for x, w in zip(views, weights)])
    together = logistic(logits[kept], y[kept], weight[kept], 1e-2)
    return Model(mean, scale, weights[0], weights[1], together)


def _columns(docs: DataFrame) -> DataFrame:
    has = set(docs.columns)
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    more = [(F.col(c) if c in has else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def _views(texts: list[str], more: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
    content = np.array([content_features(t) for t in texts], float).reshape(len(texts), CONTENT)
    return content, metadata_features(more["lang"], more["source"], more["n_chars"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, unlabelled: int = UNLABELLED_ROWS) -> Model | None:
    """Learn from bounded samples of labelled and of other documents; None without both classes.

    Held-out documents are in neither sample. Samples are bounded by ``rows`` of each class and
    ``unlabelled``, so that their features, a few hundred bytes each, fit the driver.
    """
    sample, sizes = labelled_sample(labels, "quality", rows)
    if not (sizes.get(0) and sizes.get(1)):
        return None
    own = _columns(docs)
    total = max(1, docs.count())
    place = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    # both broadcasts are bounded by the sample sizes
    marked = own.join(F.broadcast(sample), "doc_id", "left").where(
        F.col("y").isNotNull() | (~held_out() & (place < min(1.0, unlabelled / total)))
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, more in text_blocks(batches, 4_000_000):
            content, metadata = _views(texts, more)
            yield pa.RecordBatch.from_arrays(
                [pa.array(more["y"], pa.int32()), pa.array(list(content)), pa.array(list(metadata))], ["y", "content", "metadata"]
            )

    found = marked.drop("doc_id").withColumn("doc_id", F.lit(0).cast("long")).mapInArrow(
        features, "y int, content array<double>, metadata array<double>"
    ).toPandas()
    y = found["y"].to_numpy(float)
    if not ((y == 0).sum() > 4 and (y == 1).sum() > 4):
        return None
    weight = np.ones(len(y))
    for c in (0, 1):
        weight[y == c] = sizes[c] / (y == c).sum()
    weight[~np.isnan(y)] *= (~np.isnan(y)).sum() / weight[~np.isnan(y)].sum()
    order = np.lexsort((np.stack(found["content"])[:, 1], np.stack(found["content"])[:, 0]))  # whatever the order of tasks
    return co_train(np.stack(found["content"])[order], np.stack(found["metadata"])[order], y[order], weight[order])


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, content_score, metadata_score, score, keep`` of every document.

    Scores are probabilities of quality 1. Null text is empty, null or missing metadata is a value of
    its own; without labels of both classes every score is 1, so that nothing is rejected unheard. All
    rows stay; an empty table gives no rows.
    """
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for ids, texts, more in text_blocks(batches, 4_000_000):
            scores = own.scores(*_views(texts, more)) if own else np.ones((len(texts), 3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *[pa.array(np.ascontiguousarray(scores[:, i])) for i in range(3)]],
                ["doc_id", "content_score", "metadata_score", "score"],
            )

    scored = _columns(docs).mapInArrow(run, "doc_id long, content_score double, metadata_score double, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "content_score", "metadata_score", "score",
        (F.col("score") >= threshold).alias("keep"),
    )


def of_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, all columns as they are; see :func:`score_quality`."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for batch in slices(whole):
                if own:
                    texts = [t or "" for t in batch.column("text").to_pylist()]
                    more = {
                        c: batch.column(c).to_pylist() if c in names else [None] * len(texts)
                        for c in ("lang", "source", "n_chars")
                    }
                    batch = batch.filter(pa.array(own.scores(*_views(texts, more))[:, 2] >= threshold))
                yield batch

    return docs.mapInArrow(run, docs.schema)
