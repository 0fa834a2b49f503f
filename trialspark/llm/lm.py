"""Language-model scores by a weighted backoff automaton over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm import exchange as X
from trialspark.llm.common import crc32_fold, pack, unpack, words_of, written
from trialspark.llm.recompress import mix, word_names

#: Names of the end of a text, and of the state before its first word.
END, BEGIN = 1, 2
#: Added to the count of each token at the root.
ADDED = 0.1
#: The failure arc of a state seen c times weighs 1 / (1 + A * c^B): rarely seen states fall back more.
BACKOFF_A, BACKOFF_B = 0.2, 0.28
FOLDS, HELD_OUT = 10, 0
WORD, PAIR = 0, 1

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _streams(ids: list, texts: list[str]) -> list[tuple]:
    sequences = [np.append(word_names(words_of(t.translate(_LOWER))), np.uint64(END)) for t in texts]
    counts = np.fromiter(map(len, sequences), np.int64, len(sequences))
    names, stream = np.unique(np.concatenate(sequences), return_inverse=True)
    held = crc32_fold(np.array([0 if i is None else i for i in ids], np.int64), FOLDS) == HELD_OUT
    held &= np.array([i is not None for i in ids])
    return [
        (X.SELF, 0, X.pack_ids(ids), pack(np.concatenate([counts, held.astype(np.int64)])),
         X.pack_planes(stream.astype(np.uint32)), X.pack_sorted(names))
    ]


class _Block:
    """A block's tokens, their states and the distinct arcs, both numbered in ascending order of name."""

    def __init__(self, row: dict):
        self.ids = X.unpack_ids(row["a"])
        both = unpack(row["b"], np.int64)
        self.counts, self.held = both[: len(both) // 2], both[len(both) // 2 :].astype(bool)
        self.stream = X.unpack_planes(row["c"], np.uint32).astype(np.int64)
        self.names = X.unpack_sorted(row["d"])
        self.firsts = np.cumsum(self.counts) - self.counts
        n = len(self.names)
        state = np.empty_like(self.stream)
        state[1:] = self.stream[:-1]
        state[self.firsts] = n  # the state before the first word
        self.state = state
        arcs, arc_of = np.unique(state * (n + 1) + self.stream, return_inverse=True)
        from_names = mix(np.append(self.names, np.uint64(BEGIN)))[arcs // (n + 1)]
        keys = mix(from_names * np.uint64(3) + self.names[arcs % (n + 1)])
        order = np.argsort(keys)
        self.arcs = keys[order]
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.arc_of = place[arc_of]
        self.training = ~np.repeat(self.held, self.counts)


def _requests(shares: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                for kind, keys, of in ((WORD, block.names, block.stream), (PAIR, block.arcs, block.arc_of)):
                    counts = np.bincount(of[block.training], minlength=len(keys)).astype(np.uint32)
                    edges = X.share_edges(keys, shares).tolist()
                    yield X.rows([
                        (row["block"], s, kind, X.pack_sorted(keys[a:b]), X.pack_planes(counts[a:b]), None, None)
                        for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a
                    ])

    return run


def _totals(table: pa.Table) -> pa.Table:
    """Sums of one share: the count of each key goes back to each block that asked, in its order.

    The first row also tells how many training tokens and distinct ones the share holds.
    """
    asked = table.to_pylist()
    keys = [X.unpack_sorted(r["a"]) for r in asked]
    own = np.concatenate([X.unpack_planes(r["b"], np.uint32) for r in asked]).astype(np.int64)
    _, of = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(of, own).astype(np.int64)
    back = np.split(sums[of], np.cumsum([len(k) for k in keys])[:-1])
    stats = np.zeros(2, np.int64)
    if asked[0]["kind"] == WORD:
        stats[:] = own.sum(), (sums > 0).sum()
    out = [
        (r["block"], r["share"], r["kind"], X.pack_planes(b.astype(np.uint32)), None, None, None)
        for r, b in zip(asked, back)
    ]
    told = [stats.tolist() if i == 0 else [0, 0] for i in range(len(out))]
    batch = X.rows(out)
    return pa.Table.from_batches([batch]).append_column("tokens", pa.array([t[0] for t in told], pa.int64())).append_column(
        "types", pa.array([t[1] for t in told], pa.int64())
    )


def _scores(tokens: int, types: int):
    def score(table: pa.Table) -> pa.Table:
        found = table.to_pylist()
        block = _Block(next(r for r in found if r["share"] == X.SELF))
        answers = {WORD: [], PAIR: []}
        for r in sorted((r for r in found if r["share"] != X.SELF), key=lambda r: r["share"]):
            answers[r["kind"]].append(X.unpack_planes(r["a"], np.uint32))
        word, arc = (np.concatenate(answers[k]).astype(np.float64) for k in (WORD, PAIR))
        root = (word + ADDED) / (tokens + ADDED * (types + 1))
        ends = word[np.searchsorted(block.names, np.uint64(END))]
        visits = np.append(word, ends)  # of the states; each training text begins once and ends once
        weight = 1 / (1 + BACKOFF_A * visits**BACKOFF_B)
        # along each text: the arc of the state for the token, and the failure arc to the root
        here = visits[block.state]
        through = (1 - weight[block.state]) * arc[block.arc_of] / np.maximum(here, 1)
        total = np.log10(through + weight[block.state] * root[block.stream])
        base = np.log10(root)[block.stream]
        columns = [
            block.ids,
            pa.array(block.held),
            pa.array(block.counts),
            pa.array(np.add.reduceat((word > 0)[block.stream].astype(np.int64), block.firsts)),
            pa.array(np.full(len(block.counts), tokens, np.int64)),
            pa.array(np.add.reduceat(base, block.firsts)),
            pa.array(np.add.reduceat(total, block.firsts)),
        ]
        return pa.table(columns, [c.split()[0] for c in SCORES.split(", ")])

    return score


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """Log10 probabilities of whole texts under a smoothed bigram model of the training documents.

    The model is an automaton: a state for each word (and one for the start), an arc for each word that
    follows it in training, and a failure arc to the root, which has an arc for every token. A text
    is read once from left to right; each token adds the weight of the state's arc, if it has one, mixed
    with the failure arc's weight times the root's:
    (1 - f(v)) c(v, w) / c(v) + f(v) root(w), which sums to 1 over all tokens and the unknown one.
    ``base_score`` is the root alone.

    All words and pairs of all training documents are counted: blocks of documents ask shares of the
    key space for the counts of their distinct words and pairs (64-bit names), so no frequent word
    meets in one task and no model is broadcast.

    Training documents are those whose crc32(doc_id as text) mod 10 is not 0; a null id is one of them.
    Null text is empty: one end token. An empty table gives no rows. Other columns are not read.
    """
    shares = X.shares_for(docs)
    table = X.blocks(docs, _streams, "lm-blocks")
    asked = table.mapInArrow(_requests(shares), X.SCHEMA)
    answers = written(
        asked.groupBy("share", "kind").applyInArrow(_totals, X.SCHEMA + ", tokens long, types long"), "lm-counts"
    )
    known = answers.agg(F.sum("tokens"), F.sum("types")).first()
    both = table.unionByName(answers.drop("tokens", "types"))
    return both.groupBy("block").applyInArrow(_scores(known[0] or 0, known[1] or 0), SCORES)
