"""Periodic runs against trying every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from trialspark.llm import runs


def plain(words):
    """All runs by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        start = 0
        for i in range(n - q + 1):
            if i == n - q or words[i] != words[i + q]:
                length = i - start + q
                if i > start and length >= max(24, 3 * q):
                    found.setdefault((start, start + length), q)
                start = i + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def some_words(rng):
    """Words with runs of all kinds of periods, nested and overlapping ones too."""
    out = []
    alphabet = rng.choice(["ab", "abc", "abcdefghijklmnop"])
    for _ in range(rng.randint(1, 6)):
        kind = rng.random()
        if kind < 0.3:
            out += [rng.choice(alphabet) for _ in range(rng.randint(0, 60))]
        else:
            unit = [rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 15, 16, 17, 20, 31, 33, 50]))]
            if kind < 0.6:  # units that hold runs themselves
                inner = [rng.choice(alphabet) for _ in range(rng.choice([1, 2, 3, 5]))]
                unit = inner * rng.randint(2, 16) + unit
            whole = unit * rng.randint(2, 8)
            out += whole[rng.randint(0, len(unit)) : len(whole) - rng.randint(0, len(unit))]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_every_period(seed):
    rng = random.Random(seed)
    docs = [some_words(rng) for _ in range(150)]
    codes = np.array([ord(w) for d in docs for w in d], np.int64)
    got = runs.runs_in(codes, np.array([len(d) for d in docs], np.int64))
    found = [[] for _ in docs]
    for d, a, n, q in zip(*(x.tolist() for x in got)):
        found[d].append((a, n, q))
    for words, own in zip(docs, found):
        assert own == plain(words), " ".join(words)


def test_wavelet_successor():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        tree = runs.Wavelet(values)
        left = rng.integers(0, n, 300)
        right = np.minimum(n, left + rng.integers(0, n + 1, 300))
        x = rng.integers(-1, n, 300)
        want = [min((v for v in values[a:b] if v > y), default=runs.NONE) for a, b, y in zip(left, right, x)]
        assert tree.after(left, right, x).tolist() == want


def test_documents(docs_of, hard, empty):
    rng = random.Random(11)
    rows = [(i, "  ".join(some_words(rng))) for i in range(40)]
    rows += [(100, " ".join(["w"] * 300_000)), (101, " ".join(f"u{i}" for i in range(100_000)) + " x y" * 12)]
    got = {r["doc_id"]: r for r in runs.periodic_runs(docs_of(rows)).collect()}
    for doc, text in rows[:40]:
        words = text.split()
        want = plain(words)
        assert [tuple(r) for r in got[doc]["runs"]] == want
        assert (got[doc]["collapsed"] if want else None) == (" ".join(collapsed(words, want)) if want else None)
    assert [tuple(r) for r in got[100]["runs"]] == [(0, 300_000, 1)] and got[100]["collapsed"] == "w"
    assert [tuple(r) for r in got[101]["runs"]] == [(100_000, 24, 2)]
    assert runs.periodic_runs(empty).count() == 0
    odd = runs.periodic_runs(hard).collect()
    assert len(odd) == hard.count()
    assert [[tuple(x) for x in r["runs"]] for r in odd if r["doc_id"] == 9] == [[(0, 800, 2)]] * 2
    assert next(r for r in odd if r["doc_id"] is None)["n_words"] == 5


def plain_query(docs):
    out = set()
    for doc, text in docs:
        words = (text or "").encode().split()
        n = len(words)
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = plain(words)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        out.add((
            doc, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha(b"".join(b"%d,%d,%d\n" % r for r in found)), sha(b" ".join(collapsed(words, found))),
        ))
    return out


def test_query_equals_every_period(spark, monkeypatch, docs_of):
    from trialspark.llm import queries

    rng = random.Random(4)
    rows = [(i, " \t".join(some_words(rng) if i % 3 else [f"w{k}" for k in range(rng.randint(0, 90))])) for i in range(150)]
    rows += [(200, None), (210, ""), (None, " ".join("ab" * 20))]
    monkeypatch.setattr(queries, "table", lambda *_: docs_of(rows))
    got = {tuple(r) for r in queries.op12_periodic_runs(spark, "").collect()}
    assert got == plain_query(rows)
    assert sum(r[1] > 0 for r in got) > 30


def test_query_on_small_tables(spark):
    from trialspark.llm.queries import op12_periodic_runs

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs if len((d[1] or "").split()) < 1500]
    got = {tuple(r) for r in op12_periodic_runs(spark, sf).collect()}
    assert plain_query(docs) <= got
