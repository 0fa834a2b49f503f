"""Benchmark windows in documents against a plain search."""

import hashlib
import random
import re

import pytest

from trialspark.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items, window=10):
    listed = [(i, WORD.findall(lower(t))) for i, t in items]
    out = []
    for doc, text in docs:
        words = WORD.findall(lower(text))
        hit, own = set(), set()
        for item, ws in listed:
            size = min(window, len(ws))
            wanted = {tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)} if ws else set()
            for k in range(len(words) - size + 1):
                if ws and tuple(words[k : k + size]) in wanted:
                    hit.update(range(k, k + size))
                    if item is not None:
                        own.add(str(item))
        out.append((doc, len(words), sorted(hit), sorted(own)))
    return out


@pytest.fixture
def items_of(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string, spans string").select("item_id", "text", "spans")


def check(got, docs, items):
    rows = [
        (r["doc_id"], r["n_words"], [w for s in r["spans"] for w in range(s["first"], s["last"])], list(r["items"]))
        for r in got
    ]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(rows, key=key) == sorted(plain(docs, items), key=key)


@pytest.mark.parametrize("shard_chars", [decontaminate.SHARD_CHARS, 2000])
def test_equals_plain_search(docs_of, items_of, shard_chars):
    rng = random.Random(5)
    letters = ["a", "B", "c", "ä", "é9", "日本", "x\x1c1"]
    items = [(i, "-".join(rng.choice(letters) for _ in range(rng.choice([1, 4, 9, 10, 11, 25])))) for i in range(12)]
    items += [(3, items[3][1]), (None, "only here without any id at all in ten words ok"), (40, None), (41, ""), (42, " .,; ")]
    docs = []
    for i in range(60):
        own = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            own.append(rng.choice(items)[1] or "")
        own += [rng.choice(letters) for _ in range(rng.randint(0, 9))]
        docs.append((i, rng.choice([" ", "  \n", "--", "?! "]).join(own)))
    docs += [(70, None), (71, ""), (72, docs[3][1]), (72, docs[3][1]), (None, docs[5][1]), (80, "ONLY here, without any ID at all in ten words OK!")]
    got = decontaminate.benchmark_hits(docs_of(docs), items_of([(*r, "clash") for r in items]), shard_chars=shard_chars)
    check(got.collect(), docs, items)


def test_spans_are_places_in_the_text(docs_of, items_of):
    passage = "Über den großen Sylter Deich jagen zwölf Boxkämpfer Viktor quer"
    text = "Ärger 日本 — " + passage.upper().replace("Ü", "Ü") + ". " + "x " * 3 + passage
    got = decontaminate.benchmark_hits(docs_of([(1, text)]), items_of([(7, passage, "")])).first()
    last = got["spans"][-1]
    assert text[last["start"] : last["end"]] == passage
    assert got["items"] == ["7"]


def test_long_and_common_passages(docs_of, items_of):
    passage = " ".join(f"w{i}" for i in range(30))
    filler = " ".join(f"f{i % 977}" for i in range(200_000))
    docs = [(i, passage if i % 2 else "clean") for i in range(300)] + [(1000, f"{filler} {passage} {filler}")]
    got = {r["doc_id"]: r for r in decontaminate.benchmark_hits(docs_of(docs), items_of([(1, passage, ""), (2, passage, "")])).collect()}
    assert len(got) == 301 and [len(got[i]["spans"]) for i in (0, 1, 1000)] == [0, 1, 1]
    assert (got[1000]["spans"][0]["first"], got[1000]["spans"][0]["last"]) == (200_000, 200_030)
    assert got[1]["items"] == ["1", "2"]


def test_empty_tables(docs_of, items_of, empty, hard):
    none = items_of([(1, "a b c", "")]).limit(0)
    assert decontaminate.benchmark_hits(empty, items_of([(1, "one two three", "")])).count() == 0
    got = decontaminate.benchmark_hits(hard, none).collect()
    assert len(got) == hard.count() and not any(r["spans"] or r["items"] for r in got)


def test_query_digests(spark):
    from trialspark.llm.queries import op13_benchmark_decontamination

    sf = "/root/testdata/sf0.001"
    got = {tuple(r) for r in op13_benchmark_decontamination(spark, sf).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {(d, n, len(h), len(i), sha(",".join(i)), bool(h)) for d, n, h, i in plain(docs, items)}
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)
