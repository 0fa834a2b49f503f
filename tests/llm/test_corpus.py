"""Near-duplicates, substrings, search, pages, classifiers and the pipeline."""

import random

import duckdb
import numpy as np
import pytest
from xxhash import xxh64_intdigest

from trialspark.llm import html, neardup, quality, queries, recompress, substrings, topk, toxicity

SF = "/root/testdata/sf0.001"


def test_components_equal_brute_force(docs_of):
    rng = random.Random(3)
    rows, words = [], [f"w{i}" for i in range(400)]
    for i in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([2, 30, 300]))]
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own).upper()))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "w1"), (1003, "w1")]
    got = neardup.near_duplicates(docs_of(rows)).collect()
    fps = {}
    for i, t in rows:
        w = (t or "").lower().split()
        h = [xxh64_intdigest(" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        fps[i] = sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))
    label = {i: i for i in fps}
    for _ in range(len(fps)):
        before = dict(label)
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3:
                    label[a] = min(label[a], label[b])
        if before == label:
            break
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {
        (i, f"{fps[i]:016x}", label[i]) for i in fps
    }
    assert len(neardup.one_of_each(docs_of(rows)).collect()) == len(set(label.values()))


def test_one_row_of_each_component(docs_of, empty):
    x, y, z = ("alpha beta gamma delta " * 5, "one two three four five six", "north south east west up down")
    rows = [(7, x), (7, y), (3, x), (None, y), (None, z), (None, z), (8, z + " "), (9, None), (None, "")]
    got = neardup.one_of_each(docs_of(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(3, x), (7, y), (8, z + " "), (9, None)]
    alone = neardup.one_of_each(docs_of([(None, z), (None, z), (None, y)])).collect()
    assert sorted(r["text"] for r in alone) == sorted([y, z])
    assert got[0].asDict().keys() == docs_of(rows).first().asDict().keys()
    assert neardup.one_of_each(empty).count() == 0


def test_trees_find_every_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 30, np.uint64)
    fps = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) for _ in range(20)]))
    got = {tuple(sorted(p)) for a, b in neardup.Trees(np.zeros(len(fps), int), fps).links() for p in zip(a.tolist(), b.tolist())}
    distance = np.bitwise_count(fps[:, None] ^ fps[None, :])
    i, j = np.nonzero(np.triu(distance <= 3, 1))
    assert got == set(zip(i.tolist(), j.tolist()))


def _plain_cut(rows, window):
    words = [(i if i is not None else -(1 << 63), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window", [5, 50])
def test_repeats_equal_brute_force(docs_of, window):
    rng = random.Random(window)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(window, 3 * window))] for _ in range(6)]
    passages += [["run"] * (2 * window), ["x", "y"] * window]
    rows = []
    for i in range(40):
        own = [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(passages)
        rows.append((i, " ".join(own)))
    rows += [(50, rows[3][1]), (50, rows[3][1]), (51, "\n".join(rows[3][1].split())), (52, None), (None, rows[5][1])]
    got = substrings.repeated_windows(docs_of(rows), window).collect()
    want = _plain_cut(rows, window)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in got) == sorted(
        (i is None, i or 0, n, g) for (i, _), (n, g, _) in zip(rows, want)
    )
    cut = substrings.remove_repeats(docs_of(rows), window).collect()
    kept = sorted((r["doc_id"] or -1, " ".join(r["text"].split()) if r["text"] else "") for r in cut)
    assert kept == sorted((i if i else -1, k.decode()) for (i, _), (_, _, k) in zip(rows, want))


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 5, 120).astype(np.uint64)
    docs = [np.concatenate([rng.integers(0, 5, 70).astype(np.uint64), shared, rng.integers(0, 5, 70).astype(np.uint64)]) for _ in range(4)]
    block = recompress.Block(docs)
    anchors = block.anchors().reshape(4, -1)[:, 70 : 70 + 71]
    assert (anchors == anchors[0]).all()


def test_anchors_do_not_depend_on_a_long_run_elsewhere():
    rng = np.random.default_rng(3)
    run = np.full(80, 7, np.uint64)
    passages = [rng.integers(0, 1 << 62, 3).astype(np.uint64) for _ in range(200)]
    docs = [np.concatenate([run[:47], p]) for p in passages]
    alone = np.concatenate([recompress.Block([d]).anchors() for d in docs])
    beside = recompress.Block([*docs, run]).anchors()
    assert (beside[: len(alone)] == alone).all() and (beside != 0).all()


def test_batches_by_size():
    import pyarrow as pa

    from trialspark.llm.common import slices_by_size

    raw = [b"x" * n for n in (5, 5, 100, 1, 1, 1, 0, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], ["b"])
    parts = [[len(r or b"") for r in p.column("b").to_pylist()] for p in slices_by_size(batch, "b", 10, 4)]
    assert parts == [[5, 5], [100], [1, 1, 1, 0], [0, 0]]


def test_substrings_of_nothing(empty):
    assert substrings.repeated_windows(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, [1.0, 2.0, 0.0, -1.0, 0.5, 0.25]) for i in range(150)]  # a third is one vector
    rows += [(600, None), (601, [float("nan")] * 6), (602, [None] * 6), (603, [float("inf")] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.quantized(frame)
    got = topk.search(vectors, vectors.where("vec_id % 10 = 0"), 10).collect()
    q = {i: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows if i < 600}
    want = []
    for a in q:
        if a % 10 == 0:
            ranked = sorted(((-int(q[a] @ q[b]), b) for b in q if b != a))[:10]
            want += [(a, k + 1, b, -s) for k, (s, b) in enumerate(ranked)]
    assert sorted(map(tuple, got)) == sorted(want)
    few = topk.search(vectors.where("vec_id < 4"), vectors.where("vec_id = 0"), 10).collect()
    assert [r["rank"] for r in sorted(few)] == [1, 2, 3]
    assert topk.search(vectors.limit(0), vectors.limit(0), 10).count() == 0


def test_search_among_repeated_rows_and_clashing_columns(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [rows[0]] * 4 + [rows[7]] * 20 + [(100 + i, rows[0][1]) for i in range(15)] + [(20, [9.0, 9.0, 9.0, 9.0])]
    frame = spark.createDataFrame([(*r, 5, 6.0) for r in rows], "vec_id long, embedding array<float>, class long, score double")
    vectors = topk.quantized(frame)
    got = topk.search(vectors, vectors.where("vec_id % 10 = 0"), 10).collect()
    q = {}
    for i, v in rows:
        own = np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int).tolist()
        q[i] = min(own, q.get(i, own))
    want = []
    for a, u in q.items():
        if a % 10 == 0:
            ranked = sorted((-int(np.dot(u, w)), b) for b, w in q.items() if b != a)[:10]
            want += [(a, k + 1, b, -s) for k, (s, b) in enumerate(ranked)]
    assert sorted(map(tuple, got)) == sorted(want)


PAGE = """<!DOCTYPE html><head><title>no</title><script>if(a<b){"</p>"}</script></head><body class="x">
<nav><ul><li><a href="/">Home</a></ul></nav><header>Site</header><div class="cookie-notice"><p>Cookies</p></div>
<article><header><h1>Head&amp;line</h1></header><p>First <b>bold</b>
 text.<p>Second&nbsp;one<br>line<div class="ad">Buy</div><form><p>Mail</p></form><aside>See also</aside>
<section id="comments"><p>I disagree</p></section></article><footer>&copy; x</footer><!-- c --></body><foot"""


def test_blocks_of_a_page():
    assert [b for b, z in html.blocks_of(PAGE) if z == html.MAIN] == ["Head&line", "First bold text.", "Second one line"]
    assert html.blocks_of("") == [] and html.blocks_of("<p class=menu>x<p>y") == [("y", html.NEUTRAL)]


@pytest.mark.parametrize("name", ["script", "style", "textarea", "title", "noscript"])
def test_raw_elements_end_at_their_own_tag(name):
    for raw in (f"<{name}>for(i=0;i<n;i++)f(i)</{name}>", f"<{name.upper()} x>a<b'</{name[:-1]}></{name}x></{name.upper()}\n>"):
        page = f"<body>{raw}<article><p>Text</article>{raw}<p>after"
        assert html.blocks_of(page) == [("Text", html.MAIN), ("after", html.NEUTRAL)]
    assert html.blocks_of(f"<p>a<{name}>x<n;</p>") == [("a", html.NEUTRAL)]


LEFT_OUT = [  # what stands before, with the text that stays of it
    "<ul><li class='ad'>x<li>y</ul>", "<ul><li class=ad>x<ul><li>z</ul></ul>", "<dl class=ad><dt>x<dd>y</dl>", "<div><nav>x</div>",
    "<table><tr><td class=sidebar>x<td>y</table>", "<table><tr class=ad><td>x<tr><td>y</table>", "<div><p><span class=ad>x</div>",
    "<nav>x", "<form>x", "<aside>x<div>", "<head><meta charset=utf-8>", "<a class=ad>x<div></a></div>", "<svg/>", "<div class=ad><p>x</div>",
]


@pytest.mark.parametrize("before", LEFT_OUT)
def test_left_out_elements_end_before_the_article(before):
    page = f"<html><body><div>{before}<article><p>Long text of the article</article></div>"
    assert [b for b, z in html.blocks_of(page) if z == html.MAIN] == ["Long text of the article"]
    assert not any("x" in b.split() for b, _ in html.blocks_of(page))


def test_omitted_end_tags_keep_what_follows():
    assert html.blocks_of("<ul><li class=ad>x<li>y</ul>z") == [("y", html.NEUTRAL), ("z", html.NEUTRAL)]
    assert html.blocks_of("<table><tr><td class=ad>x<td>y<tr><td>z</table>") == [("y", html.NEUTRAL), ("z", html.NEUTRAL)]
    assert html.blocks_of("<div class=ad><ul><li>x<li>y</ul><div>z</div></div>w") == [("w", html.NEUTRAL)]


@pytest.mark.parametrize("around", ["<div class='content has-sidebar'>", "<div id=no-comments>", "<section class=layout-with-menu>",
                                    "<div class=related-topic>", "<form action=x>", "<table class=widget><tr><td>", "<nav>"])
@pytest.mark.parametrize("name", ["article", "main"])
def test_articles_in_left_out_elements(around, name):
    page = f"<body>{around}<p>x</p><{name}><nav>n</nav><p>Long text of the article<div class=ad>a</div></{name}>"
    assert [b for b, z in html.blocks_of(page) if z == html.MAIN] == ["Long text of the article"]


def test_teasers_and_comments_are_no_articles():
    teaser = "<aside class=related><article>Teaser</article></aside>"
    assert html.blocks_of(f"<article><p>The long text</article>{teaser}") == [("The long text", html.MAIN)]
    assert html.blocks_of(f"<div><p>The long text</div>{teaser}") == [("The long text", html.NEUTRAL)]
    comment = "<article class='comment'><p>I disagree at very great length</article>"
    assert html.blocks_of(f"<article>Short</article><div id=comments>{comment}<article>And I</article></div>") == [("Short", html.MAIN)]
    assert html.blocks_of(f"<article>Short</article><aside>{comment}</aside>") == [("Short", html.MAIN)]
    assert html.blocks_of("<p>a</p><form><h1>All text</h1><nav>n</nav></form>")[1:] == [("All text", html.NEUTRAL)]
    assert html.blocks_of("<p>Some text</p><form>Mail</form>") == [("Some text", html.NEUTRAL)]


def test_pages_without_article_lose_what_a_host_repeats(spark):
    common = "<div><p>Welcome to the one and only site for all things of interest</p></div>"
    rows = [(i, f"http://h.example/{i}", f"{common}<p>Page {i} says {'word%d ' % i * 9}</p>") for i in range(12)]
    rows += [(90, None, PAGE), (91, "http://other.example/", None), (91, "http://other.example/", None), (None, "x", "<p>a")]
    got = html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None and r["page_id"] < 12:
            assert r["text"] == f"Page {r['page_id']} says {' '.join(['word%d' % r['page_id']] * 9)}"
        assert r["n_chars"] == len(r["text"])
    assert {r["text"] for r in got if r["page_id"] == 91} == {""}


@pytest.mark.parametrize("copies", [3, 100])
def test_copies_are_one_page(spark, copies):
    text = "The one text that stands in every copy of this page and nowhere else"
    rows = [(None if i == 2 else i // 2, f"http://a.example/{i}", f"<p>{text}</p>") for i in range(copies)]
    rows += [(i // 2, f"http://b.example/{i}", f"<article><p>{text}</article>") for i in range(copies)]
    rows += [(i, "http://b.example/x", f"<article>Page {i} says {'word%d ' % i * 9}</article>") for i in range(1000, 1007)]
    rows += [(9, f"http://a.example/{i}", f"<h1>{text}</h1>") for i in range(2)]  # the same blocks by other tags
    rows += [(8, f"http://c.example/{i}", f"<{name}><p>{text}") for i, name in enumerate(["div", "article"])]
    got = html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = [(i, u, " ".join(h.split(">")[1].split("<")[0].split()) if "says" in h else text) for i, u, h in rows]
    assert sorted(((r["page_id"] or -1, r["url"], r["text"]) for r in got)) == sorted((i or -1, u, t) for i, u, t in want)
    assert all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize("part", [300, 20_000])
def test_texts_do_not_depend_on_the_parts_of_a_host(spark, monkeypatch, part):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        own = [" ".join(f"w{rng.randrange(3000)}" for _ in range(30)) for _ in range(3)]
        own += [" ".join(f"menu{k}x{j}" for j in range(12)) for k in (2, 10, 22, 300) if rng.randrange(k) == 0]
        rng.shuffle(own)
        kind = "article" if i % 3 == 0 else "div"
        rows.append((i, "http://h.example/", f"<{kind}>" + "".join(f"<p>{t}</p>" for t in own) + f"</{kind}>"))
    rows += [(1000 + i, "http://i.example/", f"<p>page {i} {'own%d ' % i * 20}</p><p>{'a b c d e f g h i j'}</p>") for i in range(12)]
    frame = spark.createDataFrame(rows + rows[:5], "page_id long, url string, html string")
    want = sorted(map(tuple, html.extract_text(frame).collect()))
    assert not any("menu2x" in r[2] for r in want if r[0] % 3 and r[0] < 1000) and any("menu300x" in r[2] for r in want)
    monkeypatch.setattr(html, "PART_CHARS", part)
    assert sorted(map(tuple, html.extract_text(frame).collect())) == want


def test_repeats_are_found_across_pages():
    tokens = np.array([1, 2, 3, 4, 9, 1, 2, 3, 5, 1, 2, 3, 4], np.uint64)
    page = np.array([0] * 5 + [1] * 4 + [2] * 4)
    assert html.repeats(tokens, page, 3).tolist() == [3, 3, 3, 2, 1, 3, 3, 3, 1, 3, 3, 3, 2]


def _labelled(docs_of, spark, hard):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(400):
        toxic, good = i % 5 == 0, i % 7 != 0
        own = [rng.choice(words) for _ in range(60)]
        if toxic:
            for _ in range(4):
                own[rng.randrange(60)] = rng.choice(["vile", "rotten"])
        if not good:
            own = [w.upper() + "!!" for w in own[:10]] * 6
        rows.append((i + 100, " ".join(own)))
        marks.append((i + 100, int(good), int(toxic)))
    marks += [(None, 1, 1), (5, None, None), (7, 2, 3)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    return docs_of(rows).unionByName(hard), labels, {m[0]: m for m in marks if m[0] and m[0] >= 100}


def test_classifiers_hold_on_unseen_documents(docs_of, spark, hard, empty):
    docs, labels, truth = _labelled(docs_of, spark, hard)
    toxic = [r for r in toxicity.score_toxicity(docs, labels).collect()]
    good = [r for r in quality.score_quality(docs, labels).collect()]
    assert len(toxic) == len(good) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in toxic + good)
    unseen = [r for r in toxic if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]][2] for r in unseen]) > 0.9
    unseen = [r for r in good if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["keep"] == (truth[r["doc_id"]][1] == 1) for r in unseen]) > 0.95
    assert toxicity.without_toxic(docs, labels).columns == docs.columns
    kept = toxicity.without_toxic(docs, labels).count()
    assert kept == sum(1 - r["predicted"] for r in toxic)
    assert quality.of_quality(docs, labels).count() == sum(r["keep"] for r in good)
    assert toxicity.score_toxicity(empty, labels).count() == quality.score_quality(empty, labels).count() == 0
    nothing = labels.limit(0)
    assert {r["predicted"] for r in toxicity.score_toxicity(hard, nothing).collect()} == {0}
    assert {r["keep"] for r in quality.score_quality(hard, nothing).collect()} == {True}


def test_a_toxic_pair_of_ordinary_words_is_caught(docs_of, spark):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(1500):
        own = [f"w{rng.randrange(150)}" for _ in range(40)]
        toxic = i % 6 == 0
        places = rng.sample(range(0, 38, 3), 2)
        own[places[0]], own[places[1]] = "green", "lamp"  # both words are in every text
        if toxic:
            own[places[0] + 1] = "lamp"
        rows.append((i, " ".join(own)))
        marks.append((i, 1, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    unseen = [r for r in toxicity.score_toxicity(docs_of(rows), labels).collect() if r["held_out"]]
    caught = [r["predicted"] for r in unseen if r["doc_id"] % 6 == 0]
    clean = [r["predicted"] for r in unseen if r["doc_id"] % 6]
    assert np.mean(caught) > 0.9 and np.mean(clean) < 0.02


def test_class_models_equal_plain_kneser_ney(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 12))), i % 2) for i in range(60)]
    counts = toxicity.count_classes(spark.createDataFrame(texts, "doc_id long, text string, y int"))
    word, pair, before = ({0: {}, 1: {}} for _ in range(3))
    continued = {}
    for _, text, y in texts:
        w = text.split()
        for x in set(w):
            word[y][x] = word[y].get(x, 0) + 1
        for u, v in set(zip(["<s>", *w], w)):
            pair[y][u, v] = pair[y].get((u, v), 0) + 1
            before[y].setdefault(u, set()).add(v)
            continued.setdefault(v, set()).add(u)
    every = sum(map(len, continued.values()))

    def p(y, u, v, d):
        n = sum(word[y].values())
        low = max(word[y].get(v, 0) - d, 0) + sum(min(c, d) for c in word[y].values()) * len(continued[v]) / every
        own = {b: c for (a, b), c in pair[y].items() if a == u}
        if not own:
            return low / n
        return (max(own.get(v, 0) - d, 0) + sum(min(c, d) for c in own.values()) * low / n) / sum(own.values())

    line = "a b c d e f g a a g f".split()
    names, sizes = toxicity._names([" ".join(line)])
    got = counts.ratios(names, toxicity._before(names, sizes))
    for k, d in enumerate(toxicity.DISCOUNTS):
        want = [np.log(p(1, u, v, d) / p(0, u, v, d)) for u, v in zip(["<s>", *line], line)]
        assert np.allclose(got[k], want, atol=1e-5)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_pipeline_over_the_smallest_tables(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        assert 0 < after.count() <= docs.count()
        docs = after
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_chunked_ids_equal_whole_encoding():
    from trialspark.llm import packing
    from trialspark.llm.queries import BPE_JSON, tokenizer_path

    texts = ["", " ", "a", " a", "a ", "a  b", "\n\nx y", "x\n y", "<|endoftext|> z", "don't we'll\tx", "é ü", "a b a b", "日本 語"]
    for border in (True, False):
        encoder = packing.ChunkEncoder(tokenizer_path(BPE_JSON))
        encoder.border = encoder.border if border else None
        for _ in range(2):
            got = [ids.tolist() for ids in encoder.encode(texts)]
            assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("pattern", ["<a ", "x <b ", '<a " ', "<a ' \"", "<!-- ", "<script>", "<a <a \" >", "<", "<a b=\"", "</"])
def test_broken_pages_of_megabytes_take_seconds(pattern):
    import time

    page = pattern * (2_000_000 // len(pattern))
    for text in (page, page + "><p>after"):
        began = time.perf_counter()
        html.blocks_of(text)
        assert time.perf_counter() - began < 10


def test_tags_with_quotes_and_cut_off_ends():
    page = '<p title="a > b">one</p><p class=\'x">y\'>two</p> 1 < 2 <b>bold</b> <a href="cut off'
    text = " ".join(t for t, _ in html.blocks_of(page))
    assert text.split() == "one two 1 < 2 bold".split()
    assert html.blocks_of('<p>x <a href="never closed> y') == [('x <a href="never closed> y', html.NEUTRAL)]
    assert html.blocks_of("<p>kept <!-- gone -- > gone") == [("kept", html.NEUTRAL)]
