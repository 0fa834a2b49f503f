"""Packing, fingerprints, encoding and scores against plain versions."""

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import HARD
from tokenizers import Tokenizer

from trialspark.llm import fingerprints, lm, packing, tokens
from trialspark.llm.queries import BPE_JSON, BPE_RANKS

JSON, RANKS = public_tokenizers.path(BPE_JSON), public_tokenizers.path(BPE_RANKS)


def test_pieces_hold_the_tokenizers_ids(hard):
    tokenizer = Tokenizer.from_file(JSON)
    got = defaultdict(list)
    for r in packing.token_pieces(hard, JSON, 64).collect():
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for doc, text in HARD:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 64 or 64
        edges = [0, *range(first, len(ids) + 1, 64)]
        want = [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
        copies = sum(1 for d, _ in HARD if d == doc)
        assert sorted(got[doc]) == sorted(want * copies)


@pytest.mark.parametrize("seed", [0, 1])
def test_packing_fills_without_gaps(spark, seed):
    sizes = np.random.default_rng(seed).integers(1, 101, 600)
    sizes[:200] = 37  # a third of all pieces ties
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(sizes)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    placed = packing.pack_pieces(pieces, 100).collect()
    assert sorted(r["doc_id"] for r in placed) == list(range(600))
    sequences = defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 100
    decreasing = []  # best-fit decreasing
    for n in sorted(sizes, reverse=True):
        fit = [i for i, room in enumerate(decreasing) if room >= n]
        if fit:
            decreasing[min(fit, key=lambda i: decreasing[i])] -= n
        else:
            decreasing.append(100 - n)
    assert len(sequences) <= 1.05 * len(decreasing) + 2


def test_packing_of_nothing(empty):
    assert packing.pack_documents(empty, JSON).count() == 0


def test_bpe_equals_the_library_and_decodes(hard):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = tokens.encode_decode(hard, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(HARD)
    texts = dict(HARD)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text)
        assert (r["n_tokens"], bytes(r["decoded"])) == (len(r["ids"]), text.encode())
    digests = tokens.encode_decode(hard, RANKS, public_tokenizers.PATTERN, digests=True, replayed=True).collect()
    want = {
        r["doc_id"]: hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() for r in got
    }
    assert all(r["ids_sha256"] == want[r["doc_id"]] for r in digests)


def test_bpe_of_nothing(empty):
    assert tokens.encode_decode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a  b", " a", "a ", "a \n b", "x\n\n  y z", "a  b c", "\x1c a b"])
def test_chunks_join_to_the_text(text):
    chunks = tokens.chunks_of(text)
    assert "".join(chunks) == text
    whole = Tokenizer.from_file(JSON)
    assert [i for c in chunks for i in whole.encode(c).ids] == whole.encode(text).ids


def _plain_scores(rows):
    sequences = {i: [*tokens_of(t), None] for i, t in rows}
    train = [i for i, _ in rows if i is None or zlib.crc32(b"%d" % i) % 10]
    words, pairs = Counter(), Counter()
    for i in train:
        words.update(sequences[i])
        pairs.update(zip(["<start>", *sequences[i]], sequences[i]))
    total, types = sum(words.values()), len(words)
    out = {}
    for i, own in sequences.items():
        base = score = 0.0
        for before, word in zip(["<start>", *own], own):
            root = (words[word] + 0.1) / (total + 0.1 * (types + 1))
            visits = words[None] if before == "<start>" else words[before]
            fall = 1 / (1 + lm.BACKOFF_A * visits**lm.BACKOFF_B)
            base += math.log10(root)
            score += math.log10((1 - fall) * pairs[before, word] / max(1, visits) + fall * root)
        out[i] = (len(own), sum(words[w] > 0 for w in own), total, base, score)
    return out


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return lower.encode().split()


def test_scores_equal_a_plain_model(docs_of):
    rows = list({i: t for i, t in HARD}.items()) + [(20 + i, "the cat sat on the mat " * (1 + i % 3)) for i in range(30)]
    want = _plain_scores(rows)
    got = lm.score_documents(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)


def test_scores_of_nothing(empty):
    assert lm.score_documents(empty).count() == 0


def test_fingerprints_of_edits(docs_of):
    rows = [(1, "alpha beta.\ngamma delta"), (2, None), (5, "gamma delta\nalpha beta."), (9, "x" * 99), (None, "first")]
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs_of(rows), 3).collect()}
    order = [(None, "first"), (1, rows[0][1]), (2, ""), (5, rows[2][1]), (9, rows[3][1])]
    for (doc, text), (_, following) in zip(order, [*order[1:], order[0]]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc]["n_chars"] == len(text)
        assert 0 <= got[doc]["near_edited"] <= 1 and 0 <= got[doc]["near_next"] <= 1
    # the order of paragraphs has no influence, their content has
    assert got[1]["fingerprint"] == got[5]["fingerprint"] != got[9]["fingerprint"]


def test_fingerprints_of_repeated_rows_and_nothing(docs_of, empty):
    same = docs_of([(1, "a b\nc"), (1, "a b\nc"), (2, "a b\nc")])
    got = fingerprints.fingerprint_edits(same).collect()
    assert len(got) == 3 and len({r["fingerprint"] for r in got}) == 1
    assert all(r["near_next"] == 1.0 for r in got)
    assert fingerprints.fingerprint_edits(empty).count() == 0


def test_fingerprints_run_no_python(docs_of):
    plan = fingerprints.fingerprint_edits(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
