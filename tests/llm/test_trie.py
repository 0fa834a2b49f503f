"""The prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from trialspark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def plain(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest()), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c - 20 * int(c / 20)) if c < 0 else c - c % 20
        built[c] = own.get(base, [])[:h] + own[c][h:] if rebuild else own[c]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for node, cs in members.items():
        below = [u for u in members if u[: len(node)] == node]
        children = [u for u in below if len(u) == len(node) + 1]
        parent = min(members[node[:-1]]) if node else None
        leaves = sum(not any(v[:-1] == u for v in members if v) for u in below)
        saved = sum((len(members[u]) - 1) * len((u[-1][1] if u else "").encode().split()) for u in below)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(built[c]) == len(node)))
        out.add((min(cs), len(node), parent, len(cs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out, len(members)


def some_rows(seed):
    rng = random.Random(seed)
    texts = ["hello there", "  how\tare you ", "fine", None, "", "a b c d e"]
    rows = []
    for c in range(-3, 60):
        if c in (20, 21):
            continue
        for k in range(rng.choice([1, 1, 2, 3, 5, 12])):
            rows.append((c, k, rng.choice(["user", "assistant", None]), texts[k % 2] if rng.random() < 0.7 else rng.choice(texts)))
    copies = [(c, k, "user", f"turn {k}") for c in range(100, 140) for k in range(20)]
    odd = [(200, None, "user", "first"), (200, 3, "user", "b"), (200, 3, "user", "a"), (200, 3, "user", "a"), (200, 3, "bot", "z"), (None, 1, "user", "nobody's")]
    longer = [(300, k, "user", f"turn {k}") for k in range(90)]
    return rows + copies + odd + longer


@pytest.mark.parametrize("shard_turns", [trie.SHARD_TURNS, 60])
@pytest.mark.parametrize("rebuild", [True, False])
def test_equals_plain_trie(spark, shard_turns, rebuild):
    rows = some_rows(shard_turns + rebuild)
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    sequences = trie.turn_sequences(table)
    if rebuild:
        sequences = trie.with_shared_starts(sequences)
    got = trie.prefix_trie(sequences, shard_turns).collect()
    want, count = plain(rows, rebuild)
    assert len(got) == count
    assert {tuple(r) for r in got} == want


def test_turnless_and_empty(spark):
    one = spark.createDataFrame([(1, 0, "user", "only", "")], SCHEMA)
    got = trie.prefix_trie(trie.with_shared_starts(trie.turn_sequences(one))).collect()
    assert {tuple(r) for r in got} == plain([(1, 0, "user", "only")])[0]
    assert trie.prefix_trie(trie.with_shared_starts(trie.turn_sequences(one.limit(0)))).count() == 0
    nobody = spark.createDataFrame([(None, 0, "user", "only", "")], SCHEMA)
    assert trie.prefix_trie(trie.turn_sequences(nobody)).count() == 0


def test_one_text_of_many_copies_and_a_very_long_turn(spark):
    rows = [(c, k, "user", "same") for c in range(400) for k in range(3)] + [(999, 0, "user", "w " * 300_000)]
    table = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    got = {r["depth"]: r for r in trie.prefix_trie(trie.turn_sequences(table), 50).collect() if r["conv_id"] == 0}
    assert [got[d]["n_convs"] for d in range(4)] == [401, 400, 400, 400]
    assert got[0]["saved_tokens"] == 3 * 399 and got[0]["n_children"] == 2 and got[0]["n_leaves"] == 2
    ends = ",".join(map(str, range(400)))
    assert got[3]["ends_sha256"] == hashlib.sha256(ends.encode()).hexdigest()
