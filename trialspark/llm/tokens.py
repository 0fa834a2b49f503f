"""Byte-level BPE over a global table of distinct words."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from trialspark.llm import exchange as X
from trialspark.llm.common import pack, unpack

# a single space between two other characters: no pre-token reaches over it
_BORDER = re.compile(r"(?<=\S) (?=\S)")
_UNEVEN = re.compile(r"\s | \s")


def chunks_of(text: str) -> list[str]:
    """The text cut before single spaces, each space kept with what follows; joined they are the text.

    Pre-tokens hold a space at their start only, so each lies within one chunk, and a chunk falls into
    the same pre-tokens as in the text.
    """
    if not text:
        return []
    if _UNEVEN.search(text) or text[0] == " " or text[-1] == " ":
        first, *rest = _BORDER.split(text)
    else:
        first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def _encoding(ranks_path: str, pattern: str):
    """One for each worker, kept from task to task."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})


@cache
def _token_bytes(ranks_path: str) -> dict[int, bytes]:
    return {v: k for k, v in load_ranks(ranks_path).items()}


def _own_rows(ids: list, texts: list[str]) -> list[tuple]:
    """A block's documents as positions in the block's list of words, which come in order of appearance."""
    known: dict[str, int] = {}
    streams, counts = [], []
    for text in texts:
        chunks = chunks_of(text)
        fresh = [c for c in dict.fromkeys(chunks) if c not in known]
        known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
        streams.append(np.fromiter(map(known.__getitem__, chunks), np.uint32, len(chunks)))
        counts.append(len(chunks))
    stream = np.concatenate(streams) if streams else np.zeros(0, np.uint32)
    return [(X.SELF, 0, X.pack_ids(ids), pack(np.array(counts, np.int64)), X.pack_planes(stream), None)]


def _request(shares: int):
    """The distinct words of a block, each in the row of its share, with its place in the block's list."""

    def build(ids: list, texts: list[str]) -> list[tuple]:
        known: dict[str, None] = {}
        for text in texts:
            known.update(dict.fromkeys(chunks_of(text)))
        out = []
        raw = [c.encode("utf-8", "surrogatepass") for c in known]
        share = np.fromiter((zlib.crc32(c) % shares for c in raw), np.int64, len(raw))
        order = np.argsort(share, kind="stable")
        edges = np.searchsorted(share[order], np.arange(shares + 1)).tolist()
        for s in range(shares):
            own = order[edges[s] : edges[s + 1]]
            if len(own):
                words = [raw[i] for i in own.tolist()]
                sizes = np.fromiter(map(len, words), np.uint32, len(words))
                text = zstandard.ZstdCompressor(level=3).compress(b"".join(words))
                out.append((s, 0, X.pack_planes(np.diff(own, prepend=0).astype(np.uint32)), X.pack_planes(sizes), text, None))
        return out

    return build


def _answer(ranks_path: str, pattern: str):
    def answer(table: pa.Table) -> pa.Table:
        encoding = _encoding(ranks_path, pattern)
        asked, known = [], {}
        for row in table.to_pylist():
            text = zstandard.ZstdDecompressor().decompress(row["c"])
            ends = np.cumsum(X.unpack_planes(row["b"], np.uint32)).tolist()
            words = [text[a:b] for a, b in zip([0, *ends], ends)]
            asked.append((row, words))
            known.update(dict.fromkeys(words))
        for word in known:  # each distinct word once
            known[word] = encoding.encode_ordinary(word.decode("utf-8", "surrogatepass"))
        out = []
        for row, words in asked:
            ids = [known[w] for w in words]
            sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
            flat = np.fromiter((i for own in ids for i in own), np.uint32, int(sizes.sum()))
            out.append((row["block"], row["share"], 0, row["a"], X.pack_planes(sizes), X.pack_planes(flat), None))
        return pa.Table.from_batches([X.rows(out)])

    return answer


def _gathered(table: pa.Table):
    """A block's ids, chunk counts and stream, and the token ids of each of its distinct chunks."""
    own, ids_of = None, {}
    for row in table.to_pylist():
        if row["share"] == X.SELF:
            own = row
            continue
        place = np.cumsum(X.unpack_planes(row["a"], np.uint32)).tolist()
        sizes = X.unpack_planes(row["b"], np.uint32)
        flat, ends = X.unpack_planes(row["c"], np.uint32), np.cumsum(sizes).tolist()
        for p, a, b in zip(place, [0, *ends], ends):
            ids_of[p] = flat[a:b]
    stream = X.unpack_planes(own["c"], np.uint32)
    counts = unpack(own["b"], np.int64)
    return X.unpack_ids(own["a"]), counts, stream, [ids_of[i] for i in range(len(ids_of))]


def _by_document(ranks_path: str, digests: bool):
    def gather(table: pa.Table) -> pa.Table:
        token_bytes = _token_bytes(ranks_path)
        docs, counts, stream, ids = _gathered(table)
        edges = np.cumsum([0, *counts.tolist()]).tolist()
        decoded = [b"".join(map(token_bytes.__getitem__, own.tolist())) for own in ids]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        columns: list = [[], [], []]
        if digests:
            shown = [" ".join(map(str, own.tolist())).encode() for own in ids]
        for a, b in zip(edges, edges[1:]):
            at = stream[a:b].tolist()
            text = b"".join(map(decoded.__getitem__, at))
            if digests:
                columns[0].append(int(sizes[stream[a:b]].sum()))
                columns[1].append(hashlib.sha256(b" ".join(map(shown.__getitem__, at))).hexdigest())
                columns[2].append(hashlib.sha256(text).hexdigest())
            else:
                columns[0].append(sum(map(len, map(ids.__getitem__, at))))
                columns[1].append([int(i) for c in at for i in ids[c]])
                columns[2].append(text)
        if digests:
            names, kinds = ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()]
        else:
            names, kinds = ["n_tokens", "ids", "decoded"], [pa.int64(), pa.list_(pa.int32()), pa.binary()]
        return pa.table([docs, *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", *names])

    return gather


def encode_decode(
    docs: DataFrame, ranks_path: str, pattern: str, digests: bool = False, replayed: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the token ids of each whole text and the bytes they stand for.

    With ``digests`` the last two come as ``ids_sha256`` (decimal ids joined by a space) and
    ``decoded_sha256``, made where the ids are, so that they need not be moved.

    Documents are cut into words with the space before them and kept in blocks as positions in the
    block's own list of words. Each distinct word goes to its share of all words, is encoded there
    once, and its ids return to the blocks that hold it, where texts are put together by position and
    decoded by the table of token bytes (as many entries as the vocabulary).

    ``replayed`` says that ``docs`` is a plain read of files; see :func:`exchange.blocks`.

    Null text is empty: no tokens. An empty table gives no rows; repeated rows and null ids stay; other
    columns are not read. One very long text without white space is one word.
    """
    shares = X.shares_for(docs)
    request = _request(shares)
    if replayed:  # words are asked for in one reading, documents kept in the other: neither does the other's work
        own, asked = X.blocks(docs, _own_rows, "bpe-blocks", True), X.blocks(docs, request, "bpe-words", True)
    else:
        table = X.blocks(docs, lambda ids, texts: _own_rows(ids, texts) + request(ids, texts), "bpe-blocks")
        own, asked = table.where(f"share = {X.SELF}"), table.where("share >= 0")
    answers = asked.groupBy("share").applyInArrow(_answer(ranks_path, pattern), X.SCHEMA)
    schema = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    )
    return own.unionByName(answers).groupBy("block").applyInArrow(_by_document(ranks_path, digests), schema)
