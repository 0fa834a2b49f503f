"""Batch text embedding with a pluggable encoder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.operators.textjobs import combined_text

Encoder = Callable[[list[str]], np.ndarray]


def embed_with(
    df: DataFrame, id_col: str, text_col: str, load: Callable[[], Encoder], batch_size: int = 32, keep_failures: bool = False
) -> DataFrame:
    """(id, embedding) from an encoder that is loaded once per task and fed in batches.

    Vectors are handed on batch by batch, so a task holds those of one batch.

    With ``keep_failures`` a text that the encoder stops at has a null embedding and its message in
    ``error``, and the others of its batch are encoded one by one; without, the job stops.
    """
    id_type = dict(df.dtypes)[id_col]
    columns = [id_col, "embedding", *(["error"] if keep_failures else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load()

        def vectors_of(texts: list[str]) -> list[list[float]]:
            return np.asarray(encode(texts), dtype=np.float32).tolist()

        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                ids, texts = (c.slice(at, batch_size) for c in (batch.column(id_col), batch.column("t")))
                part, vectors, errors = texts.to_pylist(), [], []
                try:
                    vectors.extend(vectors_of(part))
                    errors.extend([None] * len(part))
                except Exception:
                    if not keep_failures:
                        raise
                    for text in part:
                        try:
                            vectors.extend(vectors_of([text]))
                            errors.append(None)
                        except Exception as error:
                            vectors.append(None)
                            errors.append(str(error) or type(error).__name__)
                made = [ids, pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(made[: len(columns)], columns)

    schema = f"`{id_col}` {id_type}, embedding array<float>" + (", error string" if keep_failures else "")
    return df.select(id_col, F.col(text_col).alias("t")).mapInArrow(run, schema)


_WORD = re.compile(r"[^\W_]+")


def hashing_encoder(dim: int) -> Encoder:
    """Counts of words by the first 32 bits of their md5 modulo ``dim``, scaled to unit length."""
    places: dict[str, int] = {}

    def place(word: str) -> int:
        if word not in places:
            if len(places) > 1_000_000:
                places.clear()
            places[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim
        return places[word]

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for row, text in zip(out, texts):
            at = [place(w) for w in _WORD.findall(text.lower())]
            row += np.bincount(at, minlength=dim) if at else 0
        return out / np.maximum(np.linalg.norm(out, axis=1), 1)[:, None]

    return encode


def generate_embeddings(
    df: DataFrame,
    id_col: str = "nct_id",
    text_cols: Iterable[str] = ("title", "brief_summary"),
    summary_limit: int | None = None,
    load: Callable[[], Encoder] | None = None,
    batch_size: int = 32,
    dim: int = 384,
    keep_failures: bool = False,
) -> DataFrame:
    """Embeddings of the combined text columns; rows without text have none.

    ``summary_limit`` cuts the summary to that many characters; by default whole texts are read. Without
    ``load`` words are hashed, which needs no model. ``keep_failures`` as in :func:`embed_with`.
    """
    limits = {} if summary_limit is None else {"brief_summary": summary_limit}
    texts = combined_text(df, text_cols, limits, drop_blank=True)
    return embed_with(texts, id_col, "combined_text", load or (lambda: hashing_encoder(dim)), batch_size, keep_failures)


def embedding_statistics(embeddings: DataFrame) -> DataFrame:
    """Number and size of the embeddings, and why there are none or what failed (the first message in text order)."""
    failed = F.min("error") if "error" in embeddings.columns else F.lit(None).cast("string")
    made = F.count("embedding")
    return embeddings.agg(
        made.alias("total_embeddings"),
        F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("embedding_dimension"),
        F.coalesce(failed, F.when(made == 0, F.lit("No texts to embed"))).alias("error"),
    )
