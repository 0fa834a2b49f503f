"""Helpers shared by the corpus operators: reading, blocks, shared files and packed byte columns."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns; any other column is left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more
    )


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the folder that all executors share, and read back: a new plan without lineage."""
    path = run_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a written step that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def crc32_text(column: str) -> Column:
    """crc32 of an integer written as decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def crc32_fold(ids: np.ndarray, folds: int) -> np.ndarray:
    """The remainder by ``folds`` of the crc32 of each id written as decimal text."""
    return np.fromiter((zlib.crc32(b"%d" % i) % folds for i in ids.tolist()), np.int64, len(ids))


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


def words_of(text: str) -> list[bytes]:
    """The runs of bytes other than space and the five controls from tab to carriage return.

    Latin, accents and every other character stay as they are: ``bytes.split`` knows ASCII white space only.
    """
    return text.encode("utf-8", "surrogatepass").split()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of all given ranges, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """A batch in shorter ones, for work that holds several arrays for each word."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def slices_by_size(batch: pa.RecordBatch, column: str, size: int, rows: int) -> Iterator[pa.RecordBatch]:
    """A batch in shorter ones of at most ``rows`` rows and about ``size`` bytes of a binary column; one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    till = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = int(till[start - 1]) if start else 0
        end = int(np.searchsorted(till, before + size, "right"))
        end = min(max(end, start + 1), start + rows)
        yield batch.slice(start, end - start)
        start = end


def text_blocks(
    batches: Iterator[pa.RecordBatch], chars: int
) -> Iterator[tuple[list[int], list[str], dict[str, list]]]:
    """Documents in blocks of about ``chars`` characters; a longer document is a block of its own.

    Gives the ids, the texts and the other columns of each block.
    """
    ids: list[int] = []
    texts: list[str] = []
    rest: dict[str, list] = {}
    size = 0
    for batch in batches:
        names = [n for n in batch.schema.names if n not in ("doc_id", "text")]
        columns = [batch.column(n) for n in names]
        for i, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
            value = text.as_py()
            if size and size + len(value) > chars:
                yield ids, texts, rest
                ids, texts, rest, size = [], [], {}, 0
            ids.append(doc)
            texts.append(value)
            for name, column in zip(names, columns):
                rest.setdefault(name, []).append(column[i].as_py())
            size += len(value) + 1
    if ids:
        yield ids, texts, rest
