"""Exact top-k inner products by three phases with a uniform threshold."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialspark.llm.common import written

#: Slices of the dimensions; each is a list of partial scores of its own.
LISTS = 2
#: Vectors and queries that meet in one task at a time.
VECTOR_BLOCK, QUERY_BLOCK = 1024, 1024


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of every component; null vectors and those with a null or
    non-finite component are left out, as they take no part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")
    )


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0).cast("long")))
    return F.aggregate(products, F.lit(0).cast("long"), lambda s, x: s + x)


def _scores(own: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """queries x vectors, exact: in doubles where every sum stays below 2^53, else in 64-bit integers."""
    top = max(1, int(np.abs(own).max(initial=0)), int(np.abs(asked).max(initial=0)))
    if top * top * max(1, own.shape[1]) < 1 << 53:
        return (asked.astype(np.float64) @ own.astype(np.float64).T).astype(np.int64)
    return asked @ own.T


def _matrix(rows: pd.Series) -> np.ndarray:
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _cell(own: pd.DataFrame, asked: pd.DataFrame) -> np.ndarray:
    a, b = _matrix(own["part"]), _matrix(asked["part"])
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    return _scores(a, b)


def search(vectors: DataFrame, queries: DataFrame, k: int, lists: int = LISTS) -> DataFrame:
    """The ``k`` vectors of highest integer inner product for each query, ties to the smaller id.

    ``vectors`` and ``queries`` hold ``vec_id, v``; a query never finds the row of its own id. Shorter
    vectors count as padded with zeros. Fewer vectors than ``k``: all of them. No vectors: no rows.
    Equal rows count once, as candidates and as queries. An id has one vector: of rows of one id with
    different vectors the smallest, compared by components, counts. Other columns are not read.

    Equal vectors are one class with its k + 1 smallest ids, which is all that a result can show, so a
    vector that a third of the rows share is scored once. Classes meet the queries in blocks; the
    dimensions are cut into ``lists`` slices, and a slice of a block sees nothing of the others.

    1. Each slice of a block gives its highest partial scores; their classes are scored exactly, and
       the worst of a query's best k + 1 is its cutoff.
    2. A class can only reach the cutoff if one of its partial scores reaches cutoff / lists: each
       slice gives those. The cutoff travels with the query.
    3. Classes whose partial scores and the cutoff share in place of missing ones stay below the
       cutoff are left; of the others the missing parts are computed.
    """
    keep = k + 1
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    members = written(
        vectors.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= keep)
        .select("vec_id", "v", "place", F.first("vec_id").over(by_vector).alias("class")), "topk-members",
    )
    classes = members.where(F.col("place") == 1).select("class", "v")
    asked = written(
        queries.groupBy("vec_id").agg(F.min("v").alias("v")).join(classes, "v").select(F.col("vec_id").alias("query_id"), F.col("class").alias("q")),
        "topk-asked",
    )
    wanted = asked.select("q").distinct().join(classes, F.col("q") == F.col("class")).select("q", F.col("v").alias("w"))
    sizes = classes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    blocks = max(1, -(-sizes["n"] // VECTOR_BLOCK))
    question_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    width = max(1, -(-(sizes["d"] or 1) // lists))

    def sliced(column: str, other: int, axis: str) -> Column:
        cells = F.sequence(F.lit(0), F.lit(other - 1))
        slices = F.sequence(F.lit(0), F.lit(lists - 1))
        return F.explode(
            F.flatten(
                F.transform(slices, lambda s: F.transform(cells, lambda c: F.struct(
                    s.alias("list"), c.alias(axis), F.slice(column, s * width + 1, width).alias("part"))))
            )
        )

    own = classes.select(
        "class", F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int").alias("b"), sliced("v", question_blocks, "c").alias("x")
    ).select("class", "b", F.col("x.c").alias("c"), "x.list", "x.part")

    def ask(questions: DataFrame, *more: str) -> DataFrame:
        return questions.select(
            "q", *more, F.pmod(F.xxhash64("q"), F.lit(question_blocks)).cast("int").alias("c"),
            sliced("w", blocks, "b").alias("x"),
        ).select("q", *more, "c", F.col("x.b").alias("b"), "x.list", "x.part")

    cell = ("list", "b", "c")
    found = "q long, list int, class long, score long"

    def highest(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if own.empty or asked.empty:
            return pd.DataFrame({"q": [], "list": [], "class": [], "score": []}, dtype="int64")
        scores = _cell(own, asked)
        n = min(keep, scores.shape[1])
        at = np.argpartition(-scores, n - 1, axis=1)[:, :n]
        return pd.DataFrame({
            "q": np.repeat(asked["q"].to_numpy(), n), "list": int(own["list"].iloc[0]),
            "class": own["class"].to_numpy()[at].ravel(), "score": np.take_along_axis(scores, at, 1).ravel(),
        })

    def reaching(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if own.empty or asked.empty:
            return pd.DataFrame({"q": [], "list": [], "class": [], "score": []}, dtype="int64")
        scores = _cell(own, asked)
        i, j = np.nonzero(scores >= asked["least"].to_numpy()[:, None])
        return pd.DataFrame({
            "q": asked["q"].to_numpy()[i], "list": int(own["list"].iloc[0]),
            "class": own["class"].to_numpy()[j], "score": scores[i, j],
        })

    def meet(asked_: DataFrame, function) -> DataFrame:
        return own.groupBy(*cell).cogroup(asked_.groupBy(*cell)).applyInPandas(function, found)

    def exact(pairs: DataFrame) -> DataFrame:
        return pairs.join(classes, "class").join(wanted, "q").withColumn("score", _dot(F.col("v"), F.col("w"))).drop("v", "w")

    def best(pairs: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
        ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked.where(F.col("rank") <= n)

    # phase 1
    local = best(meet(ask(wanted), highest), ["q", "list"], [F.desc("score"), F.asc("class")], keep)
    sure = exact(local.select("q", "class").distinct())
    cutoff = best(sure, ["q"], [F.desc("score"), F.asc("class")], keep).groupBy("q").agg(
        F.min("score").alias("low"), F.count("*").alias("n")
    )
    cutoff = cutoff.select("q", F.when(F.col("n") >= keep, F.col("low")).otherwise(F.lit(-(1 << 62))).alias("cutoff"))
    cutoff = written(cutoff, "topk-cutoff")
    # phase 2: the least integer that is not below cutoff / lists
    told = wanted.join(cutoff, "q").withColumn("least", F.expr(f"(cutoff + pmod(-cutoff, {lists})) div {lists}"))
    entries = meet(ask(told, "least"), reaching)
    # phase 3
    gathered = entries.groupBy("q", "class").agg(F.sum("score").alias("part"), F.count("*").alias("seen"))
    possible = gathered.join(told.select("q", "cutoff", "least"), "q").where(
        F.col("part") + (lists - F.col("seen")) * (F.col("least") - 1) >= F.col("cutoff")
    )
    possible = written(possible.select("q", "class", "part", "seen"), "topk-possible")
    known = possible.where(F.col("seen") == lists).select("q", "class", F.col("part").alias("score"))
    rest = exact(possible.where(F.col("seen") < lists).select("q", "class")).select("q", "class", "score")
    chosen = best(known.unionByName(rest), ["q"], [F.desc("score"), F.asc("class")], keep).drop("rank")
    rows = (
        asked.join(chosen, "q")
        .join(members.select("class", "vec_id"), "class")
        .where(F.col("vec_id") != F.col("query_id"))
    )
    ranked = best(rows, ["query_id"], [F.desc("score"), F.asc("vec_id")], k)
    return ranked.select("query_id", "rank", "vec_id", "score")
