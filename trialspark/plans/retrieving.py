"""Hybrid, vector and full-text retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialspark.functions.text import lexical_overlap, tokens
from trialspark.functions.vectors import cosine, l2
from trialspark.operators import neighbours, retrieval
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables
from trialspark.session import cut_lineage, run_dir

QUERY_TEXT = "the trial of patients and the dose"
# a fixed unit-free query vector, written out for both engines
QUERY_VECTOR = [round(((i * 37) % 64 - 31.5) / 64, 6) for i in range(64)]
_VECTOR_SQL = "[" + ", ".join(str(v) for v in QUERY_VECTOR) + "]::DOUBLE[]"

_TOKENS = "regexp_extract_all(lower(coalesce(chunk_text, '')), '[a-z0-9]+')"


def _lexical_sql(text: str = QUERY_TEXT) -> str:
    words = text.lower().split()
    hits = " + ".join(f"list_contains({_TOKENS}, '{w}')::INT" for w in words)
    return f"(({hits}) / {float(len(words))})"


def _cosine_sql(a: str, b: str) -> str:
    dot = f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"
    size = lambda v: f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"
    return f"CASE WHEN len({a}) = len({b}) THEN coalesce({dot} / nullif({size(a)} * {size(b)}, 0), 0) ELSE 0 END"


def _hybrid_sql(where: str, k: int, wl: float, ws: float, floor: float, semantic: bool = True) -> str:
    scored = _cosine_sql("e", _VECTOR_SQL) if semantic else "0.0"
    scale = lambda c: (
        f"CASE WHEN hi_{c} - lo_{c} <= 1e-9 * greatest(abs(lo_{c}), abs(hi_{c})) "
        f"THEN CASE WHEN hi_{c} = 0 THEN 0.0 ELSE 1.0 END ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END"
    )
    return f"""
    WITH kept AS (SELECT *, embedding::DOUBLE[] AS e FROM document_chunk WHERE {where}),
    scored AS (SELECT document_chunk_id, nct_id, source_content_sha256, {_lexical_sql()} AS lex,
      CASE WHEN e IS NULL THEN 0 ELSE {scored} END AS sem FROM kept),
    bounds AS (SELECT *, min(lex) OVER () AS lo_lex, max(lex) OVER () AS hi_lex, min(sem) OVER () AS lo_sem,
      max(sem) OVER () AS hi_sem FROM scored),
    scaled AS (SELECT *, {scale('lex')} AS ls, {scale('sem')} AS ss FROM bounds),
    mixed AS (SELECT *, ls * {wl} + ss * {ws} AS cs FROM scaled)
    SELECT document_chunk_id, nct_id, source_content_sha256, round(ls, 6) AS lexical_score, round(ss, 6) AS semantic_score,
      round(cs, 6) AS combined_score FROM mixed WHERE cs >= {floor}
    ORDER BY cs DESC, ss DESC, ls DESC, document_chunk_id::VARCHAR LIMIT {k}"""


def _scores(df):
    rounded = [F.round(c, 6).alias(c) for c in ("lexical_score", "semantic_score", "combined_score")]
    return df.select("document_chunk_id", "nct_id", "source_content_sha256", *rounded)


@query("tx14_hybrid_retrieval", _hybrid_sql("country IN ('en', 'de')", 50, 0.35, 0.65, 0.0), "document_chunk")
def hybrid(t: Tables):
    asked = retrieval.HybridQuery(QUERY_TEXT, QUERY_VECTOR, {"country": ["en", "de"]}, top_k=50)
    return _scores(retrieval.hybrid_retrieve(t.document_chunk, asked))


@query("tx14_hybrid_unfiltered", _hybrid_sql("true", 100, 0.75, 0.25, 0.4), "document_chunk")
def hybrid_unfiltered(t: Tables):
    asked = retrieval.HybridQuery(
        QUERY_TEXT, QUERY_VECTOR, top_k=100, lexical_weight=1.5, semantic_weight=0.5, min_combined_score=0.4
    )
    return _scores(retrieval.hybrid_retrieve(t.document_chunk, asked))


@query("tx14_lexical_fallback", _hybrid_sql("country = 'en'", 30, 1.0, 0.0, 0.0, semantic=False), "document_chunk")
def lexical_only(t: Tables):
    asked = retrieval.HybridQuery(QUERY_TEXT, None, {"country": "en"}, top_k=30)
    return _scores(retrieval.hybrid_retrieve(t.document_chunk, asked))


@query(
    "prj13_metadata_predicate",
    """SELECT document_chunk_id FROM document_chunk
       WHERE country IN ('en', 'fr') AND (embedding IS NULL OR document_chunk_id = 3) AND study_phase = 'src7'""",
    "document_chunk",
)
def metadata(t: Tables):
    chunks = t.document_chunk.withColumn("vector_id", F.when(F.col("embedding").isNotNull(), F.col("document_chunk_id")))
    filters = {"country": {"en", "fr"}, "vector_id": [None, 3], "study_phase": "src7", "absent": None}
    return chunks.filter(retrieval.metadata_predicate(chunks, filters)).select("document_chunk_id")


@query(
    "sc08_sc20_tokens_and_overlap",
    f"""SELECT document_chunk_id, len({_TOKENS})::BIGINT AS n_tokens, md5(array_to_string({_TOKENS}, ' ')) AS tokens_md5,
          round({_lexical_sql()}, 6) AS overlap FROM document_chunk""",
    "document_chunk",
)
def token_overlap(t: Tables):
    found = tokens("chunk_text")
    return t.document_chunk.select(
        "document_chunk_id", F.size(found).cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(found, " ")).alias("tokens_md5"),
        F.round(lexical_overlap(QUERY_TEXT, "chunk_text"), 6).alias("overlap"),
    )


@query(
    "sc19_cosine_and_l2",
    f"""SELECT document_chunk_id, round(CASE WHEN e IS NULL THEN 0 ELSE {_cosine_sql('e', _VECTOR_SQL)} END, 6) AS cosine,
          round(sqrt(list_sum(list_transform(list_zip(e, {_VECTOR_SQL}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 6) AS l2
        FROM (SELECT document_chunk_id, embedding::DOUBLE[] AS e FROM document_chunk)""",
    "document_chunk",
)
def similarities(t: Tables):
    return t.document_chunk.select(
        "document_chunk_id", F.round(cosine("embedding", QUERY_VECTOR), 6).alias("cosine"),
        F.round(l2("embedding", QUERY_VECTOR), 6).alias("l2"),
    )


@query(
    "wn01_minmax_normalize",
    """SELECT p_partkey, round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()), 6)
         AS price_norm, round((p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ())::DOUBLE, 6) AS size_norm,
         1.0::DOUBLE AS one_norm, 0.0::DOUBLE AS zero_norm FROM part""",
)
def minmax(t: Tables):
    df = t.part.select(
        "p_partkey", F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("size"),
        F.lit(3.0).alias("one"), F.lit(0.0).alias("zero"),
    )
    names = ["price", "size", "one", "zero"]
    scaled = retrieval.minmax_normalize(df, names)
    return scaled.select("p_partkey", *[F.round(f"{n}_norm", 6).alias(f"{n}_norm") for n in names])


@query(
    "sl01_rank_top_k",
    """SELECT document_chunk_id, combined_score, semantic_score, lexical_score FROM (
         SELECT l_orderkey * 10 + l_linenumber AS document_chunk_id, l_discount AS combined_score, l_tax AS semantic_score,
           l_quantity AS lexical_score, row_number() OVER (ORDER BY l_discount DESC, l_tax DESC, l_quantity DESC,
           (l_orderkey * 10 + l_linenumber)::VARCHAR, l_partkey) AS r FROM lineitem) WHERE r <= 200""",
)
def top_k(t: Tables):
    df = t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("document_chunk_id"),
        F.col("l_discount").alias("combined_score"), F.col("l_tax").alias("semantic_score"),
        F.col("l_quantity").alias("lexical_score"),
    )
    return retrieval.rank_top_k(df, 200)


@query(
    "tx11_exact_knn",
    f"""SELECT vec_id, round(score, 6) AS score FROM (SELECT vec_id, {_cosine_sql('embedding::DOUBLE[]', _VECTOR_SQL)} AS score
        FROM embeddings) ORDER BY round(score, 9) DESC, vec_id LIMIT 25""",
)
def exact_knn(t: Tables):
    return retrieval.knn(t.embeddings, QUERY_VECTOR, 25).withColumn("score", F.round("score", 6))


@query(
    "tx11_exact_knn_l2",
    f"""SELECT vec_id, round(score, 6) AS score FROM (SELECT vec_id, sqrt(list_sum(list_transform(
          list_zip(embedding::DOUBLE[], {_VECTOR_SQL}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
        FROM embeddings) ORDER BY score, vec_id LIMIT 25""",
)
def exact_knn_l2(t: Tables):
    return retrieval.knn(t.embeddings, QUERY_VECTOR, 25, metric="l2").withColumn("score", F.round("score", 6))


@query(
    "tx11_batch_knn",
    f"""WITH scored AS (SELECT q.vec_id AS query_id, v.vec_id, {_cosine_sql('v.embedding::DOUBLE[]', 'q.embedding::DOUBLE[]')} AS score
          FROM embeddings v, embeddings q WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM scored)
        SELECT query_id, vec_id, round(score, 6) AS score, rank FROM ranked WHERE rank <= 10""",
)
def batch_knn(t: Tables):
    found = neighbours.exact_neighbours(t.embeddings, t.embeddings.filter("vec_id % 50 = 0"), 10)
    return found.select("query_id", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


# whole numbers by a rule, so that both engines have the same cells; fitted ones are in tx12_recall
CENTRES = [[(c * 31 + j * 17 + c * j * 7) % 23 - 11 for j in range(64)] for c in range(16)]
PROBES, SURVIVORS = 14, 20
_CENTRES_SQL = "[" + ", ".join(str(c) for c in CENTRES) + "]"
_DOT = "list_sum(list_transform(list_zip({}, {}), lambda p: p[1] * p[2]))"


@query(
    "tx12_approximate_knn",
    f"""WITH u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS v
          FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)),
        coded AS (SELECT vec_id, v, list_transform(v, lambda x: least(greatest(floor(x * 128 + 0.5)::BIGINT, -127), 127)) AS code FROM u),
        centre AS (SELECT unnest(range(16)) AS cell, unnest({_CENTRES_SQL}) AS w),
        near AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY {_DOT.format('code', 'w')} DESC, cell) AS n
          FROM coded, centre),
        met AS (SELECT q.vec_id AS query_id, i.vec_id FROM near q JOIN near i ON q.cell = i.cell AND i.n = 1 AND q.n <= {PROBES}
          WHERE q.vec_id % 50 = 0 AND i.vec_id <> q.vec_id),
        kept AS (SELECT query_id, x.vec_id, x.v AS a, y.v AS b FROM met JOIN coded x ON x.vec_id = met.vec_id JOIN coded y ON y.vec_id = query_id
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY {_DOT.format('x.code', 'y.code')} DESC, x.vec_id) <= {SURVIVORS}),
        scored AS (SELECT query_id, vec_id, {_DOT.format('a', 'b')} AS score FROM kept)
        SELECT query_id, vec_id, round(score, 6) AS score,
          row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM scored QUALIFY rank <= 10""",
)
def approximate_knn(t: Tables):
    """Ten neighbours of every fiftieth vector through 16 cells."""
    index = neighbours.cell_index(t.embeddings, CENTRES)
    found = neighbours.approximate_neighbours(
        index, t.embeddings, t.embeddings.filter("vec_id % 50 = 0"), CENTRES, 10, PROBES, SURVIVORS
    )
    return found.select("query_id", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query(
    "tx12_recall",
    """SELECT count(*) FILTER (WHERE vec_id % 50 = 0) AS queries, count(*) AS vectors, true AS recall_90, true AS vectors_met_under_10_percent
       FROM embeddings""",
)
def approximate_recall(t: Tables):
    """With fitted cells and chosen probes: recall of 0.9, and full vectors compared with under a tenth of all."""
    vectors, asked = t.embeddings, t.embeddings.filter("vec_id % 50 = 0")
    centres = neighbours.fit_cells(vectors, 16)
    index = cut_lineage(neighbours.cell_index(vectors, centres))
    _, recall = neighbours.choose_probes(index, vectors, asked, centres, 10, SURVIVORS)
    counts = vectors.agg(F.count_if(F.col("vec_id") % 50 == 0).alias("queries"), F.count("*").alias("vectors"))
    return counts.select(
        "queries", "vectors", F.lit(recall >= 0.9).alias("recall_90"),
        (F.lit(SURVIVORS) < F.col("vectors") / 10).alias("vectors_met_under_10_percent"),
    )


@query(
    "tx13_inverted_index",
    r"""SELECT token, count(*) AS texts, sum(n)::BIGINT AS occurrences FROM (SELECT doc_id, token, count(*) AS n FROM (
         SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')) AS token FROM documents) GROUP BY ALL) GROUP BY 1""",
)
def inverted_index(t: Tables):
    index = retrieval.build_inverted_index(t.documents, "doc_id", "text")
    return index.groupBy("token").agg(F.count("*").alias("texts"), F.sum("occurrences").alias("occurrences"))


@query(
    "tx13_full_text_match",
    r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')) AS token FROM documents)
       SELECT doc_id, count(*) AS occurrences FROM w WHERE token IN ('the', 'and', 'to') GROUP BY 1
       HAVING count(DISTINCT token) = 3""",
)
def full_text(t: Tables):
    """Against an index that is stored by token bucket."""
    path = retrieval.write_inverted_index(retrieval.build_inverted_index(t.documents, "doc_id", "text"), run_dir(t.spark, "index"))
    return retrieval.search_index(t.spark.read.parquet(path), "The AND to", "doc_id")
