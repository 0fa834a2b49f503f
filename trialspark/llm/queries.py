"""One query for each operator over whole tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.llm.common import table

BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BPE_JSON))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.topk import quantized, search

    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.fingerprints import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from trialspark.llm.tokens import encode_decode

    docs = table(spark, sf_dir, "documents")
    return encode_decode(docs, tokenizer_path(BPE_RANKS), public_tokenizers.PATTERN, digests=True, replayed=True)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.substrings import repeated_windows

    cut = repeated_windows(table(spark, sf_dir, "documents"))
    kept = F.when(F.col("n_removed") == 0, F.col("words_sha256")).otherwise(F.sha2(F.col("kept").cast("binary"), 256))
    return cut.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.html import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.lm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def op10_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.trie import prefix_trie, turn_sequences, with_shared_starts

    return prefix_trie(with_shared_starts(turn_sequences(table(spark, sf_dir, "conversations"))))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.runs import periodic_runs, strongest, with_periods

    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    best = F.when(F.size("runs") > 0, strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.coalesce(F.sha2(F.col("collapsed").cast("binary"), 256), "words_sha256").alias("collapsed_sha256"),
    )


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trialspark.llm.decontaminate import benchmark_hits

    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]))
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing,
        op2_exact_top_k,
        op3_document_fingerprints,
        op4_toxicity,
        op5_byte_bpe,
        op6_quality_classifier,
        op7_substring_dedup,
        op8_html_extraction,
        op9_lm_scoring,
        op10_simhash_near_duplicates,
        op11_conversation_trie,
        op12_periodic_runs,
        op13_benchmark_decontamination,
    )
}
ORACLES: dict[str, str] = {
    "op11_conversation_trie": r"""
        WITH RECURSIVE t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
          SELECT conv_id, list(md5(concat(strlen(role), ':', role, text)) ORDER BY turn NULLS FIRST, role, md5(text)) AS ids,
            list(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) ORDER BY turn NULLS FIRST, role, md5(text)) AS ws
          FROM t GROUP BY conv_id
        ), crc(conv_id, digits, k, c) AS (
          SELECT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM own
          UNION ALL
          SELECT conv_id, digits, k + 1, xor(c2 >> 1, (c2 & 1) * 3988292384) FROM (
            SELECT conv_id, digits, k, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(digits[k // 8 + 1]) AS BIGINT)) ELSE c END AS c2
            FROM crc WHERE k < 8 * length(digits))
        ), h AS (
          SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 4 AS h FROM crc WHERE k = 8 * length(digits)
        ), s AS (
          SELECT o.conv_id, list_concat(coalesce(b.ids[1:h], []), o.ids[h + 1:]) AS ids, list_concat(coalesce(b.ws[1:h], []), o.ws[h + 1:]) AS ws
          FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
        ), m AS (
          SELECT conv_id, len(ids) AS n, d, array_to_string(ids[1:d], '') AS key, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w
          FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM s)
        ), node AS (
          SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
          FROM m GROUP BY d, key
        ), kids AS (
          SELECT d - 1 AS d, left(key, 32 * (d - 1)) AS key, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2
        ), up AS (
          SELECT a AS d, left(key, 32 * a) AS key, sum((n_convs - 1) * w) AS saved, sum(leaf) AS n_leaves
          FROM (SELECT node.key, n_convs, w, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(node.d + 1)) AS a
                FROM node LEFT JOIN kids ON node.d = kids.d AND node.key = kids.key)
          GROUP BY 1, 2
        )
        SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs,
          CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, v.ends_sha256
        FROM node v JOIN up ON v.d = up.d AND v.key = up.key LEFT JOIN kids ON v.d = kids.d AND v.key = kids.key
          LEFT JOIN node p ON p.d = v.d - 1 AND p.key = left(v.key, 32 * (v.d - 1))
    """,
    "op13_benchmark_decontamination": r"""
        WITH b AS (
          SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
        ), bw AS (
          SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[p:p + least(10, len(ws)) - 1], ' ') AS t
          FROM (SELECT item, ws, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS p FROM b WHERE len(ws) > 0)
        ), d AS (
          SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
        ), sizes AS (SELECT DISTINCT n FROM bw),
        dw AS (
          SELECT r, n, p, array_to_string(ws[p:p + n - 1], ' ') AS t
          FROM (SELECT r, n, ws, unnest(generate_series(1, len(ws) - n + 1)) AS p FROM d JOIN sizes ON len(ws) >= n)
        ), hits AS (SELECT r, p, dw.n AS n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t),
        words AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS w FROM hits) GROUP BY r),
        items AS (
          SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
          CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """,
    "op7_substring_dedup": r"""
        WITH w AS (
          SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
        ), s AS (
          SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS t
          FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS p FROM w WHERE len(ws) >= 50)
        ), f AS (SELECT t, min(doc_id) AS first FROM s GROUP BY t HAVING count(DISTINCT doc_id) > 1),
        c AS (
          SELECT doc_id, list_sort(list(p)) AS ps FROM s JOIN f USING (t) WHERE doc_id > first GROUP BY doc_id
        ), r AS (
          SELECT doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 50)))) AS gone FROM c
        )
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
          sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
            ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
        FROM w LEFT JOIN r USING (doc_id)
    """,
    "op2_exact_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10
    """,
}
