"""Token features, weights, chunks, clauses, concepts and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialspark.functions.text import STOP_WORDS
from trialspark.operators import embed, textjobs
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_WORDS = f"""w AS (SELECT doc_id, i AS pos, token FROM (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS i
  FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}]+'),
    lambda x: regexp_full_match(x, '[\\p{{L}}\\p{{M}}]+') AND x NOT IN ({_STOP})) AS t FROM documents)))"""


@query(
    "tx01_token_features",
    f"""WITH {_WORDS}, f AS (SELECT doc_id, count(*) AS n, count(DISTINCT token) AS u FROM w GROUP BY 1)
        SELECT d.doc_id, coalesce(n, 0) AS token_count, coalesce(u, 0) AS unique_tokens,
          round(coalesce(u / n, 0.0), 6) AS lexical_diversity FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id""",
)
def features(t: Tables):
    found = textjobs.token_features(t.documents, "doc_id", "text")
    return found.withColumn("lexical_diversity", F.round("lexical_diversity", 6))


@query(
    "wn06_top_words",
    f"""WITH {_WORDS}, c AS (SELECT doc_id, token AS word, count(*) AS freq, min(pos) AS p FROM w GROUP BY 1, 2)
        SELECT doc_id, word, freq, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY freq DESC, p) AS rank FROM c)
        WHERE rank <= 10""",
)
def top_words(t: Tables):
    return textjobs.top_words(t.documents, "doc_id", "text").withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "tx02_top_words_map",
    f"""WITH {_WORDS}, c AS (SELECT doc_id, token AS word, count(*) AS freq, min(pos) AS p FROM w GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY freq DESC, p) AS rank FROM c),
        m AS (SELECT doc_id, string_agg(concat(word, '=', freq), ' ' ORDER BY word) AS words, count(*) AS n FROM r WHERE rank <= 10 GROUP BY 1)
        SELECT d.doc_id, coalesce(words, '') AS words, coalesce(n, 0) AS n FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id""",
)
def top_words_map(t: Tables):
    found = textjobs.top_words_map(t.documents, "doc_id", "text")
    pairs = F.transform(
        F.array_sort(F.map_entries("top_words")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return found.select("doc_id", F.array_join(pairs, " ").alias("words"), F.size("top_words").cast("bigint").alias("n"))


@query(
    "ag03_feature_summary",
    f"""WITH {_WORDS}, f AS (SELECT doc_id, count(*) AS n, count(DISTINCT token) AS u FROM w GROUP BY 1)
        SELECT count(*) AS total_processed, round(avg(coalesce(n, 0)), 6) AS avg_token_count,
          round(avg(coalesce(u / n, 0.0)), 6) AS avg_lexical_diversity, sum(length(text) % 7)::BIGINT AS total_entities
        FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id""",
)
def feature_summary(t: Tables):
    entities = t.documents.select("doc_id", (F.length("text") % 7).cast("bigint").alias("entity_count"))
    found = textjobs.token_features(t.documents, "doc_id", "text").join(entities, "doc_id")
    rounded = {c: F.round(c, 6) for c in ("avg_token_count", "avg_lexical_diversity")}
    return textjobs.feature_summary(found).withColumns(rounded)


@query(
    "ag04_shard_outcomes",
    """WITH s AS (SELECT concat('0x', substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 256 AS shard, length(text) < 20 AS bad FROM documents),
       p AS (SELECT shard, bool_or(bad) AS f, count(*) AS n, count(*) FILTER (bad) AS b FROM s GROUP BY 1)
       SELECT CASE WHEN f THEN 'failed' ELSE 'succeeded' END AS status, count(*) AS shards, sum(n)::BIGINT AS rows,
         sum(b)::BIGINT AS failed_rows FROM p GROUP BY 1""",
)
def shard_outcomes(t: Tables):
    from trialspark.sources.writers import with_shard

    rows = t.documents.select(F.col("doc_id").cast("string").alias("key"), (F.length("text") < 20).alias("bad"))
    return textjobs.shard_outcomes(with_shard(rows, "key"), "shard_id", "bad")


@query(
    "so04_concatenate_features",
    """SELECT doc_id, n_chars AS size, 'long' AS kind FROM documents WHERE n_chars >= 1000
       UNION ALL SELECT doc_id, n_chars, 'short' FROM documents WHERE n_chars < 1000""",
)
def concatenate(t: Tables):
    part = lambda where, kind: t.documents.filter(where).select(F.lit(kind).alias("kind"), "doc_id", F.col("n_chars").alias("size"))
    frames = [part("n_chars >= 1000", "long"), part("n_chars < 1000", "short")]
    return textjobs.concat_features(*frames, spark=t.spark, schema="doc_id bigint, size bigint, kind string")


@query(
    "sc09_sc10_combined_text",
    """SELECT doc_id, md5(c) AS text_md5, length(c)::BIGINT AS size FROM (SELECT doc_id,
         concat(CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END, ' ', CASE WHEN doc_id % 9 = 0 THEN '' ELSE substr(text, 1, 500) END) AS c
         FROM documents) WHERE trim(c) <> ''""",
)
def combined(t: Tables):
    df = t.documents.select(
        "doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("title"),
        F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("brief_summary"),
    )
    found = textjobs.combined_text(df, ["title", "brief_summary"], {"brief_summary": 500})
    return found.select("doc_id", F.md5("combined_text").alias("text_md5"), F.length("combined_text").cast("bigint").alias("size"))


@query(
    "tx04_clean_text_and_stop_words",
    f"""WITH c AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^<>]*>', ' ', 'g'), '[\\x00-\\x20\\x7F]+', ' ', 'g')) AS t FROM pages)
        SELECT page_id, md5(t) AS clean_md5, array_to_string(list_filter(regexp_extract_all(lower(t), '[\\p{{L}}\\p{{M}}\\p{{N}}]+'),
          lambda x: regexp_full_match(x, '[\\p{{L}}\\p{{M}}]+') AND x NOT IN ({_STOP})), ' ') AS words FROM c""",
)
def clean(t: Tables):
    found = textjobs.cleaned_words(t.pages, "page_id", "html")
    return found.select("page_id", F.md5("clean_text").alias("clean_md5"), F.array_join("words", " ").alias("words"))


@query(
    "tx05_tfidf",
    f"""WITH {_WORDS}, c AS (SELECT doc_id, token AS term, count(*) AS tf FROM w GROUP BY 1, 2),
        f AS (SELECT term, count(*) AS df FROM c GROUP BY 1)
        SELECT doc_id, c.term, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tfidf
        FROM c JOIN f ON c.term = f.term""",
)
def tfidf(t: Tables):
    return textjobs.tfidf(t.documents, "doc_id", "text").withColumn("tfidf", F.round("tfidf", 6))


@query(
    "tx06_trigrams",
    r"""WITH t AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents),
       g AS (SELECT unnest(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) AS trigram FROM t WHERE len(w) >= 3)
       SELECT trigram, count(*) AS occurrences FROM g GROUP BY 1""",
)
def trigrams(t: Tables):
    return textjobs.trigram_counts(t.documents, "text")


def _chunk_sql(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
    WITH s AS (SELECT doc_id, text, unnest(range(0, length(text), {step})) AS head FROM documents)
    SELECT doc_id, (head // {step})::BIGINT AS chunk_index, head AS char_start, least(head + {size}, length(text))::BIGINT AS char_end,
      sha256(substr(text, head + 1, {size})) AS content_sha256 FROM s"""


def _chunks(t: Tables, size: int, overlap: int):
    longs = [F.col(c).cast("bigint").alias(c) for c in ("chunk_index", "char_start", "char_end")]
    return textjobs.chunk_documents(t.documents, "doc_id", "text", size, overlap).select("doc_id", *longs, "content_sha256")


@query("tx07_wn07_chunks", _chunk_sql(800, 100))
def chunks(t: Tables):
    return _chunks(t, 800, 100)


@query("tx07_wide_overlap_chunks", _chunk_sql(900, 600))
def wide_chunks(t: Tables):
    return _chunks(t, 900, 600)


def _articles(t: Tables):
    """Documents under planted headings; every third has the content and snapshot of the one before."""
    same = F.col("doc_id") - F.when(F.col("doc_id") % 3 == 2, 1).otherwise(0)
    text = F.concat(F.lit("# Report "), same.cast("string"), F.lit("\n"), F.col("text"), F.lit("\n## Methods of "), F.col("lang"), F.lit("\n"), F.col("text"),
                    F.lit("\nMain notes:\n"), F.col("text"), F.lit("\n# End\n"), F.col("text"))
    own = t.documents.select("doc_id", text.alias("text"), F.concat(F.lit("NCT"), F.lpad(same.cast("string"), 8, "0")).alias("nct_id"))
    return own.select(
        "nct_id", F.lit("snapshot-1").alias("source_snapshot_id"), F.lit("registry").alias("source_system"),
        F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("source_record_id"), "text",
    )


@query(
    "tx07_sectioned_chunks",
    r"""WITH a AS (SELECT lpad(doc_id::VARCHAR, 9, '0') AS rec, concat('NCT', lpad((doc_id - CASE WHEN doc_id % 3 = 2 THEN 1 ELSE 0 END)::VARCHAR, 8, '0')) AS nct_id,
         concat('# Report ', doc_id - CASE WHEN doc_id % 3 = 2 THEN 1 ELSE 0 END, chr(10), text, chr(10), '## Methods of ', lang, chr(10), text, chr(10),
           'Main notes:', chr(10), text, chr(10), '# End', chr(10), text) AS body FROM documents),
       d AS (SELECT *, sha256(body) AS sha FROM a QUALIFY row_number() OVER (PARTITION BY sha256(body) ORDER BY rec) = 1),
       pieces AS (SELECT rec, unnest(string_split_regex(body, '[
]')) AS piece, generate_subscripts(string_split_regex(body, '[
]'), 1) AS no FROM d),
       placed AS (SELECT *, (sum(length(piece) + 1) OVER (PARTITION BY rec ORDER BY no))::BIGINT - length(piece) - 1 AS spot FROM pieces),
       heads AS (SELECT rec, spot, CASE WHEN regexp_matches(piece, '^#{1,6}[ \t]+\S') THEN length(regexp_extract(piece, '^#+')) ELSE 7 END AS level,
           CASE WHEN regexp_matches(piece, '^#{1,6}[ \t]+\S') THEN regexp_extract(piece, '^#{1,6}[ \t]+(.*\S)', 1)
             ELSE regexp_extract(piece, '^\s*(.*\S)\s*:\s*$', 1) END AS title FROM placed
         WHERE regexp_matches(piece, '^#{1,6}[ \t]+\S') OR (regexp_matches(piece, ':\s*$') AND len(regexp_extract_all(piece, '[\p{L}\p{N}]+')) BETWEEN 1 AND 8)),
       chunk AS (SELECT rec, nct_id, sha, body, unnest(range(0, length(body), 500)) AS s FROM d),
       active AS (SELECT c.rec, c.s, h.spot, h.title FROM chunk c JOIN heads h ON h.rec = c.rec AND h.spot <= c.s
         WHERE NOT EXISTS (SELECT 1 FROM heads x WHERE x.rec = h.rec AND x.spot > h.spot AND x.spot <= c.s AND x.level <= h.level)),
       paths AS (SELECT rec, s, string_agg(title, ' / ' ORDER BY spot) AS path FROM active GROUP BY 1, 2)
       SELECT nct_id, c.rec AS source_record_id, sha AS source_content_sha256, (c.s // 500)::BIGINT AS chunk_index, coalesce(path, '') AS section_path,
         c.s AS char_start, least(c.s + 600, length(body))::BIGINT AS char_end, md5(substr(body, c.s + 1, 600)) AS chunk_md5
       FROM chunk c LEFT JOIN paths p ON p.rec = c.rec AND p.s = c.s""",
)
def sectioned(t: Tables):
    found = textjobs.document_chunks(_articles(t), 600, 100)
    longs = [F.col(c).cast("bigint").alias(c) for c in ("chunk_index", "char_start", "char_end")]
    return found.select("nct_id", "source_record_id", "source_content_sha256", "section_path", *longs, F.md5("chunk_text").alias("chunk_md5"))


# headers of many kinds with the section that each starts; documents take them in turn
_HEADERS = [
    ("Main Inclusion Criteria:", "inclusion"),
    ("Key Exclusion Criteria (Part A):", "exclusion"),
    ("Exclusion Criteria - Part A:", "exclusion"),
    ("Exclusion criteria include:", "exclusion"),
    ("Exclusion Criteria, Cohort 2:", "exclusion"),
    ("Healthy volunteer exclusion criteria:", "exclusion"),
    ("Exclusion:", "exclusion"),
    ("Criteria for exclusion:", "exclusion"),
    ("The exclusion criteria are as follows:", "exclusion"),
    ("INCLUSION CRITERIA", "inclusion"),
    ("Exclusion criteria", "exclusion"),
    ("Key inclusion criteria", "inclusion"),
    ("- Inclusion criteria:", "inclusion"),
    ("Inclusion and exclusion criteria:", "unknown"),
    ("Patients eligible for inclusion:", "inclusion"),
    ("Notes on this study:", None),
]


def _criteria(t: Tables):
    """Criteria text of a document: its text, then a planted header with two bullets and its text again."""
    headers = F.array(*[F.lit(h) for h, _ in _HEADERS])
    text = F.concat(F.col("text"), F.lit("\n"), F.get(headers, (F.col("doc_id") % len(_HEADERS)).cast("int")), F.lit("\n- "), F.col("source"),
                    F.lit(" only\n* "), F.col("text"))
    return t.documents.select("doc_id", text.alias("criteria"))


# The rule once more in SQL: words before the colon are counted and looked at, line by line.
_CLAUSES = rf"""
WITH c AS (SELECT doc_id, concat(text, chr(10), [{", ".join("'" + h + "'" for h, _ in _HEADERS)}][doc_id % {len(_HEADERS)} + 1], chr(10), '- ', source,
    ' only', chr(10), '* ', text) AS criteria FROM documents),
pieces AS (SELECT doc_id, unnest(string_split_regex(criteria, '[\r\n]')) AS piece, generate_subscripts(string_split_regex(criteria, '[\r\n]'), 1) AS no FROM c),
placed AS (SELECT *, (sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY no))::BIGINT - length(piece) - 1 AS start_at FROM pieces),
lines AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) - 1 AS line_no, regexp_extract(piece, '^(?:[\s*•\-]|\d+[.)]\s)*') AS lead
  FROM placed WHERE piece <> ''),
cored AS (SELECT *, substr(piece, length(lead) + 1) AS core, trim(lead, ' ' || chr(9)) <> '' AS bulleted,
  coalesce(lead(trim(lead, ' ' || chr(9)) <> '') OVER (PARTITION BY doc_id ORDER BY no), false) AS above_bullets FROM lines),
headed AS (SELECT *, strpos(core, ':') AS colon,
  regexp_extract_all(lower(CASE WHEN strpos(core, ':') > 0 THEN substr(core, 1, strpos(core, ':') - 1) ELSE core END), '[\p{{L}}\p{{N}}]+') AS w FROM cored),
named AS (SELECT *, list_contains(w, 'inclusion') AS has_in, list_contains(w, 'exclusion') AS has_ex, array_to_string(w, ' ') AS said FROM headed),
judged AS (SELECT *, CASE WHEN NOT (has_in OR has_ex) OR len(w) > 8 THEN false
    WHEN colon > 0 THEN NOT (bulleted AND trim(substr(core, colon + 1)) <> '')
    WHEN bulleted THEN said IN ('inclusion criteria', 'exclusion criteria') OR above_bullets
    ELSE above_bullets OR regexp_matches(said, '^(?:\S+ ){{0,2}}(?:in|ex)clusion criteria(?: \S+){{0,3}}$') END AS is_header FROM named),
sectioned AS (SELECT *, coalesce(last_value(CASE WHEN is_header THEN CASE WHEN has_in AND has_ex THEN 'unknown' WHEN has_in THEN 'inclusion' ELSE 'exclusion' END END IGNORE NULLS)
    OVER (PARTITION BY doc_id ORDER BY no), 'unknown') AS criterion_type,
  CASE WHEN NOT is_header THEN core WHEN colon > 0 THEN substr(core, colon + 1) ELSE '' END AS rest,
  length(lead) + CASE WHEN is_header AND colon > 0 THEN colon ELSE 0 END AS skipped FROM judged),
trimmed AS (SELECT *, CASE WHEN is_header THEN length(regexp_extract(rest, '^(?:[\s*•\-]|\d+[.)]\s)*')) ELSE 0 END AS again FROM sectioned),
body AS (SELECT doc_id, line_no, criterion_type, regexp_replace(substr(rest, again + 1), '\s+$', '') AS raw_text, start_at + skipped + again AS char_start FROM trimmed)
"""


@query(
    "tx08_eligibility_clauses",
    _CLAUSES
    + """SELECT doc_id, line_no::BIGINT AS line_no, criterion_type, md5(raw_text) AS raw_md5, char_start::BIGINT AS char_start,
       (char_start + length(raw_text))::BIGINT AS char_end FROM body WHERE raw_text <> ''""",
)
def clauses(t: Tables):
    found = textjobs.eligibility_clauses(_criteria(t), "doc_id", "criteria")
    longs = [F.col(c).cast("bigint").alias(c) for c in ("line_no", "char_start", "char_end")]
    return found.select("doc_id", "criterion_type", F.md5("raw_text").alias("raw_md5"), *longs)


@query(
    "tx08_planted_headers",
    f"""WITH h AS (SELECT unnest(range({len(_HEADERS)})) AS k, unnest([{", ".join("'" + k + "'" if k else "NULL" for _, k in _HEADERS)}]) AS kind)
        SELECT doc_id, kind AS criterion_type FROM documents JOIN h ON doc_id % {len(_HEADERS)} = k WHERE kind IS NOT NULL""",
)
def planted_headers(t: Tables):
    """The type of the first clause under each planted header, against the list of headers."""
    found = textjobs.eligibility_clauses(_criteria(t), "doc_id", "criteria")
    before = t.documents.select("doc_id", F.length("text").alias("own"), F.concat("source", F.lit(" only")).alias("planted"))
    under = found.join(before, "doc_id").filter((F.col("char_start") > F.col("own")) & (F.col("raw_text") == F.col("planted")))
    first = under.groupBy("doc_id").agg(F.min_by("criterion_type", "line_no").alias("criterion_type"))
    return first.filter(F.col("doc_id") % len(_HEADERS) != len(_HEADERS) - 1)


def _measured(t: Tables):
    """Clauses with the numbers of a document in many writings."""
    n = F.col("n_chars")
    grouped = F.format_number(n, 0)
    comma = F.concat(F.floor(n / 10).cast("string"), F.lit(","), (n % 10).cast("string"))
    parts = [
        F.concat(F.lit("Platelets >= "), grouped, F.lit(" /mm3")), F.concat(F.lit("HbA1c < "), comma, F.lit(" %")),
        F.concat(F.lit("weight > -"), n.cast("string"), F.lit(" kg")), F.concat(n.cast("string"), F.lit(" <= age <= "), (n + 7).cast("string")),
        F.concat(F.lit("bilirubin <= "), n.cast("string"), F.lit(".5 x ULN and >= 2")), F.concat(F.lit("washout > one "), F.col("lang")),
    ]
    return t.documents.select("doc_id", F.concat_ws("; ", *parts).alias("clause"))


@query(
    "tx09_normalized_clauses",
    """WITH v AS (SELECT doc_id, unnest([
         {'place': 1, 'field': 'platelets', 'comparator': '>=', 'value': n_chars::DOUBLE, 'unit': '/mm3'},
         {'place': 2, 'field': 'hba1c', 'comparator': '<', 'value': n_chars / 10, 'unit': '%'},
         {'place': 3, 'field': 'weight', 'comparator': '>', 'value': -n_chars::DOUBLE, 'unit': 'kg'},
         {'place': 4, 'field': 'age', 'comparator': '>=', 'value': n_chars::DOUBLE, 'unit': NULL},
         {'place': 5, 'field': 'age', 'comparator': '<=', 'value': (n_chars + 7)::DOUBLE, 'unit': NULL},
         {'place': 6, 'field': 'bilirubin', 'comparator': '<=', 'value': n_chars + 0.5::DOUBLE, 'unit': 'x uln'},
         {'place': 7, 'field': 'bilirubin', 'comparator': '>=', 'value': 2::DOUBLE, 'unit': NULL},
         {'place': 8, 'field': 'washout', 'comparator': '>', 'value': NULL::DOUBLE, 'unit': NULL}]) AS x FROM documents)
       SELECT doc_id, x.place::BIGINT AS place, x.field AS field, x.comparator AS comparator, round(x.value, 6) AS value, x.unit AS unit FROM v""",
)
def normalized(t: Tables):
    """Numbers that are grouped, signed, with a decimal comma, before the sign or missing."""
    each = F.posexplode(textjobs.normalized_clauses("clause")).alias("place", "n")
    found = _measured(t).select("doc_id", each)
    return found.select(
        "doc_id", (F.col("place") + 1).cast("bigint").alias("place"), "n.field", "n.comparator", F.round("n.value", 6).alias("value"), "n.unit"
    )


@query(
    "tx09_eligibility_trees",
    _CLAUSES
    + """SELECT doc_id, count(*) FILTER (criterion_type = 'inclusion') AS inclusion_clauses,
       count(*) FILTER (criterion_type = 'exclusion') AS exclusion_clauses, count(*) FILTER (criterion_type = 'unknown') AS unknown_clauses,
       count(*) FILTER (criterion_type = 'inclusion') AS tree_inclusions FROM body WHERE raw_text <> '' GROUP BY 1""",
)
def trees(t: Tables):
    found = textjobs.eligibility_tree(textjobs.eligibility_clauses(_criteria(t), "doc_id", "criteria"), "doc_id")
    in_tree = F.json_array_length(F.get_json_object("tree_json", "$.all_of")).cast("bigint")
    return found.select("doc_id", "inclusion_clauses", "exclusion_clauses", "unknown_clauses", in_tree.alias("tree_inclusions"))


@query(
    "jn11_clauses_in_chunks",
    _CLAUSES
    + """, kept AS (SELECT *, char_start + length(raw_text) AS char_end FROM body WHERE raw_text <> ''),
       chunk AS (SELECT doc_id, unnest(range(0, length(criteria), 700)) AS s, length(criteria) AS n FROM c)
       SELECT k.doc_id, k.line_no::BIGINT AS line_no, (s // 700)::BIGINT AS chunk_index FROM kept k JOIN chunk USING (doc_id)
       WHERE k.char_start >= s AND k.char_end <= least(s + 1000, n)""",
)
def contained(t: Tables):
    criteria = _criteria(t)
    found = textjobs.eligibility_clauses(criteria, "doc_id", "criteria")
    pieces = textjobs.chunk_documents(criteria, "doc_id", "criteria", 1000, 300)
    joined = textjobs.clauses_in_chunks(found, pieces, "doc_id", 1000)
    return joined.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("line_no", "chunk_index")])


def _dictionary(t: Tables):
    """Words of benchmark passages as concepts of the four types: terms of three words, two words and one."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    terms = F.array(*[F.array_join(F.slice("w", a, n), " ") for a, n in ((1, 3), (4, 2), (7, 1))])
    named = t.benchmark.select("item_id", w.alias("w")).filter(F.size("w") >= 7).select("item_id", F.explode(terms).alias("term"))
    kinds = F.array(*[F.lit(k) for k in ("disease", "biomarker", "lab", "treatment")])
    return named.groupBy("term").agg(F.min("item_id").alias("id")).select(
        "term", F.concat(F.lit("C"), F.col("id").cast("string")).alias("concept_id"), F.get(kinds, (F.col("id") % 4).cast("int")).alias("concept_type")
    )


_CONCEPTS = r"""
WITH b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
terms AS (SELECT item_id, unnest([concat(w[1], ' ', w[2], ' ', w[3]), concat(w[4], ' ', w[5]), w[7]]) AS term FROM b WHERE len(w) >= 7),
d AS (SELECT term, min(item_id) AS id FROM terms GROUP BY 1),
concepts AS (SELECT term, concat('C', id) AS concept_id, ['disease', 'biomarker', 'lab', 'treatment'][id % 4 + 1] AS concept_type FROM d),
runs AS (SELECT doc_id, unnest(r) AS piece, generate_subscripts(r, 1) AS no FROM
  (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+') AS r FROM documents)),
spots AS (SELECT *, (sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY no))::BIGINT AS till FROM runs),
words AS (SELECT doc_id, lower(piece) AS w, till - length(piece) AS a, till AS z, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS n
  FROM spots WHERE regexp_matches(piece, '^[\p{L}\p{N}]')),
grams AS (SELECT doc_id, a, w AS g1, z AS z1, concat(w, ' ', lead(w, 1) OVER o) AS g2, lead(z, 1) OVER o AS z2,
  concat(w, ' ', lead(w, 1) OVER o, ' ', lead(w, 2) OVER o) AS g3, lead(z, 2) OVER o AS z3 FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
found AS (SELECT doc_id, a, z1 AS z, g1 AS term FROM grams UNION ALL SELECT doc_id, a, z2, g2 FROM grams WHERE z2 IS NOT NULL
  UNION ALL SELECT doc_id, a, z3, g3 FROM grams WHERE z3 IS NOT NULL),
links AS (SELECT doc_id, term, concept_id, concept_type, a AS char_start, z AS char_end FROM found JOIN concepts USING (term))
"""


@query(
    "tx03_concept_links",
    _CONCEPTS
    + """SELECT doc_id, term, concept_id, concept_type, term AS concept_label, 1.0::DOUBLE AS confidence, char_start::BIGINT AS char_start,
       char_end::BIGINT AS char_end FROM links""",
)
def concepts(t: Tables):
    found = textjobs.link_concepts(t.documents, "doc_id", "text", _dictionary(t))
    longs = [F.col(c).cast("bigint").alias(c) for c in ("char_start", "char_end")]
    return found.select("doc_id", "term", "concept_id", "concept_type", "concept_label", "confidence", *longs)


@query(
    "tx03_first_entities",
    _CONCEPTS
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY char_start, char_end, concept_id) AS r FROM links)
       SELECT doc_id, count(*) AS entity_count, string_agg(concat(term, '/', concept_type), ', ' ORDER BY r) FILTER (r <= 20) AS entities
       FROM ranked GROUP BY 1""",
)
def entities(t: Tables):
    links = textjobs.link_concepts(t.documents, "doc_id", "text", _dictionary(t))
    found = textjobs.first_entities(links, "doc_id", 20)
    shown = F.transform("named_entities", lambda e: F.concat(e["text"], F.lit("/"), e["label"]))
    return found.select("doc_id", "entity_count", F.array_join(shown, ", ").alias("entities"))


@query(
    "tx15_synonyms",
    """WITH s AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS term, lower(split_part(p_name, ' ', 2)) AS synonym FROM part),
       w AS (SELECT DISTINCT p_partkey, unnest(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS term FROM part)
       SELECT DISTINCT p_partkey, w.term, synonym FROM w JOIN s ON w.term = s.term""",
)
def synonyms(t: Tables):
    words = F.split(F.lower("p_name"), " ")
    table = t.part.select(F.get(words, F.lit(0)).alias("term"), F.get(words, F.lit(1)).alias("synonym")).distinct()
    return textjobs.expand_synonyms(t.part, "p_partkey", "p_name", table)


@query(
    "tx10_embeddings",
    r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(concat(source, ' ', text)), '[\p{L}\p{N}]+')) AS t FROM documents),
       n AS (SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 384 AS place, count(*) AS c FROM w GROUP BY 1, 2)
       SELECT doc_id, 384::BIGINT AS dimension, string_agg(place::VARCHAR, ',' ORDER BY c DESC, place) AS places, 1.0::DOUBLE AS length FROM n GROUP BY 1""",
)
def embeddings(t: Tables):
    """The places of each embedding by size, and its length."""
    df = t.documents.select("doc_id", F.col("source").alias("title"), F.col("text").alias("brief_summary"))
    made = embed.generate_embeddings(df, "doc_id")
    sized = F.transform("embedding", lambda v, i: F.struct((-v).alias("order"), i.alias("place")))
    places = F.transform(F.array_sort(F.filter(sized, lambda p: p["order"] < 0)), lambda p: p["place"].cast("string"))
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return made.select(
        "doc_id", F.size("embedding").cast("bigint").alias("dimension"), F.array_join(places, ",").alias("places"), F.round(F.sqrt(squares), 4).alias("length")
    )


@query(
    "ag23_embedding_statistics",
    "SELECT count(*) AS total_embeddings, max(len(embedding))::BIGINT AS embedding_dimension, NULL::VARCHAR AS error FROM embeddings",
)
def embedding_statistics(t: Tables):
    stats = embed.embedding_statistics(t.embeddings)
    return stats.withColumn("embedding_dimension", F.col("embedding_dimension").cast("bigint"))
