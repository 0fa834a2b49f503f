"""Token features, weights, chunks, eligibility clauses and concept links."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialspark.functions.text import (
    STOP_WORDS,
    alphabetic,
    clean_text,
    comparisons,
    criteria_lines,
    match_spans,
    ngrams,
    not_stop,
    section_outline,
    tokens,
    word_tokens,
    words,
)
from trialspark.session import cut_lineage

#: Bytes of texts whose words one task counts.
DEALT_BYTES = 4_000_000


def combined_text(
    df: DataFrame,
    cols: Iterable[str],
    limits: Mapping[str, int] | None = None,
    drop_blank: bool = True,
) -> DataFrame:
    """Add ``combined_text``: columns with null as blank, each cut to its limit, joined by blanks."""
    limits = limits or {}
    parts = []
    for c in cols:
        part = F.coalesce(F.col(c), F.lit(""))
        parts.append(F.substring(part, 1, limits[c]) if c in limits else part)
    df = df.withColumn("combined_text", F.concat_ws(" ", *parts))
    return df.filter(F.col("combined_text").rlike(r"(?U)\S")) if drop_blank else df


def token_features(
    df: DataFrame, id_col: str, text_col: str, stop_words: Iterable[str] = STOP_WORDS
) -> DataFrame:
    """Token count, distinct tokens and their ratio, all inside the scan stage."""
    counted = df.select(id_col, words(text_col, stop_words).alias("_w")).select(
        id_col,
        F.size("_w").cast("bigint").alias("token_count"),
        F.size(F.array_distinct("_w")).cast("bigint").alias("unique_tokens"),
    )
    diversity = F.when(F.col("token_count") > 0, F.col("unique_tokens") / F.col("token_count")).otherwise(0.0)
    return counted.withColumn("lexical_diversity", diversity)


def concat_features(*frames: DataFrame, spark, schema: str) -> DataFrame:
    """Union of feature frames by name; no frame gives an empty typed one."""
    out = spark.createDataFrame([], schema)
    for frame in frames:
        out = out.unionByName(frame)
    return out


def feature_summary(features: DataFrame) -> DataFrame:
    """Rows, mean tokens, mean diversity and the sum of entity counts; zeros when empty."""
    return features.agg(
        F.count("*").alias("total_processed"),
        F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_token_count"),
        F.coalesce(F.avg("lexical_diversity"), F.lit(0.0)).alias("avg_lexical_diversity"),
        F.coalesce(F.sum("entity_count"), F.lit(0)).alias("total_entities"),
    )


def shard_outcomes(df: DataFrame, shard: str, failed: str) -> DataFrame:
    """Succeeded and failed shards: a shard with any failed row has failed."""
    per_shard = df.groupBy(shard).agg(
        F.bool_or(failed).alias("has_failed"), F.count("*").alias("rows"), F.count_if(failed).alias("failed_rows")
    )
    return per_shard.groupBy(F.when(F.col("has_failed"), "failed").otherwise("succeeded").alias("status")).agg(
        F.count("*").alias("shards"), F.sum("rows").alias("rows"), F.sum("failed_rows").alias("failed_rows")
    )


def top_words(
    df: DataFrame, id_col: str, text_col: str, n: int = 10, stop_words: Iterable[str] = STOP_WORDS
) -> DataFrame:
    """The n most frequent words of each text, ties by first appearance.

    Texts are dealt by id before they are cut, so they move once and words and their counts not at all.
    Parts are of counted sizes: the words of a text take many times its room in a task.
    """
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    dealt = df.select(id_col, text_col).repartition(-(-size // DEALT_BYTES) or 1, id_col)
    placed = dealt.select(id_col, F.posexplode(alphabetic(text_col)).alias("pos", "word"))
    placed = placed.filter(not_stop(F.col("word"), stop_words))
    counted = placed.groupBy(id_col, "word").agg(F.count("*").alias("freq"), F.min("pos").alias("first_pos"))
    order = Window.partitionBy(id_col).orderBy(F.desc("freq"), F.asc("first_pos"))
    return (
        counted.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select(id_col, "word", "freq", "rank")
    )


def top_words_map(df: DataFrame, id_col: str, text_col: str, n: int = 10) -> DataFrame:
    """The same as one map per text; a text without words has an empty map."""
    ranked = top_words(df, id_col, text_col, n)
    maps = ranked.groupBy(id_col).agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "word", "freq"))),
                lambda e: F.struct(e["word"], e["freq"]),
            )
        ).alias("top_words")
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    return df.select(id_col).join(maps, id_col, "left").withColumn("top_words", F.coalesce("top_words", empty))


def cleaned_words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Text without tags and control characters, and its words without stop words."""
    cleaned = df.select(id_col, clean_text(text_col).alias("clean_text"))
    return cleaned.withColumn("words", words("clean_text"))


def tfidf(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Term count × ln((N + 1) / (document frequency + 1)).

    Texts are tokenized and counted once: the counts are written, and document frequencies merge map-side
    over them. The join goes from (text, term) rows to one row per term; a common term's rows are a skewed
    left side, which the adaptive join splits.
    """
    counts = cut_lineage(
        df.select(id_col, F.explode(alphabetic(text_col)).alias("term"))
        .filter(not_stop(F.col("term")))
        .groupBy(id_col, "term")
        .agg(F.count("*").alias("tf"))
    )
    frequency = counts.groupBy("term").agg(F.count("*").alias("df"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.join(frequency, "term").select(
        id_col, "term", "tf", "df", (F.col("tf") * F.ln((total + 1) / (F.col("df") + 1))).alias("tfidf")
    )


def trigram_counts(df: DataFrame, text_col: str, n: int = 3) -> DataFrame:
    """How often each run of ``n`` words occurs.

    Texts are dealt to parts of counted sizes before they are cut, so a file of few row groups is cut by many tasks.
    """
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    dealt = df.select(text_col).repartition(-(-size // DEALT_BYTES) or 1)
    grams = dealt.select(word_tokens(text_col).alias("_t")).select(F.explode(ngrams(F.col("_t"), n)).alias("trigram"))
    return grams.groupBy("trigram").agg(F.count("*").alias("occurrences"))


def chunk_documents(df: DataFrame, id_col: str, text_col: str, size: int, overlap: int = 0) -> DataFrame:
    """Chunks of ``size`` characters every ``size - overlap``, in one pass over each text.

    The text is cut once into blocks of the step; a chunk is its block plus the head of the next
    ones. ``char_start`` and ``char_end`` address the text exactly.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    following = -(-overlap // step)
    blocks = F.regexp_extract_all(F.col(text_col), F.lit("(?s).{1,%d}" % step), F.lit(0))
    cut = df.select(id_col, blocks.alias("_b")).select(
        id_col, F.col("_b"), F.posexplode("_b").alias("chunk_index", "_block")
    )
    parts = [F.col("_block")]
    left = overlap
    for ahead in range(1, following + 1):
        take = min(step, left)
        left -= take
        nxt = F.coalesce(F.get("_b", F.col("chunk_index") + ahead), F.lit(""))
        parts.append(F.substring(nxt, 1, take))
    chunk = F.concat(*parts)
    return (
        cut.withColumn("chunk_text", chunk)
        .withColumn("char_start", (F.col("chunk_index") * step).cast("int"))
        .withColumn("char_end", (F.col("char_start") + F.length("chunk_text")).cast("int"))
        .withColumn("content_sha256", F.sha2("chunk_text", 256))
        .select(id_col, "chunk_index", "chunk_text", "char_start", "char_end", "content_sha256")
    )


def document_chunks(
    documents: DataFrame, size: int, overlap: int = 0, text_col: str = "text"
) -> DataFrame:
    """Chunks with their provenance and section, unique by snapshot, content and ``chunk_index``.

    ``documents`` has ``nct_id``, ``source_snapshot_id``, ``source_system``, ``source_record_id`` and the
    text. Of records with one content in one snapshot the smallest by record id is cut. Content and sections
    are worked out where the text is; only keys are compared across records.
    """
    keys = ["source_snapshot_id", "source_content_sha256"]
    known = documents.withColumns(
        {"source_content_sha256": F.sha2(F.col(text_col).cast("binary"), 256), "_outline": section_outline(F.col(text_col))}
    )
    order = Window.partitionBy(*keys).orderBy("source_record_id", "source_system")
    first = known.select(*keys, "source_record_id", "source_system").withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    kept = known.join(first, [*keys, "source_record_id", "source_system"], "left_semi").dropDuplicates([*keys, "source_record_id", "source_system"])
    rest = ["nct_id", "source_snapshot_id", "source_system", "source_record_id", "source_content_sha256"]
    cut = chunk_documents(kept.withColumn("_doc", F.struct(*rest, "_outline")), "_doc", text_col, size, overlap)
    inside = F.filter("_doc._outline", lambda o: o["start"] <= F.col("char_start"))
    return cut.select(
        *[F.col(f"_doc.{c}").alias(c) for c in rest],
        F.coalesce(F.try_element_at(inside, F.lit(-1))["path"], F.lit("")).alias("section_path"),
        "chunk_index", "chunk_text", "char_start", "char_end",
    )


def eligibility_clauses(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines of the criteria text as clauses with their section's type and character offsets.

    A line of few words that names inclusion or exclusion, such as ``Key Exclusion Criteria (Part A):``,
    starts its section (:func:`trialspark.functions.text.criteria_header`); what follows its colon is a
    clause. Lines before any header, or under one that names both, have type ``unknown``: nothing that
    is not decided counts as inclusion. Bullets are not part of a clause. Texts are read where they are;
    no line is shuffled.
    """
    return df.select(id_col, F.explode(criteria_lines(F.col(text_col))).alias("c")).select(
        id_col, "c.line_no", "c.criterion_type", F.col("c.text").alias("raw_text"), F.col("c.start").alias("char_start"),
        (F.col("c.start") + F.length("c.text")).cast("int").alias("char_end"),
    )


def normalized_clauses(c: Column | str) -> Column:
    """array of struct(field, comparator, value, unit, raw): every comparison, such as ``age >= 18 years``.

    The field is the run of words before the comparator without a joining word; a comparison without one
    (``>= 18 years and <= 65 years``) has the field of the one before. A number before the sign and none
    after it (``18 <= age``) is read from the other side. Numbers may be signed, grouped (``100,000``) or
    have a decimal comma (``7,5``); where none can be read, ``value`` is null and ``raw`` keeps the text.
    A joining word is never a unit; ``1.5 x ULN`` has unit ``x uln``. Text without a comparison has an
    empty array.
    """
    return comparisons(F.col(c) if isinstance(c, str) else c)


def eligibility_tree(clauses: DataFrame, id_col: str) -> DataFrame:
    """One JSON tree per record: all inclusion clauses, none of the exclusion clauses, and the undecided."""
    node = F.struct("line_no", "raw_text", normalized_clauses("raw_text").alias("normalized"))
    side = lambda kind: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("criterion_type") == kind, node))), lambda n: n.dropFields("line_no")
    )
    tree = F.to_json(
        F.struct(side("inclusion").alias("all_of"), side("exclusion").alias("none_of"), side("unknown").alias("undecided"))
    )
    of = lambda kind: F.count_if(F.col("criterion_type") == kind)
    return clauses.groupBy(id_col).agg(
        tree.alias("tree_json"),
        of("inclusion").alias("inclusion_clauses"), of("exclusion").alias("exclusion_clauses"), of("unknown").alias("unknown_clauses"),
    )


def term_trie(dictionary: DataFrame) -> DataFrame:
    """Every prefix of every term: ``parent`` (the prefix before), ``word``, ``prefix``; the root is empty."""
    words = dictionary.select("term").distinct().select(F.split("term", " ").alias("w"))
    upto = lambda n: F.array_join(F.slice("w", F.lit(1), n), " ")
    steps = F.transform(
        F.sequence(F.lit(1), F.size("w")),
        lambda n: F.struct(upto(n - 1).alias("parent"), F.get("w", n - 1).alias("word"), upto(n).alias("prefix")),
    )
    return words.select(F.explode(steps).alias("s")).select("s.*").distinct()


def dictionary_words(df: DataFrame, id_col: str, text_col: str, trie: DataFrame) -> DataFrame:
    """The words of texts that occur in some term: id, ``pos``, ``word``, ``start``, ``end``."""
    spans = match_spans(r"[^\W_]+", lower=True)
    placed = df.select(id_col, F.posexplode(spans(F.col(text_col))).alias("pos", "s"))
    words = placed.select(id_col, "pos", F.col("s.text").alias("word"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    return words.join(trie.select("word").distinct(), "word", "left_semi")


def link_concepts(df: DataFrame, id_col: str, text_col: str, dictionary: DataFrame) -> DataFrame:
    """Dictionary terms in texts with offsets: id, ``term``, concept and ``char_start``, ``char_end``.

    ``dictionary`` has ``term`` (lower-case words joined by blanks), ``concept_id`` and ``concept_type``;
    ``concept_label``, ``normalized_value`` and ``confidence`` are the term, the term and 1 unless it has
    them too. Ids of texts are unique.

    Of the texts only words that occur in some term go on. From there matches walk down a trie of the
    terms, a join per level: a row lives as long as its words are the beginning of a term, so rows follow
    matches, not the length of the longest term. Levels end with the longest term.
    """
    trie = cut_lineage(term_trie(dictionary))
    words = cut_lineage(dictionary_words(df, id_col, text_col, trie))
    depth = trie.agg(F.max(F.size(F.split("prefix", " ")))).first()[0] or 0
    level = words.join(trie.filter("parent = ''"), "word").select(
        id_col, "pos", "prefix", F.col("start").alias("char_start"), F.col("end").alias("char_end")
    )
    found = level
    following = words.select(id_col, F.col("pos").alias("_at"), "word", "end")
    for n in range(1, depth):
        deeper = trie.filter((F.size(F.split("parent", " ")) == n) & (F.col("parent") != "")).select(
            F.col("parent").alias("prefix"), "word", F.col("prefix").alias("_prefix")
        )
        begun = level.join(deeper.select("prefix").distinct(), "prefix", "left_semi")
        level = cut_lineage(
            begun.withColumn("_at", F.col("pos") + n)
            .join(following, [id_col, "_at"])
            .join(deeper, ["prefix", "word"])
            .select(id_col, "pos", F.col("_prefix").alias("prefix"), "char_start", F.col("end").alias("char_end"))
        )
        found = found.unionByName(level)
    own = dict.fromkeys(dictionary.columns)
    extra = {"concept_label": F.col("term"), "normalized_value": F.col("term"), "confidence": F.lit(1.0)}
    terms = dictionary.withColumns({n: c for n, c in extra.items() if n not in own})
    return found.withColumnRenamed("prefix", "term").join(terms, "term").select(
        id_col, "term", "concept_id", "concept_type", "concept_label", "normalized_value", "confidence", "char_start", "char_end"
    )


def first_entities(links: DataFrame, id_col: str, keep: int | None = None) -> DataFrame:
    """Per text: how many links there are, and the first ``keep`` (all, without a number) in text order."""
    order = Window.partitionBy(id_col).orderBy("char_start", "char_end", "concept_id")
    counts = links.groupBy(id_col).agg(F.count("*").alias("entity_count"))
    head = (
        links.withColumn("_n", F.row_number().over(order))
        .filter(F.lit(True) if keep is None else F.col("_n") <= keep)
        .groupBy(id_col)
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_n", "term", "concept_type"))),
                lambda e: F.struct(e["term"].alias("text"), e["concept_type"].alias("label")),
            ).alias("named_entities")
        )
    )
    return counts.join(head, id_col)


def expand_synonyms(df: DataFrame, id_col: str, text_col: str, synonyms: DataFrame) -> DataFrame:
    """(id, term, synonym) for every distinct token with an entry in ``synonyms(term, synonym)``.

    Both sides are made distinct before they meet, so that no task holds the rows of the result.
    """
    terms = df.select(id_col, F.explode(F.array_distinct(tokens(text_col))).alias("term")).distinct()
    return terms.join(synonyms.select("term", "synonym").distinct(), "term").select(id_col, "term", "synonym")


def clauses_in_chunks(clauses: DataFrame, chunks: DataFrame, path: str, width: int) -> DataFrame:
    """Clauses with the chunks of the same document that contain them whole.

    Offsets are bucketed by ``width`` so that the join is an equi-join: a clause meets only chunks
    that cover its first character.
    """
    last = F.greatest(F.col("chunk_start"), F.col("chunk_end") - 1)
    covered = chunks.select(
        path,
        "chunk_index",
        F.col("char_start").alias("chunk_start"),
        F.col("char_end").alias("chunk_end"),
    ).withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(F.col("chunk_start") / width), F.floor(last / width))),
    )
    placed = clauses.withColumn("_bucket", F.floor(F.col("char_start") / width))
    inside = (F.col("char_start") >= F.col("chunk_start")) & (F.col("char_end") <= F.col("chunk_end"))
    return placed.join(covered, [path, "_bucket"]).filter(inside).drop("_bucket")
