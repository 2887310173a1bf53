"""One registered query per operator, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlake.llm import fingerprints, jaccard_join, lexical_search, main_text, perspectives, phrase_index, pieces, private_data, spelling, suffix_dedup, token_files, toxicity, vector_graph


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every window of 13 words of the benchmark."""
    benchmark = _table(spark, sf_dir, "benchmark")
    found = phrase_index.contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), benchmark)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document."""
    return pieces.digests(_table(spark, sf_dir, "documents"), n_best=4)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 50-byte strings."""
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents")).drop("kept")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = main_text.extract(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added personal data spans of every document."""
    found = private_data.find_private(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in private_data.KINDS[:4]],
        F.size("spans").cast("bigint").alias("n_spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == "secret")).cast("bigint").alias("n_secret"),
        F.sha2(private_data.joined(F.col("base")), 256).alias("base_sha256"),
        private_data.joined(F.col("spans")).alias("spans"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, written as wavelet matrices and read back."""
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness."""
    return fingerprints.compare(_table(spark, sf_dir, "documents"))


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as seen by each of its participants."""
    seen = perspectives.rotate(_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return seen.withColumn("mask", mask)


_PERSPECTIVES_SQL = """
WITH r AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                  coalesce(CAST(floor(turn / 128.0) AS BIGINT), -1) AS part
           FROM conversations WHERE conv_id IS NOT NULL),
     s AS (SELECT DISTINCT conv_id, role AS speaker FROM r),
     t AS (SELECT r.*, speaker, role = speaker AS own,
                  CASE WHEN role = speaker THEN '<|im_start|>assistant' ELSE '<|im_start|>user name='||role END
                  || chr(10) AS head, text || '<|im_end|>' AS body
           FROM r JOIN s USING (conv_id)),
     w AS (SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part
                  ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM t)
SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || body, chr(10) ORDER BY pos) AS text,
       coalesce(string_agg(CAST(pos + length(head) AS BIGINT) || ':' || CAST(pos + length(head) + length(body) AS BIGINT), ','
                ORDER BY pos) FILTER (own), '') AS mask
FROM w GROUP BY conv_id, speaker, part"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document; labels of a quarter of the ids are never learnt from."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.3).cast("int").alias("predicted"),
        F.col("toxic_threshold").alias("lang_threshold"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by shingle sets of similarity 0.8 or more."""
    return jaccard_join.components(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)
    return found.withColumnRenamed("item", "item_id")


_SEARCH_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
     d AS (SELECT r, doc_id, count(*) AS n FROM t GROUP BY r, doc_id),
     s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
     p AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
           FROM p, s GROUP BY term),
     m AS (SELECT r, doc_id, 100 - 90 + (90 * n * docs) // total AS m FROM d, s),
     x AS (SELECT item_id, doc_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM i JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, doc_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
WHERE rank <= 10"""


def op12_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and components of every vector within its label."""
    return vector_graph.links(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with the form that it is a variant of."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_pieces": op2_pieces,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_main_text": op4_main_text,
        "op5_private_data": op5_private_data,
        "op6_token_files": op6_token_files,
        "op7_fingerprints": op7_fingerprints,
        "op8_perspectives": op8_perspectives,
        "op9_toxicity": op9_toxicity,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_lexical_search": op11_lexical_search,
        "op12_vector_graph": op12_vector_graph,
        "op13_spelling": op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_perspectives": _PERSPECTIVES_SQL, "op11_lexical_search": _SEARCH_SQL}
