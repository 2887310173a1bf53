"""The corpus pipeline: five stages over ``documents``, each by one operator of ``hitlake.llm``.

Every stage takes all rows that its predecessor kept and returns rows with the columns of ``documents`` (the last
one returns token ids and the texts that they decode to).  Each result is written as Parquet and read again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlake.llm import jaccard_join, phrase_index, pieces, private_data, toxicity
from hitlake.storage import scratch_path

#: The columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Score from which on a document is rejected as toxic.
TOXIC = 0.3

#: Segmentations of every text.
N_BEST = 4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; the model is fitted on the labelled ones among ``docs``."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("toxic_score") < TOXIC).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without words or without an id stay."""
    found = jaccard_join.components(docs.where("doc_id IS NOT NULL").select("doc_id", "text"))
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = phrase_index.contamination(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = found.where("contaminated").select(F.col("id").alias("doc_id")).distinct()
    return docs.select(*COLUMNS).join(bad, "doc_id", "left_anti").select(*COLUMNS)


def redact_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind in brackets."""
    found = private_data.find_private(docs.select(*COLUMNS), also=COLUMNS[2:])
    return private_data.redact(found).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ``N_BEST`` best segmentations of every text with their scores, the first as ids and the others beside it, and the text that the first decodes to."""
    found = pieces.decode(pieces.encode(docs.select(*COLUMNS), n_best=N_BEST).drop("text", "n_chars"))
    return found.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_pieces"), "ids", F.col("scores")[0].alias("score"), "scores", "others", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_private_data),
    ("SentencePiece encoding and decoding", encode),
]

#: No SQL: a trained network and a lattice search are beyond it.  Tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
