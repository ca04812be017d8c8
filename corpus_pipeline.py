"""The corpus pipeline: each stage keeps or rewrites the documents that the one before it left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchweave.llm import crf, decontaminate, pieces, pii, simhash
from matchweave.llm.common import arrow_columns, table
from matchweave.session import clear_scratch, scratch_mark, stage

MODEL = "piece_bpe_32k.model"
#: Documents whose chance of good quality is lower go.
QUALITY = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line chain does not reject: all, if there are no labels of both kinds to learn from.

    Rows keep all columns; null and empty texts are scored like any other.
    """
    chain = crf.quality_chain(docs, table(spark, sf_dir, "labels"))
    if not chain.learned:
        return docs

    def make():
        return lambda texts: [[chain.score(t or "") for t in texts]]

    scored = arrow_columns(docs, "text", [T.StructField("_quality_score", T.DoubleType())], make, keep_text=True)
    return scored.where(F.col("_quality_score") >= QUALITY).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id, a null one last; of rows with that id and text one.

    A document is an id with a text, so unlike texts under one id are different documents, and each stays if its own group has it as the first.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    stays = simhash.members(docs).groupBy("root").agg(first).select(F.col("first.doc_id").alias("_stays"), F.col("first.text_hash").alias("_stays_hash")).distinct()
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    left = hashed.join(stays, hashed["doc_id"].eqNullSafe(stays["_stays"]) & (hashed["_hash"] == stays["_stays_hash"]), "left_semi")
    return left.dropDuplicates(["doc_id", "_hash"]).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row (nor a whole shorter item) with the benchmark."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    gone = found.select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs["text"]) == gone["_gone_hash"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.scrubbed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, scores, decoded, nbest): piece ids of each document's best segmentation, the scores of the best few and what each changes."""
    return pieces.segmented(docs, MODEL)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("personal_data", without_personal_data),
    ("encoding", encoded),
]
#: A trained chain and a tokenizer are among the stages, which SQL cannot express; tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again by the next; then the tables before are removed.

    Null columns, empty texts and tables pass as each stage says; extra columns stay until the last stage.
    """
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        clear_scratch(spark, mark, but=1)
    return docs
