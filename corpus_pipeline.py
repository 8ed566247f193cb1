"""A training-data pipeline over ``documents``: each stage calls one operator and hands its rows to the next.

1. toxicity: documents that the network rejects go.
2. near_duplicates: one document of each near-duplicate group stays.
3. decontamination: documents that hold a benchmark item go.
4. secrets: findings are replaced in the text; no document goes.
5. packing: token pieces placed in sequences; the last stage, with its own columns.

Null texts are clean in stages 1 to 4 (and each other's copies in 2). Ids are
taken to tell documents apart: rows with a null id are kept by stages 2 and 3,
rows that share an id go or stay together in stage 3, and of those in stage 2
that stay one is kept. Extra columns pass through all but the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import decontaminate, jaccard, packing, secrets, toxicity
from seriesloom.llm.common import free_name, learns_from, table
from seriesloom.session import stage

REJECT = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labelled rows of this stage's own documents; keeps those scored below ``REJECT``."""
    labels = table(spark, sf_dir, "labels").where(learns_from("doc_id", 4, 2))
    net = toxicity.fit(docs, labels)
    score = free_name(docs.columns, "__toxicity")
    return toxicity.score(docs, net, carry=tuple(docs.columns), score_col=score).where(F.col(score) < REJECT).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    rows = jaccard.near_duplicates(docs, "doc_id", "text")
    stays = rows.where(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    kept = docs.join(stays, "doc_id", "left_semi").select(*docs.columns)
    repeated = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    once = kept.join(repeated, "doc_id", "left_anti")
    first = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(first).unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of the benchmark."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets replaced by their kind."""
    return secrets.redact(docs, "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every document's tokens."""
    pieces = packing.token_pieces(docs, "doc_id", "text", limit=1024, end_id=2)
    return packing.pack(pieces, limit=1024).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]
#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
