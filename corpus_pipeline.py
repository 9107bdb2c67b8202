"""A corpus pipeline: quality rules, language, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept and returns
a DataFrame; all but the last return the columns of documents. run() writes each stage's result as
Parquet in the shared folder and reads it again for the next.

Defined results: a NULL or empty text fails the quality rules. A NULL or repeated doc_id is kept; rows
are told apart by their place. Further columns, also those named as what a stage computes, come out as
they came in. Empty tables give no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabq.llm import jaccard, langid, packing, pii, quality
from tabq.llm.common import fold, numbered, read, shared_folder, stored
from tabq.session import configure

#: Share of a text's n-grams that its language must contain.
LEAST_LANGUAGE = 0.3


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    configure(spark)  # the stage's code is wide
    trusted = read(spark, sf_dir, "labels").where(F.col("quality") == 1).select("doc_id")
    made = [*quality.COUNTS, "base_failed", "score", "kept"]
    aside = {c: unused(docs, f"__own_{c}") for c in docs.columns if c in made}
    own = docs.withColumnsRenamed(aside)
    judged = quality.judge(own, quality.learn(own, trusted))
    # stored with all its columns: a filter on the plan would repeat the expressions it is made of
    return stored(judged.select(*own.columns, *made)).where("kept").select(
        [F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the filter knows; a missing lang is filled in."""
    model = langid.learn(docs.where(fold("doc_id", 5) != 0))
    lang, score = unused(docs, "__lang"), unused(docs, "__score")
    found = langid.predict(docs, model, lang_pred=lang, score=score)
    kept = found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE))
    return kept.withColumn("lang", F.coalesce("lang", lang)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: the one with the smallest id. Rows are told
    apart by their place, so documents without an id or with the same id are too, and have the same
    number in both reads, also when executors that were lost change the split of the files."""
    row = unused(docs, "__row")
    rows = numbered(docs, row)
    found = jaccard.join(rows, doc_id=row).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("__id").isNull().alias("none"), "__id", F.col(row).alias("row"))
    first = found.join(rows.select(row, F.col("doc_id").alias("__id")), row).groupBy(
        "component_id").agg(F.min(order).alias("first")).select(F.col("first.row").alias(row))
    return rows.join(first, row, "left_semi").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    clean = pii.redact(docs, pii.learn(docs))
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: No stage but the counts of the first can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over documents."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
