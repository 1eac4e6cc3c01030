"""A corpus pipeline in five stages, each one operator of ``ratingloom.llm`` over all rows it is given.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.  ``run``
applies them to ``documents``, each stage written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm.bpe import encode_documents
from ratingloom.llm.common import Scratch, read_table
from ratingloom.llm.decontamination import decontaminate
from ratingloom.llm.line_dedup import dedup_lines
from ratingloom.llm.near_dedup import drop_near_duplicates
from ratingloom.llm.toxicity import fit_toxicity, score_toxicity

TOXIC = 0.5


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` made to fit the text again, where the column is there."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``TOXIC`` or more go; the model is fitted on labelled rows of ``docs``."""
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).filter(F.col("score") < TOXIC).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows go; a document of which nothing is left stays, empty."""
    return _recounted(dedup_lines(docs).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; documents that are mostly such passages go."""
    return _recounted(decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and digest of what they decode to."""
    return encode_documents(docs.select("doc_id", "text"), digest=True).drop("text")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe),
]

#: No SQL states a fitted model or byte-pair merges; tests hold the stages against
#: their operators, and the operators against brute force, the tokenizers library or held-out rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
