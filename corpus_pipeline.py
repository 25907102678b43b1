"""The training-data pipeline over ``documents``.

Quality classifier, line de-duplication, near-duplicate removal, benchmark
decontamination, packing. Every stage works on all rows that its predecessor
kept, and all but the last return the columns of ``documents``; each result is
written as Parquet and read again as the next one's input.

Null and empty texts: the classifier scores them like others; if kept, they pass
the other stages and get a packing row without a bin. Repeated rows of one id
are kept or dropped together. Further columns of ``documents`` are not passed on.
An empty table gives an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readerflow.llm import op1_quality_fm, op3_line_dedup, op7_packing, op8_decontaminate, op10_near_dedup
from readerflow.llm.common import table
from readerflow.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    docs = docs.select(*COLUMNS)
    machine = op1_quality_fm.fit(docs, table(spark, sf_dir, "labels"), metadata=("n_chars",))
    return op1_quality_fm.keep_good(docs, machine, MIN_QUALITY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows the text."""
    kept = op3_line_dedup.dedup_lines(docs.select(*COLUMNS), keep=("lang", "source"))
    return kept.select("doc_id", "text", "lang", "source", F.char_length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    docs = docs.select(*COLUMNS)
    gone = op10_near_dedup.near_components(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return op8_decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document and its place in a bin."""
    return op7_packing.pack_documents(docs.select(*COLUMNS))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

# A trained classifier, signatures and automata are beyond SQL: tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to the packing rows."""
    root, docs = scratch_path(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{root}/{k}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
