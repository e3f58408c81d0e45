"""Training-corpus pipeline: quality rules, exact and near duplicates, personal data, packing.

``STAGES`` are (name, function); each takes (spark, docs, sf_dir) and is written as Parquet and read again as the
next one's documents. ``run`` applies them to the table documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import exact_dedup, minhash, packing, pii, quality
from tidemart.llm.common import DOC_COLUMNS, saved, table, work_dir


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, a missing one as null; further columns of an input go no further."""
    kinds = dict(zip(DOC_COLUMNS, ("long", "string", "string", "string", "long")))
    return docs.select(*[(F.col(c) if c in docs.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in DOC_COLUMNS])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(_documents(docs), table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(_documents(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(_documents(docs), k=5, threshold=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: SQL cannot express the classifier or the tokenizer; a test compares run() on a small table without labels, so without
#: the classifier, with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), work_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
