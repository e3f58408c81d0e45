"""Helpers shared by the operators: tables, intermediate tables, null ids, power-of-two sizing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A null doc_id takes part in comparisons as the largest id and is given back as null.
NULL_ID = (1 << 63) - 1

#: The characters of ``[\x20\x09-\x0D]``.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lineage cut that outlives executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_in() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def id_out(c: Column) -> Column:
    return F.when(c != NULL_ID, c)


def first_of_copies(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of ``docs`` named by ``keep`` (id, th), one for each: repeated rows with equal id and text count once.

    ``th`` is xxhash64 of the text (null for a null text), so that rows which share a doc_id but not the text
    stay apart.
    """
    from pyspark.sql import Window

    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), id_in().alias("_id"), F.xxhash64("text").alias("_th"))
    k = keep.select(F.col("id").alias("_id"), F.col("th").alias("_th")).distinct()
    hit = d.join(k, ["_id", "_th"], "left_semi")
    first = F.row_number().over(Window.partitionBy("_id", "_th").orderBy(F.to_json("_row")))
    return hit.withColumn("_n", first).where("_n = 1").select("_row.*")
