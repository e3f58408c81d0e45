"""Streaming comment facts (L3, J4): the change topic's comments joined to a dictionary that changes meanwhile."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.envelope import image
from ..plans import dwd
from .runners import Pinned, UpsertTable

DIC_KEYS = ["dic_code"]


def dictionary_changes(topic: DataFrame, tbl: str = "base_dic") -> DataFrame:
    """Change records of the dictionary -> (dic_code, dic_name, op, seq)."""
    own = topic.where(F.col("source")["table"] == tbl)
    row = image(own, "nonempty")
    return own.select(row["dic_code"].alias("dic_code"), row["dic_name"].alias("dic_name"), "op", "seq")


def keep_dictionary(table: UpsertTable) -> Callable[[DataFrame, int], None]:
    """foreachBatch body of the dictionary's change topic; a deleted code stays as a row with op ``d``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge_batch(dictionary_changes(batch), batch_id)
    return write


def comment_facts(dictionary: Pinned) -> Callable[[str], Callable[[DataFrame, int], None]]:
    """Sink of the comment topic: each micro-batch is joined to the dictionary of that moment (inner, as in the
    reference: a comment whose code is not there yet, or no more, is left out) and written to a folder of its own, which
    a retry overwrites with the same rows. ``dic_version`` tells the version used."""
    def sink(path: str) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            dic = dictionary.at(spark, batch_id)
            if dic is None:
                dic = spark.createDataFrame([], "dic_code string, dic_name string, op string")
            known = dic.where("op <> 'd'").select("dic_code", "dic_name")
            facts = dwd.comment_info(batch, known)
            (facts.withColumn("dic_version", F.lit(dictionary.version(spark, batch_id)))
             .write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}")))
        return write
    return sink
