"""Streaming page-log split (P1, P13, T8; stream form of L2): one query, five sinks and the dirty records."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.envelope import dirty_split
from ..operators.logs import LOG_SCHEMA, split_logs
from .jobs import fix_is_new

#: A mid without records for this long (processing time) is met as a new one.
FORGET_MS = 90 * 86_400_000


def repaired(raw: DataFrame) -> DataFrame:
    """Raw records (offset, value) -> (offset, value, is_new, dirty): the new-visitor flag repaired by keyed state;
    dirty records pass beside it, outside of any state."""
    ok, dirty = dirty_split(raw)
    rows = ok.select("offset", "value", F.get_json_object("value", "$.common.mid").alias("mid"),
                     F.get_json_object("value", "$.ts").cast("long").alias("ts"),
                     F.get_json_object("value", "$.common.is_new").alias("is_new"))
    fixed = fix_is_new(rows, ["offset", "value", "mid", "ts"], FORGET_MS)
    return (fixed.select("offset", "value", "is_new", F.lit(False).alias("dirty"))
            .unionByName(dirty.select("offset", "value", F.lit(None).cast("string").alias("is_new"),
                                      F.lit(True).alias("dirty"))))


def split_sinks(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: each sink gets one folder per micro-batch id, overwritten by a retry of that batch, so a
    replay neither loses nor doubles rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            logs = (batch.where(~F.col("dirty"))
                    .select("offset", "is_new", F.from_json("value", LOG_SCHEMA).alias("r"))
                    .select("offset", "r.*", "is_new")
                    .withColumn("common", F.col("common").withField("is_new", F.col("is_new"))).drop("is_new"))
            sinks = {**split_logs(logs), "dirty": batch.where("dirty").select("offset", "value")}
            for name, df in sinks.items():
                df.write.mode("overwrite").parquet(os.path.join(path, name, f"batch={batch_id}"))
        finally:
            batch.unpersist()
    return write
