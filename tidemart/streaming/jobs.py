"""Streaming forms of the pipelines ([S] keys): the same operators on an
unbounded input, with watermarks bounding window and join state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..operators.text import tokenize
from . import processors as P


def _schema(df: DataFrame, cols: list[str], extra: list[StructField] = ()) -> StructType:
    return StructType([df.schema[c] for c in cols] + list(extra))


def first_of_day(df: DataFrame, key: str, ts: str, order: list[str], columns: list[str],
                 flag: bool = False, ttl_ms: int | None = None) -> DataFrame:
    """T7 stream: per key, first record of each day (or all records + first_flag).
    ``ttl_ms`` (processing time) bounds idle-key state as the reference's 1-day TTL."""
    extra = [StructField("first_flag", LongType())] if flag else []
    return P.apply(df, [key], P.FirstOfDay(ts, order, columns, flag, ttl_ms=ttl_ms), _schema(df, columns, extra),
                   time_mode="ProcessingTime" if ttl_ms else "None")


def strictly_newer(df: DataFrame, key: str, ts: str, seq: str, columns: list[str],
                   ttl_ms: int | None = None) -> DataFrame:
    """T12 stream; a key is forgotten ``ttl_ms`` of processing time after its last row (1 day by ts_ms, 1 h by
    create_time in the reference)."""
    return P.apply(df, [key], P.StrictlyNewer(ts, seq, columns, ttl_ms), _schema(df, columns),
                   time_mode="ProcessingTime" if ttl_ms else "None")


def retract_versions(df: DataFrame, key: str, seq: str, columns: list[str], amount: str) -> DataFrame:
    """A11 stream (all columns carried as text)."""
    schema = StructType([StructField(c, StringType()) for c in columns] + [StructField("is_retraction", BooleanType())])
    return P.apply(df.select(*[F.col(c).cast("string") for c in columns]), [key],
                   P.RetractVersions(seq, columns, amount), schema)


def latest_after_wait(df: DataFrame, key: str, ts: str, seq: str, columns: list[str], wait_ms: int = 5000,
                      watermark: str = "0 seconds", processing: bool = False) -> DataFrame:
    """T10 stream: latest version emitted when the event-time timer fires, or with ``processing`` the timer of the
    machine's clock."""
    if processing:
        schema = StructType([StructField(c, StringType()) for c in columns])
        return P.apply(df.select(*[F.col(c).cast("string") for c in columns]), [key],
                       P.LatestAfterWait(ts, seq, columns, wait_ms, processing=True), schema, time_mode="ProcessingTime")
    ev = df.withColumn("_et", F.timestamp_millis(F.col(ts))).withWatermark("_et", watermark)
    schema = StructType([StructField(c, StringType()) for c in columns])
    return P.apply(ev.select("_et", *[F.col(c).cast("string").alias(c) if c != ts else F.col(c) for c in columns]),
                   [key], P.LatestAfterWait(ts, seq, columns, wait_ms), schema, time_mode="EventTime")


def fix_is_new(flat: DataFrame, columns: list[str], ttl_ms: int | None = None) -> DataFrame:
    """T8 stream over flat page rows (mid, ts, offset, is_new, ...); emits
    ``columns`` plus the repaired ``is_new``. No record is dropped as late, so state ends by ``ttl_ms`` of processing
    time after a mid's last record (``run_available_now`` and ``replay`` end such a query with its data)."""
    cols = [c for c in columns if c != "is_new"]
    return P.apply(flat, ["mid"], P.FixIsNew(cols, ttl_ms), _schema(flat, cols + ["is_new"]),
                   time_mode="ProcessingTime" if ttl_ms else "None")


def running_profile(rows: DataFrame) -> DataFrame:
    """A8/A9 stream over (uid, ts, os, ch, md, ba, search_item) and, to order equal times, offset."""
    schema = ("uid string, ts_ms long, pv long, os string, ch string, md string, ba string, search_item string")
    order = [c for c in ("ts", "offset") if c in rows.columns]
    return P.apply(rows, ["uid"], P.RunningProfile(order), schema)


def keyword_counts(search_rows: DataFrame, width: str, watermark: str = "0 seconds") -> DataFrame:
    """L14 stream: tokens counted per event-time window; append mode emits a
    window once the watermark passes its end (late rows are dropped, T16)."""
    ev = (search_rows.withColumn("et", F.timestamp_millis(F.col("ts"))).withWatermark("et", watermark)
          .withColumn("keyword", F.explode(tokenize(F.col("fullword")))))
    return (ev.groupBy(F.window("et", width), "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
            .select(F.unix_millis(F.col("window.start")).alias("wstart"), "keyword", "keyword_count"))


def window_counts(rows: DataFrame, ts: str, width: str, watermark: str = "0 seconds") -> DataFrame:
    """Generic tumbling-window count in append mode (T1/T16 behaviour)."""
    ev = rows.withColumn("et", F.timestamp_millis(F.col(ts))).withWatermark("et", watermark)
    return (ev.groupBy(F.window("et", width)).agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_millis(F.col("window.start")).alias("wstart"), "n"))
