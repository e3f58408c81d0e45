"""Streaming DWS windows (A1-A6, A11, T6-T10, W4; stream forms of L10-L13, L15, L16).

A keyed processor (first of day, flag repair, returning user) hands its rows on with their event time, and a tumbling
window counts them in append mode: a window comes out once the watermark has passed its end. Heartbeats advance the
watermark of an idle topic (see ``joins``); they carry a key of their own and lie in a window that never closes before
the next one. Times cross the processors as wall clocks of the session's zone, which ``runners.stream_conf`` sets to
UTC for every stream. All state ends: by the watermark in the windows, by timers in the processors (T6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from ..functions.scalars import empty_or_null
from ..operators import dims as D
from ..operators.windows import label_columns, width_ms
from ..plans.dws import MONEY, SKU_AMOUNTS, sku_names
from . import processors as P
from .joins import branch, timed

BEAT_MID = "~heartbeat"
#: A visitor or user without records for this long is met as a new one.
FORGET_MS = 90 * P.DAY_MS
#: How long a version of an order detail can be taken back (as in the reference, there in processing time).
VERSION_MS = 10_000


def log_heartbeat(ts_ms: int) -> str:
    """A page-log record that carries time only."""
    return f'{{"common":{{"mid":"{BEAT_MID}"}},"page":{{}},"ts":{ts_ms}}}'


def _keyed(ev: DataFrame, keys: list[str], processor: StatefulProcessor, columns: list[str],
           extra: tuple[str, ...] = ()) -> DataFrame:
    schema = StructType([ev.schema[c] for c in columns] + [StructField("et", TimestampType())]
                        + [StructField(c, LongType()) for c in extra])
    return P.apply(ev, keys, processor, schema, time_mode="EventTime", event_time_column="et")


def _windowed(ev: DataFrame, width, tz: str, keys: list[str], **sums: Column) -> DataFrame:
    agg = (ev.groupBy(F.window("et", f"{width_ms(width)} milliseconds"), *keys)
           .agg(*[F.sum(c).cast("long").alias(n) for n, c in sums.items()])
           .withColumn("wstart", F.unix_millis(F.col("window.start"))))
    return agg.select(*label_columns(width, tz), *keys, *sums)


def cart_uu(topic: DataFrame, width="2 seconds", tz: str = "UTC", delay: str = "0 seconds") -> DataFrame:
    """L10 stream: users whose first cart add of the day falls in each window."""
    cart = branch(topic, "cart_info").select(F.col("after")["user_id"].alias("user_id"),
                                             F.col("after")["id"].alias("id"), "ts_ms")
    cols = ["user_id", "ts_ms", "et"]
    firsts = _keyed(timed(cart, "ts_ms", "et", delay), ["user_id"],
                    P.FirstOfDay("ts_ms", ["ts_ms", "id"], cols, timers=True), cols[:2])
    return _windowed(firsts, width, tz, [], cart_add_uu_ct=F.lit(1))


def _is_beat() -> Column:
    return F.col("common.mid") == BEAT_MID


def home_detail_uv(page: DataFrame, width="10 seconds", tz: str = "UTC", delay: str = "0 seconds") -> DataFrame:
    """L13 stream: first home / good_detail visit of each mid and day, counted per window."""
    p = page.where(F.col("page.page_id").isin("home", "good_detail") | _is_beat()).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts", "offset")
    cols = ["mid", "page_id", "ts", "et"]
    firsts = _keyed(timed(p, "ts", "et", delay), ["mid", "page_id"],
                    P.FirstOfDay("ts", ["ts", "offset"], cols, timers=True), cols[:3])
    return _windowed(firsts, width, tz, [],
                     home_uv_ct=F.when(F.col("page_id") == "home", 1).otherwise(0),
                     good_detail_uv_ct=F.when(F.col("page_id") == "good_detail", 1).otherwise(0))


def traffic_dims(logs: DataFrame, width="10 seconds", tz: str = "UTC", delay: str = "0 seconds",
                 forget_ms: int | None = FORGET_MS) -> DataFrame:
    """L15 stream over all parsed logs (start records fix the new-visitor flag too): flag repair, page records,
    first of day, then uv / sv / pv / duration per (window, vc, ch, ar, is_new)."""
    rows = logs.select(
        *[F.col(f"common.{c}").alias(c) for c in ("mid", "vc", "ch", "ar", "is_new")],
        F.when(F.col("start").isNull(), 1).otherwise(0).alias("is_page"),
        F.when(empty_or_null(F.col("page.last_page_id")), 1).otherwise(0).alias("sv"),
        F.coalesce(F.col("page.during_time"), F.lit(0)).cast("long").alias("dur"), "ts", "offset")
    cols = ["mid", "vc", "ch", "ar", "is_page", "sv", "dur", "ts", "offset"]
    ev = timed(rows, "ts", "et", delay)
    fixed = P.apply(ev, ["mid"], P.FixIsNew([*cols, "et"], idle_ms=forget_ms),
                    StructType([ev.schema[c] for c in cols] + [StructField("et", TimestampType()),
                                                               ev.schema["is_new"]]),
                    time_mode="EventTime", event_time_column="et")
    keep = ["vc", "ch", "ar", "is_new", "sv", "dur", "ts"]
    flagged = _keyed(fixed.where(F.col("is_page") == 1), ["mid"],
                     P.FirstOfDay("ts", ["ts", "offset"], [*keep, "et"], flag=True, timers=True), keep,
                     ("first_flag",))
    return _windowed(flagged, width, tz, ["vc", "ch", "ar", "is_new"], uv_ct=F.col("first_flag"), sv_ct=F.col("sv"),
                     pv_ct=F.lit(1), dur_sum=F.col("dur"))


def user_login(page: DataFrame, width="10 seconds", tz: str = "UTC", delay: str = "0 seconds",
               back_days: int = 8, forget_ms: int | None = FORGET_MS) -> DataFrame:
    """L16 stream: one login per user and day, and users who return after ``back_days`` or more."""
    lp = F.col("page.last_page_id")
    login = ~empty_or_null(F.col("common.uid")) & ((lp == "login") | empty_or_null(lp))
    ev = timed(page.where(login | _is_beat()).select(F.col("common.uid").alias("uid"), "ts"), "ts", "et", delay)
    flagged = _keyed(ev, ["uid"], P.ReturningUser(back_days, forget_ms), ["uid", "ts"], ("back",))
    return _windowed(flagged, width, tz, [], back_ct=F.col("back"), uu_ct=F.lit(1))


ORDER_COLUMNS = ["id", "order_id", "province_id", "split_total_amount", "ts_ms", "seq"]


def province_order(detail: DataFrame, province: DataFrame, width="10 seconds", tz: str = "UTC",
                   delay: str = "0 seconds", keep_ms: int = VERSION_MS) -> DataFrame:
    """L11 stream over order detail versions in their order of ``seq``: a new version takes the one before back (A11),
    orders are counted once per (window, province) by keyed state (A4), amounts and counts summed per window, and the
    province's name added after the sums. A retraction whose window has closed is late and dropped (Q8)."""
    w = width_ms(width)
    ev = timed(detail.select(*[F.col(c).cast("string") if c != "ts_ms" else F.col(c) for c in ORDER_COLUMNS]), "ts_ms",
               "et", delay)
    versions = P.apply(ev, ["id"], P.RetractVersions("seq", ORDER_COLUMNS, "split_total_amount", "ts_ms", w, keep_ms),
                       ", ".join(f"{c} string" for c in ORDER_COLUMNS) + ", is_retraction boolean, et timestamp",
                       time_mode="EventTime", event_time_column="et")
    rows = versions.select("province_id", "order_id", "split_total_amount", "et")
    counted = _keyed(rows, ["province_id", "order_id"],
                     P.FirstInWindow(w, ["province_id", "split_total_amount", "et"]),
                     ["province_id", "split_total_amount"], ("first",))
    agg = (counted.groupBy(F.window("et", f"{w} milliseconds"), "province_id")
           .agg(F.sum("first").cast("long").alias("order_count"),
                F.sum(F.coalesce(F.col("split_total_amount").cast("decimal(16,2)"), F.lit(0))).cast(MONEY)
                .alias("order_amount"))
           .withColumn("wstart", F.unix_millis(F.col("window.start"))).where(F.col("province_id") != f"~{BEAT_MID}"))
    out = D.enrich(agg, province, "province_id", "id", {"province_name": "name"}, small=True)
    return out.select(*label_columns(width, tz), "province_id", "province_name", "order_count", "order_amount")


def detail_heartbeat(detail: DataFrame, ts_ms: int) -> DataFrame:
    """A record in the columns of the order detail topic that carries time only."""
    vals = {c: F.lit(f"~{BEAT_MID}") for c in ("id", "order_id", "province_id", "sku_id", "seq")}
    vals["ts_ms"] = F.lit(ts_ms).cast("long")
    return detail.sparkSession.range(1).select(
        *[vals.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in detail.schema])


SKU_COLUMNS = ["id", "sku_id", *SKU_AMOUNTS.values(), "ts_ms", "seq"]


def waited_versions(detail: DataFrame, wait_ms: int = 5000, delay: str = "0 seconds",
                    processing: bool = False) -> DataFrame:
    """T10 stream: the latest version of each detail id ``wait_ms`` after its first one, with the moment its timer was
    set for as ``et``. The clock is the record time, or with ``processing`` the machine's."""
    rows = detail.select(*[F.col(c).cast("string") if c != "ts_ms" else F.col(c) for c in SKU_COLUMNS])
    schema = ", ".join(f"{c} string" for c in SKU_COLUMNS) + ", et timestamp"
    processor = P.LatestAfterWait("ts_ms", "seq", SKU_COLUMNS, wait_ms, processing, stamped=True)
    if processing:
        return P.apply(rows, ["id"], processor, schema, time_mode="ProcessingTime")
    return P.apply(timed(rows, "ts_ms", "_et", delay), ["id"], processor, schema, time_mode="EventTime",
                   event_time_column="et")


def sku_order(detail: DataFrame, dims: dict[str, DataFrame], width="10 seconds", tz: str = "UTC", wait_ms: int = 5000,
              delay: str = "0 seconds") -> DataFrame:
    """L12 stream: the latest version of each detail after the wait (T10), summed in windows of the moment at which it
    left the wait (W4: the clock that drives the timers drives the windows), then the names of the sku."""
    latest = waited_versions(detail, wait_ms, delay)
    agg = (latest.groupBy(F.window("et", f"{width_ms(width)} milliseconds"), "sku_id")
           .agg(*[F.sum(F.coalesce(F.col(src).cast("decimal(18,4)"), F.lit(0))).cast("decimal(22,4)").alias(dst)
                  for dst, src in SKU_AMOUNTS.items()])
           .withColumn("wstart", F.unix_millis(F.col("window.start"))).where(F.col("sku_id") != f"~{BEAT_MID}"))
    return sku_names(agg, dims["sku"], dims["spu"], dims["tm"], dims["c3"], dims["c2"], dims["c1"], width, tz)


def sku_order_by_clock(detail: DataFrame, width="10 seconds", wait_ms: int = 5000) -> DataFrame:
    """L12 stream up to the sums, on the machine's clock as in the reference (W4): a sum per (window, sku) comes out when
    a processing-time timer at the window's end fires. (wstart, sku_id, amounts)."""
    latest = waited_versions(detail, wait_ms, processing=True)
    amounts = list(SKU_AMOUNTS.values())
    sums = P.apply(latest.select("sku_id", *amounts), ["sku_id"], P.ClockWindowSums(width_ms(width), amounts),
                   "wstart long, sku_id string, " + ", ".join(f"{a} decimal(22,4)" for a in SKU_AMOUNTS),
                   time_mode="ProcessingTime")
    return sums
