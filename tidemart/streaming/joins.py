"""Stream-stream joins of the DWD facts (J1, J2, J3, T5; stream forms of L5-L9).

Each side of a join holds its rows for ``BOUND_MS`` of event time, as the reference's jobs keep joined state for
30 minutes and 5 seconds: a pair joins when its two record times lie at most that far apart, and the watermark then
releases the state. A left row without a partner is emitted with nulls once the watermark has passed its bound.

A branch with no records would hold the common watermark (the least of all sides) back. So heartbeat records
(op ``h``, no image), which a change capture sends on an idle topic, pass every branch: they carry time, and get keys
that name the branch's own table, so that they join nothing. (Catalyst moves a branch's filters, and the null tests of
an inner join's keys, below its watermark; so heartbeats must pass those filters and have keys.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins as ij
from ..plans import dwd

BOUND_MS = 1_805_000
HEARTBEAT = "h"
JOIN_KEYS = ("id", "order_id", "order_detail_id", "sku_id")


def heartbeat(topic: DataFrame, ts_ms: int) -> DataFrame:
    """One heartbeat record in the columns of ``topic``."""
    vals = {"op": F.lit(HEARTBEAT), "ts_ms": F.lit(ts_ms).cast("long")}
    return topic.sparkSession.range(1).select(
        *[vals.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in topic.schema])


def branch(topic: DataFrame, tbl: str, cond: Column | None = None) -> DataFrame:
    """P4 on a stream: snapshot records of ``tbl`` that meet ``cond``, and heartbeats."""
    own = (F.col("source")["table"] == tbl) & (F.col("op") == "r")
    beat = F.col("op") == HEARTBEAT
    keys = F.create_map(*[F.lit(x) for k in JOIN_KEYS for x in (k, f"~{tbl}")])
    return (topic.where(beat | (own if cond is None else own & cond))
            .withColumn("after", F.when(beat, keys).otherwise(F.col("after"))))


def timed(df: DataFrame, ts: str, et: str, delay: str) -> DataFrame:
    """Event time ``et`` from epoch millis, with its watermark."""
    return df.withColumn(et, F.timestamp_millis(F.col(ts))).withWatermark(et, delay)


def join_within(left: DataFrame, right: DataFrame, on: Column, left_et: str, right_et: str, how: str = "inner",
                bound_ms: int = BOUND_MS) -> DataFrame:
    """Equi-join of two streams whose event times differ by at most ``bound_ms``; the result's event time is
    the left one. ``how``: inner or left."""
    if how not in ("inner", "left"):
        raise ValueError(f"join_within: how={how!r}")
    gap = f"INTERVAL '{bound_ms / 1000:.3f}' SECOND"  # a literal: the state's release time is derived from it
    near = F.expr(f"{right_et} >= {left_et} - {gap} AND {right_et} <= {left_et} + {gap}")
    return left.join(right, on & near, how).drop(right_et)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str, right_ts: str,
                  lower_ms: int, upper_ms: int, delay: str = "0 seconds") -> DataFrame:
    """J5/J6 stream (inner): the batch operator's time buckets spread a hot key over its time span, and the same
    bounds on event times release the state."""
    j = ij.interval_join(timed(left, left_ts, "_let", delay), timed(right, right_ts, "_ret", delay), left_key,
                         right_key, left_ts, right_ts, lower_ms, upper_ms)
    near = (f"_ret >= _let + INTERVAL '{lower_ms / 1000:.3f}' SECOND"
            f" AND _ret <= _let + INTERVAL '{upper_ms / 1000:.3f}' SECOND")
    return j.where(F.expr(near)).drop("_let", "_ret")


def _detail(topic: DataFrame, delay: str, bound_ms: int) -> DataFrame:
    od = timed(dwd.detail_side(branch(topic, "order_detail")), "ts_ms", "od_et", delay)
    oi = timed(dwd.order_side(branch(topic, "order_info")), "oi_ts", "oi_et", delay)
    act = timed(dwd.activity_side(branch(topic, "order_detail_activity")), "act_ts", "act_et", delay)
    cou = timed(dwd.coupon_side(branch(topic, "order_detail_coupon")), "cou_ts", "cou_et", delay)
    j = join_within(od, oi, F.col("order_id") == F.col("oi_id"), "od_et", "oi_et", "inner", bound_ms)
    j = join_within(j, act, F.col("id") == F.col("act_detail_id"), "od_et", "act_et", "left", bound_ms)
    return join_within(j, cou, F.col("id") == F.col("cou_detail_id"), "od_et", "cou_et", "left", bound_ms)


def order_detail(topic: DataFrame, tz: str = "UTC", delay: str = "0 seconds", bound_ms: int = BOUND_MS) -> DataFrame:
    """L5 stream: order_detail ⋈ order_info ⟕ activity ⟕ coupon."""
    return dwd.detail_shape(_detail(topic, delay, bound_ms), tz)


def order_cancel(topic: DataFrame, tz: str = "UTC", delay: str = "0 seconds", bound_ms: int = BOUND_MS) -> DataFrame:
    """L6 stream: order detail ⋈ cancelled orders."""
    detail = dwd.detail_shape(_detail(topic, delay, bound_ms), tz, "od_et").drop("ts_ms")
    oc = timed(dwd.cancel_side(branch(topic, "order_info", dwd.is_cancelled())), "oc_ts", "oc_et", delay)
    return dwd.cancel_shape(join_within(detail, oc, F.col("order_id") == F.col("oc_id"), "od_et", "oc_et", "inner",
                                        bound_ms))


def pay_success(topic: DataFrame, tz: str = "UTC", delay: str = "0 seconds", bound_ms: int = BOUND_MS) -> DataFrame:
    """L7 stream: successful payments ⋈ order detail."""
    detail = dwd.detail_shape(_detail(topic, delay, bound_ms), tz, "od_et").drop("ts_ms")
    pi = timed(dwd.payment_side(branch(topic, "payment_info", dwd.is_paid())), "pi_ts", "pi_et", delay)
    return dwd.payment_shape(join_within(detail, pi, F.col("order_id") == F.col("pi_order_id"), "od_et", "pi_et",
                                         "inner", bound_ms))


def order_refund(topic: DataFrame, tz: str = "UTC", delay: str = "0 seconds", bound_ms: int = BOUND_MS) -> DataFrame:
    """L8 stream: refund slips ⋈ orders in refund."""
    ri = timed(dwd.refund_side(branch(topic, "order_refund_info")), "ts_ms", "ri_et", delay)
    oi = timed(dwd.refund_order_side(branch(topic, "order_info", dwd.is_refunding())), "oi_ts", "oi_et", delay)
    return dwd.refund_shape(join_within(ri, oi, F.col("order_id") == F.col("oi_id"), "ri_et", "oi_et", "inner",
                                        bound_ms), tz)


def refund_pay_success(topic: DataFrame, tz: str = "UTC", delay: str = "0 seconds",
                       bound_ms: int = BOUND_MS) -> DataFrame:
    """L9 stream: refund payments ⋈ accepted refund slips on (order, sku) ⋈ orders in refund."""
    rp = timed(dwd.refund_payment_side(branch(topic, "refund_payment", dwd.is_refund_paid())), "ts_ms", "rp_et", delay)
    ori = timed(dwd.refund_slip_side(branch(topic, "order_refund_info", dwd.is_refund_accepted())), "ori_ts",
                "ori_et", delay)
    oi = timed(dwd.refund_order_side(branch(topic, "order_info", dwd.is_refunding())), "oi_ts", "oi_et", delay)
    j = join_within(rp, ori, (F.col("order_id") == F.col("ori_order_id")) & (F.col("sku_id") == F.col("ori_sku_id")),
                    "rp_et", "ori_et", "inner", bound_ms)
    return dwd.refund_pay_shape(join_within(j, oi, F.col("order_id") == F.col("oi_id"), "rp_et", "oi_et", "inner",
                                            bound_ms), tz)
