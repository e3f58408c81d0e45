"""DWD trade facts (L3-L9): demultiplex the change topic and join the facts.

All joins are equi-joins on order / detail ids: Spark shuffles both sides on
the key (or AQE broadcasts a side that turns out small at runtime). The only
forced broadcast is the fixed-size appraise dictionary. Each function takes the
whole change topic; Catalyst folds the ``source['table']`` filters so every
branch scans only its own table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import millis_str_to_date
from ..operators.envelope import cdc_demux, project_after

DETAIL_COLS = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
               "activity_rule_id", "coupon_id", "date_id", "create_time", "sku_num",
               "split_original_amount", "split_activity_amount", "split_coupon_amount",
               "split_total_amount", "ts_ms"]


# Each side of a join is one projection, used by the batch plans here and by the stream joins
# (``streaming.joins``); every side carries its own record time.

def detail_side(env: DataFrame, *extra: str) -> DataFrame:
    return env.select(
        *[F.col("after")[k].alias(k) for k in
          ("id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num",
           "split_total_amount", "split_activity_amount", "split_coupon_amount")],
        (F.col("after")["sku_num"].cast("decimal(16,2)") * F.col("after")["order_price"].cast("decimal(16,2)"))
        .cast("string").alias("split_original_amount"),
        "ts_ms", *extra)


def _side(env: DataFrame, ts: str, fields: dict[str, str]) -> DataFrame:
    return env.select(*[F.col("after")[k].alias(out) for out, k in fields.items()], F.col("ts_ms").alias(ts))


def order_side(env: DataFrame) -> DataFrame:
    return _side(env, "oi_ts", {"oi_id": "id", "user_id": "user_id", "province_id": "province_id"})


def activity_side(env: DataFrame) -> DataFrame:
    return _side(env, "act_ts", {"act_detail_id": "order_detail_id", "activity_id": "activity_id",
                                 "activity_rule_id": "activity_rule_id"})


def coupon_side(env: DataFrame) -> DataFrame:
    return _side(env, "cou_ts", {"cou_detail_id": "order_detail_id", "coupon_id": "coupon_id"})


def cancel_side(env: DataFrame) -> DataFrame:
    return _side(env, "oc_ts", {"oc_id": "id", "cancel_time": "operate_time"})


def payment_side(env: DataFrame) -> DataFrame:
    return _side(env, "pi_ts", {"pi_order_id": "order_id", "payment_type_code": "payment_type",
                                "callback_time": "callback_time"})


def refund_side(env: DataFrame) -> DataFrame:
    return project_after(env, ["id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
                               "refund_reason_type", "refund_reason_txt", "create_time"])


def refund_order_side(env: DataFrame) -> DataFrame:
    return _side(env, "oi_ts", {"oi_id": "id", "oi_user_id": "user_id", "province_id": "province_id"})


def refund_payment_side(env: DataFrame) -> DataFrame:
    return project_after(env, ["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"])


def refund_slip_side(env: DataFrame) -> DataFrame:
    return _side(env, "ori_ts", {"ori_order_id": "order_id", "ori_sku_id": "sku_id", "refund_num": "refund_num"})


# P6 status predicates over the after image; a null status never passes

def is_cancelled() -> Column:
    return F.col("after")["order_status"].isin("1001", "1003")


def is_paid() -> Column:
    return F.col("after")["payment_status"] == "1602"


def is_refunding() -> Column:
    return F.col("after")["order_status"] == "1006"


def is_refund_paid() -> Column:
    return F.col("after")["refund_status"] == "1602"


def is_refund_accepted() -> Column:
    return F.col("after")["refund_status"] == "0705"


def detail_shape(j: DataFrame, tz: str, *extra: str) -> DataFrame:
    return j.select(*[millis_str_to_date(F.col("create_time"), tz).alias("date_id") if c == "date_id" else F.col(c)
                      for c in DETAIL_COLS], *extra)


def cancel_shape(j: DataFrame) -> DataFrame:
    cols = [c if c != "create_time" else "cancel_time" for c in DETAIL_COLS if c != "ts_ms"]
    return j.select(*cols, F.col("oc_ts").alias("ts_ms"))


def payment_shape(j: DataFrame) -> DataFrame:
    return j.select(F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name",
                    "province_id", "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
                    "callback_time", "sku_num", "split_original_amount", "split_activity_amount",
                    "split_coupon_amount", F.col("split_total_amount").alias("split_payment_amount"),
                    F.col("pi_ts").alias("ts_ms"))


def refund_shape(j: DataFrame, tz: str) -> DataFrame:
    return j.select("id", "user_id", "order_id", "sku_id", "province_id",
                    millis_str_to_date(F.col("create_time"), tz).alias("date_id"), "create_time",
                    F.col("refund_type").alias("refund_type_code"),
                    F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_txt",
                    "refund_num", "refund_amount", "ts_ms")


def refund_pay_shape(j: DataFrame, tz: str) -> DataFrame:
    return j.select("id", F.col("oi_user_id").alias("user_id"), "order_id", "sku_id", "province_id",
                    F.col("payment_type").alias("payment_type_code"),
                    millis_str_to_date(F.col("callback_time"), tz).alias("date_id"), "callback_time",
                    "refund_num", F.col("total_amount").alias("refund_amount"), "ts_ms")


def _orders_of(details: DataFrame, oi: DataFrame) -> DataFrame:
    """(detail id, its order, that order's columns), a row for each of the order's: two texts a detail cross a shuffle by
    order id, its versions only once."""
    pairs = (details.select(F.col("id").alias("p_id"), F.col("order_id").alias("p_order"))
             .where(F.col("p_id").isNotNull() & F.col("p_order").isNotNull()).repartition("p_order").distinct())
    return (pairs.join(oi, F.col("p_order") == F.col("oi_id"), "inner")
            .select("p_id", "p_order", F.col("user_id").alias("p_user"), F.col("province_id").alias("p_province")))


def _by_detail(od: DataFrame, oi: DataFrame, act: DataFrame, cou: DataFrame) -> DataFrame:
    """The joins of L5 with the details shuffled once, by detail id: their orders are brought to them. Details without
    an id, which no id brings anything to, are joined to their order first."""
    none = F.lit(None).cast("string")
    bare = od.where(F.col("id").isNull()).join(oi, F.col("order_id") == F.col("oi_id"), "inner")
    whole = (od.where(F.col("id").isNotNull()).withColumn("user_id", none).withColumn("province_id", none)
             .unionByName(bare.select(*od.columns, "user_id", "province_id")))
    # ranges, since two equal columns would be keys of the join, and all its keys those of one more shuffle
    own = ((F.col("id") == F.col("p_id")) & (F.col("order_id") >= F.col("p_order")) & (F.col("order_id") <= F.col("p_order")))
    j = (whole.join(act, F.col("id") == F.col("act_detail_id"), "left").join(cou, F.col("id") == F.col("cou_detail_id"), "left")
         .join(_orders_of(od, oi), own, "left").where(F.col("p_id").isNotNull() | F.col("id").isNull()))
    pick = {"user_id": "p_user", "province_id": "p_province"}
    return j.select(*[F.when(F.col("id").isNull(), F.col(c)).otherwise(F.col(pick[c])).alias(c) if c in pick else F.col(c)
                      for c in j.columns])


def order_detail(topic: DataFrame, tz: str = "UTC", keep_seq: bool = False, by_order: bool = False,
                 by_detail: bool = False) -> DataFrame:
    """order_detail ⋈ order_info ⟕ activity ⟕ coupon (snapshot rows).

    ``keep_seq`` carries the arrival position for downstream version handling. ``by_order`` joins the orders last (the
    joins commute), so that the rows lie by order id for a further join on it; else they lie by detail id. ``by_detail``
    reads the details twice and ships their rows once instead of twice.
    """
    seq = ("seq",) if keep_seq else ()
    od = detail_side(cdc_demux(topic, "order_detail", "r"), *seq)
    oi = order_side(cdc_demux(topic, "order_info", "r"))
    act = activity_side(cdc_demux(topic, "order_detail_activity", "r"))
    cou = coupon_side(cdc_demux(topic, "order_detail_coupon", "r"))
    if by_detail:
        return detail_shape(_by_detail(od, oi, act, cou), tz, *seq)
    of_order, of_act, of_cou = ((oi, od.order_id == oi.oi_id, "inner"), (act, od.id == act.act_detail_id, "left"),
                                (cou, od.id == cou.cou_detail_id, "left"))
    j = od
    for side in (of_act, of_cou, of_order) if by_order else (of_order, of_act, of_cou):
        j = j.join(*side)
    return detail_shape(j, tz, *seq)


def order_cancel(topic: DataFrame, detail: DataFrame, tz: str = "UTC", literal: bool = False) -> DataFrame:
    """Order detail ⋈ cancelled/refunded orders (status 1001/1003).

    ``literal=True`` reproduces the as-built precedence
    ``table AND op AND s='1001' OR s='1003'`` (any table's 1003 passes).
    """
    status = F.col("after")["order_status"]
    is_order = (F.col("source")["table"] == "order_info") & (F.col("op") == "r")
    cond = (is_order & (status == "1001")) | (status == "1003") if literal else is_order & is_cancelled()
    oc = cancel_side(topic.where(cond))
    return cancel_shape(detail.drop("ts_ms").join(oc, detail.order_id == oc.oc_id, "inner"))


def pay_success(topic: DataFrame, detail: DataFrame) -> DataFrame:
    """Successful payments (status 1602) ⋈ order detail."""
    pi = payment_side(cdc_demux(topic, "payment_info", "r").where(is_paid()))
    return payment_shape(pi.join(detail.drop("ts_ms"), pi.pi_order_id == detail.order_id, "inner"))


def order_refund(topic: DataFrame, tz: str = "UTC") -> DataFrame:
    """Refund slips ⋈ orders in refund status 1006."""
    ri = refund_side(cdc_demux(topic, "order_refund_info", "r"))
    oi = refund_order_side(cdc_demux(topic, "order_info", "r").where(is_refunding()))
    return refund_shape(ri.join(oi, ri.order_id == oi.oi_id, "inner"), tz)


def refund_pay_success(topic: DataFrame, tz: str = "UTC") -> DataFrame:
    """Refund payments (1602) ⋈ refund slips (0705) on (order, sku) ⋈ orders (1006)."""
    rp = refund_payment_side(cdc_demux(topic, "refund_payment", "r").where(is_refund_paid()))
    ori = refund_slip_side(cdc_demux(topic, "order_refund_info", "r").where(is_refund_accepted()))
    oi = refund_order_side(cdc_demux(topic, "order_info", "r").where(is_refunding()))
    j = (rp.join(ori, (rp.order_id == ori.ori_order_id) & (rp.sku_id == ori.ori_sku_id), "inner")
         .join(oi, rp.order_id == oi.oi_id, "inner"))
    return refund_pay_shape(j, tz)


def cart_add(topic: DataFrame, delta: bool = False) -> DataFrame:
    """L4: cart additions.

    As built only snapshot rows pass and ``sku_num`` is the row's quantity.
    ``delta=True`` adds updates that raise the quantity, with the increase.
    """
    cart = cdc_demux(topic, "cart_info")
    a, b = F.col("after"), F.col("before")
    if delta:
        grew = (F.col("op") == "u") & b["sku_num"].isNotNull() & (a["sku_num"].cast("int") > b["sku_num"].cast("int"))
        cart = cart.where((F.col("op") == "r") | grew)
        num = F.when(F.col("op") == "r", a["sku_num"]).otherwise(
            (a["sku_num"].cast("int") - b["sku_num"].cast("int")).cast("string"))
    else:
        cart = cart.where(F.col("op") == "r")
        num = a["sku_num"]
    return cart.select(a["id"].alias("id"), a["user_id"].alias("user_id"), a["sku_id"].alias("sku_id"),
                       num.alias("sku_num"), "ts_ms")


def comment_info(topic: DataFrame, dic: DataFrame) -> DataFrame:
    """L3: comments ⋈ appraise dictionary (fixed-size dim, broadcast)."""
    c = project_after(cdc_demux(topic, "comment_info", "r"),
                      ["id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"])
    j = c.join(F.broadcast(dic), c.appraise == dic.dic_code, "inner")
    return j.select("id", "user_id", "sku_id", "appraise", F.col("dic_name").alias("appraise_name"),
                    "comment_txt", "ts_ms")
