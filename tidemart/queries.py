"""

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (or data Spark derives from them).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as sc
from .functions import weights as W
from .operators import dedup as dd
from .operators import dims as D
from .operators import envelope as env_ops
from .operators import joins as ij
from .operators import logs as lg
from .operators import text as tx
from .plans import dwd, dws
from .plans import comments as cm
from .plans import dimbuild as db
from .plans import labels as lb
from .plans import tags as tg
from .sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def _topic(spark, sf_dir, *tables):
    return fx.topic_db(spark, sf_dir, tables or None)


# ---------------------------------------------------------------- DWD

@query("dwd_order_detail")
def q_dwd_order_detail(spark, sf_dir):
    return dwd.order_detail(_topic(spark, sf_dir), by_detail=True)


@query("dwd_order_cancel")
def q_dwd_order_cancel(spark, sf_dir):
    t = _topic(spark, sf_dir)
    return dwd.order_cancel(t, dwd.order_detail(t, by_order=True))


@query("dwd_pay_success")
def q_dwd_pay_success(spark, sf_dir):
    t = _topic(spark, sf_dir)
    return dwd.pay_success(t, dwd.order_detail(t, by_order=True))


@query("dwd_order_refund")
def q_dwd_order_refund(spark, sf_dir):
    return dwd.order_refund(_topic(spark, sf_dir))


@query("dwd_refund_pay_success")
def q_dwd_refund_pay_success(spark, sf_dir):
    return dwd.refund_pay_success(_topic(spark, sf_dir))


@query("dwd_cart_add")
def q_dwd_cart_add(spark, sf_dir):
    return dwd.cart_add(_topic(spark, sf_dir))


@query("dwd_cart_add_delta")
def q_dwd_cart_add_delta(spark, sf_dir):
    return dwd.cart_add(_topic(spark, sf_dir), delta=True)


@query("dwd_comment_info")
def q_dwd_comment_info(spark, sf_dir):
    return dwd.comment_info(_topic(spark, sf_dir), fx.base_dic(spark))


# ---------------------------------------------------------------- keyed state

def _detail_versions(spark, sf_dir):
    env = fx.order_detail_env(spark, sf_dir)
    a = F.col("after")
    return env.select(a["id"].alias("id"), a["order_id"].alias("order_id"), a["sku_id"].alias("sku_id"),
                      a["create_time"].cast("long").alias("create_time"),
                      a["split_total_amount"].alias("split_total_amount"), "ts_ms", "seq")


@query("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    v = _detail_versions(spark, sf_dir)
    return dd.dedup_latest(v, "id", "ts_ms", "seq").drop("seq", "create_time")


@query("dedup_strictly_newer")
def q_dedup_strictly_newer(spark, sf_dir):
    v = _detail_versions(spark, sf_dir)
    return dd.strictly_newer(v, "id", "create_time", "seq", chunk=dd.arrival_chunk("seq")) \
        .select("id", "sku_id", "create_time", "seq")


@query("dedup_composite")
def q_dedup_composite(spark, sf_dir):
    v = _detail_versions(spark, sf_dir)
    return dd.dedup_composite(v, ["order_id", "ts_ms"], "seq").select("order_id", "ts_ms", "id", "sku_id", "seq")


@query("dedup_first_of_day")
def q_dedup_first_of_day(spark, sf_dir):
    cart = dwd.cart_add(_topic(spark, sf_dir, "cart_info"))
    day = sc.ms_to_date_str(F.col("ts_ms"))
    return dd.first_of_day(cart, "user_id", day, ["ts_ms", "id"]).withColumn("day", day)


@query("order_retraction")
def q_order_retraction(spark, sf_dir):
    t = _topic(spark, sf_dir)
    d = dwd.order_detail(t, keep_seq=True).select("id", "order_id", "split_total_amount", "ts_ms", "seq")
    return dd.retract_versions(d, "id", "seq", ["split_total_amount"]).withColumnRenamed("_retract", "is_retraction")


@query("upsert_latest")
def q_upsert_latest(spark, sf_dir):
    t = _topic(spark, sf_dir)
    return dd.upsert_latest(dwd.order_detail(t, keep_seq=True, by_detail=True), "id", "seq").drop("seq")


# ---------------------------------------------------------------- dims

def _dims(spark, sf_dir):
    return dict(sku=fx.sku_info(spark, sf_dir), spu=fx.spu_info(spark, sf_dir), tm=fx.base_trademark(spark, sf_dir),
                c3=fx.base_category3(spark, sf_dir), c2=fx.base_category2(spark, sf_dir),
                c1=fx.base_category1(spark))


@query("dim_category_tree")
def q_dim_category_tree(spark, sf_dir):
    d = _dims(spark, sf_dir)
    return D.category_tree(d["c3"], d["c2"], d["c1"])


@query("dim_sku_wide")
def q_dim_sku_wide(spark, sf_dir):
    d = _dims(spark, sf_dir)
    return D.sku_wide(d["sku"], d["spu"], d["tm"])


@query("dim_category_cascade")
def q_dim_category_cascade(spark, sf_dir):
    d = _dims(spark, sf_dir)
    return D.category_cascade(d["sku"].select("id", "category3_id"), "category3_id", d["c3"], d["c2"], d["c1"])


# ---------------------------------------------------------------- DWS trade

@query("dws_province_order")
def q_dws_province_order(spark, sf_dir):
    t = _topic(spark, sf_dir)
    return dws.province_order(dwd.order_detail(t, keep_seq=True), fx.province_dim(spark, sf_dir), "10 seconds")


@query("dws_sku_order")
def q_dws_sku_order(spark, sf_dir):
    t = _topic(spark, sf_dir)
    d = _dims(spark, sf_dir)
    return dws.sku_order(dwd.order_detail(t, keep_seq=True, by_detail=True), d["sku"], d["spu"], d["tm"], d["c3"], d["c2"], d["c1"],
                         "10 seconds")


@query("dws_cart_uu")
def q_dws_cart_uu(spark, sf_dir):
    return dws.cart_uu(dwd.cart_add(_topic(spark, sf_dir, "cart_info")), EVENT_WINDOW)


@query("rollup_province_amount")
def q_rollup_province_amount(spark, sf_dir):
    return dws.rollup_province_amount(q_dws_province_order(spark, sf_dir))


# ---------------------------------------------------------------- page logs

EVENT_WINDOW = "1 hour"   # events are minutes apart in the test data; the width is a parameter


def _logs(spark, sf_dir, fix: bool = True):
    parsed, _ = lg.parse_logs(fx.page_log_topic(spark, sf_dir))
    return lg.repair_is_new(parsed) if fix else parsed


def _pages(spark, sf_dir):
    return lg.split_logs(_logs(spark, sf_dir))["page"]


def _flat_common(df):
    return [F.col(f"common.{c}").alias(c) for c in ("mid", "uid", "vc", "ch", "ar", "is_new", "os", "md", "ba", "sid")]


@query("log_dirty_split")
def q_log_dirty_split(spark, sf_dir):
    _, dirty = lg.parse_logs(fx.page_log_topic(spark, sf_dir))
    return dirty.select("offset")


@query("log_fix_is_new")
def q_log_fix_is_new(spark, sf_dir):
    return _logs(spark, sf_dir).select("offset", F.col("common.mid").alias("mid"), "ts",
                                       F.col("common.is_new").alias("is_new"))


@query("log_split_page")
def q_log_split_page(spark, sf_dir):
    p = lg.split_logs(_logs(spark, sf_dir))["page"]
    return p.select("offset", *_flat_common(p), "page.*", "ts")


@query("log_split_start")
def q_log_split_start(spark, sf_dir):
    s = lg.split_logs(_logs(spark, sf_dir))["start"]
    return s.select("offset", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    "start.*", "ts", F.size(F.coalesce("displays", F.array())).alias("n_displays"))


@query("log_split_err")
def q_log_split_err(spark, sf_dir):
    e = lg.split_logs(_logs(spark, sf_dir))["err"]
    return e.select("offset", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                    F.col("start").isNotNull().alias("has_start"), "err.*", "ts")


@query("log_split_err_only")
def q_log_split_err_only(spark, sf_dir):
    e = lg.split_logs(_logs(spark, sf_dir), err_only=True)["err"]
    return e.select("offset", "err.*", "ts")


@query("log_split_display")
def q_log_split_display(spark, sf_dir):
    d = lg.split_logs(_logs(spark, sf_dir))["display"]
    return d.select("offset", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                    F.col("display.item").alias("display_item"), F.col("display.pos_id").alias("pos_id"),
                    F.col("display.order").alias("display_order"), "ts")


@query("log_split_action")
def q_log_split_action(spark, sf_dir):
    a = lg.split_logs(_logs(spark, sf_dir))["action"]
    return a.select("offset", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                    F.col("action.action_id").alias("action_id"), F.col("action.item").alias("action_item"),
                    F.col("action.ts").alias("action_ts"))


@query("dws_home_detail_uv")
def q_dws_home_detail_uv(spark, sf_dir):
    return dws.home_detail_uv(_pages(spark, sf_dir), EVENT_WINDOW)


@query("dws_traffic_dims")
def q_dws_traffic_dims(spark, sf_dir):
    return dws.traffic_dims(_pages(spark, sf_dir), EVENT_WINDOW)


@query("dws_user_login")
def q_dws_user_login(spark, sf_dir):
    return dws.user_login(_pages(spark, sf_dir), EVENT_WINDOW)


@query("rollup_uv_by_channel")
def q_rollup_uv_by_channel(spark, sf_dir):
    return dws.rollup_uv_by_channel(q_dws_traffic_dims(spark, sf_dir))


# ---------------------------------------------------------------- envelopes

@query("cdc_parse")
def q_cdc_parse(spark, sf_dir):
    raw = env_ops.envelope_to_json(_topic(spark, sf_dir))
    env = env_ops.parse_cdc(raw)
    return env.select(F.col("source")["table"].alias("source_table"), "op", "ts_ms",
                      F.col("after")["id"].alias("id"), F.size("after").alias("n_after"),
                      F.coalesce(F.size("before"), F.lit(0)).alias("n_before"))


@query("cdc_gate")
def q_cdc_gate(spark, sf_dir):
    g = env_ops.cdc_gate(fx.mixed_feed(spark, sf_dir), fx.DB)
    return g.select(F.col("after")["s_suppkey"].alias("id"), "op")


@query("cdc_gate_deletes")
def q_cdc_gate_deletes(spark, sf_dir):
    g = env_ops.cdc_gate(fx.mixed_feed(spark, sf_dir), fx.DB, accept_deletes=True)
    return g.select(env_ops.image(g)["s_suppkey"].alias("id"), "op")


@query("cdc_demux")
def q_cdc_demux(spark, sf_dir):
    p = env_ops.cdc_demux(_topic(spark, sf_dir), "payment_info")
    return env_ops.project_after(p, ["id", "order_id", "payment_status"])


@query("cdc_image")
def q_cdc_image(spark, sf_dir):
    f = fx.mixed_feed(spark, sf_dir)
    a = f.select(env_ops.image(f, "op").alias("img"), "op")
    b = env_ops.flatten_image(f, ["s_suppkey", "s_name"], variant="nonempty")
    return (a.select(F.col("img")["s_suppkey"].alias("id"), F.col("img")["s_name"].alias("name_by_op"), "op")
            .join(b.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name_nonempty"), "ts_ms"), "id"))


ODS_KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
            "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}


@query("ods_snapshot_envelope")
def q_ods_snapshot_envelope(spark, sf_dir):
    """Every row and column of the shop's tables as snapshot records of one topic."""
    def records(tbl, key):
        env = env_ops.snapshot_to_envelope(fx.table(spark, sf_dir, tbl), fx.DB, tbl)
        return env.select(F.col("source")["db"].alias("db"), F.col("source")["table"].alias("tbl"), "op",
                          F.col("after")[key].alias("id"), F.size("after").alias("n_fields"),
                          F.size(F.map_filter("after", lambda _, v: v.isNotNull())).alias("n_set"))
    return functools.reduce(DataFrame.unionByName, [records(t, k) for t, k in ODS_KEYS.items()])


@query("event_time_pick")
def q_event_time_pick(spark, sf_dir):
    cdc = env_ops.envelope_to_json(_topic(spark, sf_dir)).select(
        F.lit("cdc").alias("src"), F.get_json_object("value", "$.after.id").alias("id"), "value")
    logs = fx.page_log_topic(spark, sf_dir).select(F.lit("log").alias("src"), F.col("offset").cast("string")
                                                   .alias("id"), "value")
    return env_ops.event_time_pick(cdc.unionByName(logs)).drop("value")


# ---------------------------------------------------------------- scalar functions

AS_OF = "2025-05-12"   # age reference date of the reference's sample rows; a parameter


def _orders_ms(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    (sc.epoch_ms(F.col("o_orderdate")) + (F.col("o_orderkey") % 24) * fx.HOUR_MS).alias("ms"))


@query("fn_datetime")
def q_fn_datetime(spark, sf_dir):
    o = _orders_ms(spark, sf_dir)
    o = o.select("id", "ms", sc.ms_to_date_str("ms").alias("date_id"), sc.ms_to_datetime_str("ms").alias("dt"),
                 sc.ms_to_compact_date("ms").alias("ds"),
                 sc.millis_str_to_date(F.col("ms").cast("string")).alias("date_from_str"))
    return o.select("*", sc.datetime_str_to_ms("dt").alias("dt_ms"), sc.date_str_to_ms("date_id").alias("d_ms"),
                    sc.ms_to_datetime_str("ms", "Asia/Shanghai").alias("dt_shanghai"))


@query("fn_birthday")
def q_fn_birthday(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    b = sc.epoch_day_to_date((F.col("c_custkey") * 13) % 16000)
    as_of = F.lit(AS_OF).cast("date")
    return c.select(F.col("c_custkey").alias("id"), F.date_format(b, "yyyy-MM-dd").alias("birthday"),
                    sc.decade(b).alias("decade"), sc.age_years(b, as_of).alias("age"),
                    sc.zodiac(b).alias("zodiac_sign"), sc.zodiac(b, english=True).alias("zodiac_en"))


@query("fn_time_slot")
def q_fn_time_slot(spark, sf_dir):
    o = _orders_ms(spark, sf_dir)
    return o.select("id", F.hour(sc.ms_to_wall("ms")).alias("hour"), sc.time_slot("ms").alias("pay_time_slot"))


@query("fn_string")
def q_fn_string(spark, sf_dir):
    cv = fx.table(spark, sf_dir, "conversations")
    return cv.select(F.col("conv_id").alias("id"), F.col("turn"),
                     sc.last_token(F.col("text"), ",").alias("last_tok"),
                     sc.first_token(F.col("text"), " ").alias("first_word"),
                     sc.md5_key(F.col("conv_id")).alias("row_key"),
                     sc.composite_key(F.col("conv_id"), F.col("turn"), sep="_").alias("order_ts"),
                     sc.negate_str(F.col("turn").cast("string")).alias("neg_turn"),
                     sc.empty_or_null(F.regexp_replace("text", r"\S", "")).alias("no_space"))


@query("fn_to_json")
def q_fn_to_json(spark, sf_dir):
    uu = q_dws_cart_uu(spark, sf_dir)
    bean = uu.select("stt", "edt", F.col("cur_date").alias("curDate"),
                     F.col("cart_add_uu_ct").alias("cartAddUuCt"), F.lit(0).alias("ts"))
    return bean.select(sc.to_json_snake(bean.columns, hidden=("ts",)).alias("json"))


# ---------------------------------------------------------------- user labels

def _as_of():
    return F.lit(AS_OF).cast("date")


def _tree(spark, sf_dir):
    d = _dims(spark, sf_dir)
    return D.category_tree(d["c3"], d["c2"], d["c1"])


@query("label_user_flatten")
def q_label_user_flatten(spark, sf_dir):
    return lb.user_flat(_topic(spark, sf_dir, "user_info"), _as_of())


@query("label_name_clean")
def q_label_name_clean(spark, sf_dir):
    return lb.name_clean(lb.user_flat(_topic(spark, sf_dir, "user_info"), _as_of())).select("uid", "uname")


@query("label_base6")
def q_label_base6(spark, sf_dir):
    return lb.base6(_topic(spark, sf_dir, "user_info", "user_info_sup_msg"), _as_of())


@query("label_user_join")
def q_label_user_join(spark, sf_dir):
    t = _topic(spark, sf_dir, "user_info", "user_info_sup_msg")
    j = ij.interval_join(lb.user_flat(t, _as_of()), lb.user_sup_flat(t), "uid", "sup_uid", "ts_ms", "sup_ts_ms",
                         -5 * lb.MIN, 5 * lb.MIN)
    return j.select("uid", "ts_ms", "sup_ts_ms", "height", "weight")


@query("label_order_flatten")
def q_label_order_flatten(spark, sf_dir):
    return lb.order_flat(_topic(spark, sf_dir, "order_info"))


@query("label_order_detail_join")
def q_label_order_detail_join(spark, sf_dir):
    return lb.order_detail_join(_topic(spark, sf_dir, "order_info", "order_detail"))


@query("label_base4")
def q_label_base4(spark, sf_dir):
    d = _dims(spark, sf_dir)
    return lb.base4(spark, _topic(spark, sf_dir, "order_info", "order_detail"), D.sku_wide(d["sku"], d["spu"], d["tm"]),
                    _tree(spark, sf_dir))


@query("label_device_flatten")
def q_label_device_flatten(spark, sf_dir):
    d = lg.device_search_flatten(_pages(spark, sf_dir))
    return d.select("uid", "ts", *_device_cols(), "search_item")


def _device_cols():
    return [F.col(f"deviceInfo.{c}").alias("dev_uid" if c == "uid" else c)
            for c in ("ar", "ba", "ch", "md", "os", "uid", "vc")]


@query("dedup_exact")
def q_dedup_exact(spark, sf_dir):
    d = lg.device_search_flatten(_pages(spark, sf_dir))
    day = sc.ms_to_date_str(F.col("ts"))
    return dd.dedup_exact(d.select("uid", day.alias("day"), *_device_cols(), "search_item"))


@query("dedup_exact_stream")
def q_dedup_exact_stream(spark, sf_dir):
    """T13 [S]: page records as they arrive; one of those that agree in everything but the time within a day."""
    from .streaming import dedup as SX

    def build(logs):
        d = lg.device_search_flatten(lg.split_logs(logs)["page"])
        rows = d.select("uid", sc.ms_to_date_str(F.col("ts")).alias("day"), *_device_cols(), "search_item", "ts")
        day = 86_400_000
        return SX.exact(rows, "ts", [c for c in rows.columns if c != "ts"], until=F.col("ts") - F.pmod("ts", F.lit(day)) + day)
    return _log_stream(spark, sf_dir, "dedup_exact", build, beat=False)


@query("dedup_composite_stream")
def q_dedup_composite_stream(spark, sf_dir):
    """T14 [S], exact form, over every order detail version."""
    from .streaming import dedup as SX
    from .streaming import runners as R
    cols = ["order_id", "ts_ms", "id", "sku_id", "seq"]
    v = _detail_versions(spark, sf_dir).select(*cols)
    lo, hi = v.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    mid = ((lo or 0) + (hi or 0)) // 2
    return R.replay(spark, [_lines(v.where(F.col("ts_ms") <= mid)), _lines(v.where(F.col("ts_ms") > mid))],
                    lambda raw: SX.first_arrival(_records(raw, v.schema), ["order_id", "ts_ms"], "seq", "ts_ms", cols),
                    "dedup_composite")


@query("label_running_profile")
def q_label_running_profile(spark, sf_dir):
    return lb.running_profile_records(lb.device_rows(_pages(spark, sf_dir), keep_offset=True))


@query("label_profile_2min")
def q_label_profile_2min(spark, sf_dir):
    return lb.running_profile(lb.device_rows(_pages(spark, sf_dir)), "2 minutes")


@query("label_base2")
def q_label_base2(spark, sf_dir):
    return lb.base2(spark, _pages(spark, sf_dir), _tree(spark, sf_dir), fx.category_compare(spark))


@query("label_device_score")
def q_label_device_score(spark, sf_dir):
    d = lg.device_search_flatten(_pages(spark, sf_dir)).select("uid", "ts", F.col("deviceInfo.os").alias("judge_os"))
    return W.score(d, spark, "device", F.col("judge_os"))


@query("label_search_score")
def q_label_search_score(spark, sf_dir):
    p = _pages(spark, sf_dir).where(F.col("page.item_type") == "keyword") \
        .select("offset", F.col("page.item").alias("search_item"))
    tr = _tree(spark, sf_dir).select(F.col("b3name").alias("_b3"), F.col("b1name").alias("b1_category"))
    p = p.join(tr, p.search_item == tr._b3, "left").drop("_b3")
    cmp = fx.category_compare(spark).select(F.col("category_name").alias("_cn"), "search_category")
    p = p.join(F.broadcast(cmp), p.b1_category == cmp._cn, "left").drop("_cn") \
        .withColumn("search_category", F.coalesce("search_category", F.lit("unknown")))
    return W.score(p, spark, "search", F.col("search_category"))


@query("label_time_score")
def q_label_time_score(spark, sf_dir):
    o = lb.order_flat(_topic(spark, sf_dir, "order_info")).select("id", "create_time", "pay_time_slot")
    return W.score(o, spark, "pay_time", F.col("pay_time_slot"))


@query("label_amount_score")
def q_label_amount_score(spark, sf_dir):
    o = lb.order_flat(_topic(spark, sf_dir, "order_info")).select("id", "total_amount")
    return W.score(o.withColumn("amount_class", W.amount_class(F.col("total_amount"))), spark, "amount",
                   F.col("amount_class"))


@query("label_brand_score")
def q_label_brand_score(spark, sf_dir):
    d = _dims(spark, sf_dir)
    s = D.sku_wide(d["sku"], d["spu"], d["tm"]).select("skuid", "tname")
    return W.score(s, spark, "tname", F.col("tname"), ~sc.empty_or_null(F.col("tname")))


@query("label_category_score")
def q_label_category_score(spark, sf_dir):
    t = _tree(spark, sf_dir).select("id", "b1name")
    return W.score(t, spark, "b1name", F.col("b1name"), ~sc.empty_or_null(F.col("b1name")))


def _b24(spark, sf_dir):
    b2 = q_label_base2(spark, sf_dir)
    b4 = q_label_base4(spark, sf_dir)
    return lb.merge_2_4(b2, b4)


@query("label_merge_2_4_6")
def q_label_merge_2_4_6(spark, sf_dir):
    m = lb.merge_2_4_6(_b24(spark, sf_dir), q_label_base6(spark, sf_dir))
    return m.select("uid", "base2_ts_ms", "detail_id", "ts_ms", "base6_ts_ms", "pv", "judge_os", "search_category",
                    "pay_time_slot", "tname", "b1_name", "gender", "age", "zodiac_sign")


MERGED = ["uid", "base2_ts_ms", "detail_id", "ts_ms", "base6_ts_ms", "pv", "judge_os", "search_category", "pay_time_slot",
          "tname", "b1_name", "gender", "age", "zodiac_sign"]


@query("label_merge_stream")
def q_label_merge_stream(spark, sf_dir):
    """L22/J6 [S]: the three label topics in two halves by record time (a large half in several parts), merged as they
    arrive."""
    from .streaming import labels as SL
    from .streaming import runners as R
    b2, b4, b6 = q_label_base2(spark, sf_dir), q_label_base4(spark, sf_dir), q_label_base6(spark, sf_dir)
    topics = {"base2": b2.select("uid", "ts_ms", "pv", "judge_os", "search_category"),
              "base4": b4.select("uid", "ts_ms", "detail_id", "pay_time_slot", "tname", "b1_name"),
              "base6": b6.select("uid", "ts_ms", "gender", "age", "zodiac_sign")}
    path = _scratch(spark, "label_topics")
    for name, df in topics.items():
        df.write.parquet(f"{path}/{name}")
    topics = {n: spark.read.schema(df.schema).parquet(f"{path}/{n}") for n, df in topics.items()}
    whole = functools.reduce(DataFrame.unionByName, [SL.records(df, n, "ts_ms") for n, df in topics.items()])
    parts, hi = R.arrivals(whole, "label_merge")
    beat = functools.reduce(DataFrame.unionByName, [SL.records(SL.heartbeat(df, n, hi + 7 * 86_400_000), n) for n, df in topics.items()])
    phases = [*[p.select("value") for p in parts], beat]
    return R.replay(spark, phases, lambda raw: SL.merge(*[SL.branch(raw, n, df.schema) for n, df in topics.items()]).select(*MERGED),
                    "label_merge")


@query("label_age_band")
def q_label_age_band(spark, sf_dir):
    return lb.age_band(_b24(spark, sf_dir))


# ---------------------------------------------------------------- keywords, comments

def _search_pages(spark, sf_dir):
    """Search result pages with a keyword."""
    p = _pages(spark, sf_dir)
    return p.where((F.col("page.last_page_id") == "search") & (F.col("page.item_type") == "keyword")
                   & F.col("page.item").isNotNull()).select("offset", "ts", F.col("page.item").alias("fullword"))


@query("keyword_tokenize")
def q_keyword_tokenize(spark, sf_dir):
    return tx.explode_tokens(_search_pages(spark, sf_dir), "fullword").select("offset", "fullword", "keyword")


@query("keyword_segment")
def q_keyword_segment(spark, sf_dir):
    """U1 with a dictionary: sku titles, brand and category run together as shops write them, cut by the names that the
    trademark and category tables hold."""
    d = _dims(spark, sf_dir)
    brand, kind = d["tm"].select("id", "tm_name"), _tree(spark, sf_dir).select(F.col("id").alias("c3"), "b1name")
    sku = D.enrich(d["sku"], brand, "tm_id", "id", {"tm_name": "tm_name"})
    sku = D.enrich(sku, kind, "category3_id", "c3", {"b1name": "b1name"})
    title = sku.select(F.col("id").alias("sku_id"), F.concat(F.coalesce("tm_name", F.lit("")), F.coalesce("b1name", F.lit("")), F.lit("专卖 "), "sku_name").alias("title"))
    words = brand.select(F.col("tm_name").alias("word")).union(d["c1"].select("name"))
    return tx.explode_segments(title, "title", words).select("sku_id", F.col("pos").cast("long").alias("pos"), "keyword")


@query("dws_keyword")
def q_dws_keyword(spark, sf_dir):
    return dws.keyword(tx.explode_tokens(_search_pages(spark, sf_dir), "fullword"), EVENT_WINDOW)


def _comment_topic(spark, sf_dir):
    return _topic(spark, sf_dir, "comment_info", "order_info")


@query("dim_enrich_default")
def q_dim_enrich_default(spark, sf_dir):
    e = cm.enrich_dic_default(_comment_topic(spark, sf_dir), fx.base_dic(spark))
    return e.select(F.col("after")["id"].alias("id"), F.col("after")["appraise"].alias("appraise"), "dic_name")


@query("comment_order_join")
def q_comment_order_join(spark, sf_dir):
    j = cm.comment_order_join(_comment_topic(spark, sf_dir), fx.base_dic(spark))
    return j.select("id", "order_id", "user_id", "appraise", "dic_name", "ts_ms", "info_id", "info_op",
                    "info_tm_ms", "info_consignee", "info_total_amount", "info_order_status")


@query("comment_wide")
def q_comment_wide(spark, sf_dir):
    w = cm.comment_wide(_comment_topic(spark, sf_dir), fx.base_dic(spark))
    return w.select("id", "order_id", "user_id", "sku_id", "spu_id", "appraise", "dic_name", "commentTxt", "create_time",
                    "ts_ms", "ds", "info_consignee", "info_tm_ms")


@query("comment_sensitive")
def q_comment_sensitive(spark, sf_dir):
    """L18 against a word list file that is not made of the comments."""
    path = _scratch(spark, "sensitive_words")
    fx.sensitive_word_file(spark, sf_dir, path)
    wide = cm.comment_wide(_comment_topic(spark, sf_dir), fx.base_dic(spark))
    return cm.sensitive_check(wide, tx.word_list(spark, path))


# ---------------------------------------------------------------- generic joins / lookups

@query("dim_point_lookup")
def q_dim_point_lookup(spark, sf_dir):
    keys = dwd.cart_add(_topic(spark, sf_dir, "cart_info")).select("id", "sku_id")
    sku = fx.sku_info(spark, sf_dir).select("id", "sku_name", "tm_id")
    return D.point_lookup(keys, "sku_id", sku, "id").drop("dim_id")


@query("dim_enrich_generic")
def q_dim_enrich_generic(spark, sf_dir):
    o = lb.order_flat(_topic(spark, sf_dir, "order_info")).select("id", F.col("province_id").cast("string")
                                                                   .alias("province_id"))
    return D.enrich(o, fx.province_dim(spark, sf_dir), "province_id", "id", {"province_name": "name"}, small=True)


@query("interval_join")
def q_interval_join(spark, sf_dir):
    """Purchases ⋈ the same user's views in the 6 hours before (inclusive)."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type",
                                                  sc.epoch_ms(F.col("ts")).alias("ms"))
    buy = ev.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("purchase_id"),
                                                             F.col("user_id").alias("uid"), F.col("ms").alias("buy_ms"))
    view = ev.where(F.col("event_type") == "view").select(F.col("event_id").alias("view_id"),
                                                          F.col("user_id").alias("v_uid"), F.col("ms").alias("view_ms"))
    j = ij.interval_join(buy, view, "uid", "v_uid", "buy_ms", "view_ms", -6 * 3_600_000, 0)
    return j.select("purchase_id", "view_id", "uid", (F.col("buy_ms") - F.col("view_ms")).alias("lag_ms"))


# ---------------------------------------------------------------- config-driven dims (L1: J13, P8, K6, K7, K10, S5)

def _dim_topic(spark, sf_dir):
    return _topic(spark, sf_dir).unionByName(fx.supplier_change_feed(spark, sf_dir))


def _routed(spark, sf_dir):
    t = _dim_topic(spark, sf_dir)
    gated = env_ops.cdc_gate(t, fx.DB, accept_deletes=True)
    return D.route(gated, D.latest_config(db.config_feed(t)))


def _kv(m):
    return F.array_join(F.sort_array(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="),
                                                                                      F.coalesce(e["value"], F.lit(""))))),
                        ";")


@query("dim_config_scan")
def q_dim_config_scan(spark, sf_dir):
    cfg = D.latest_config(db.config_feed(_dim_topic(spark, sf_dir))).drop("op", "seq")
    return cfg.toDF(*[sc.snake_to_camel(c) for c in cfg.columns])


@query("dim_table_plan")
def q_dim_table_plan(spark, sf_dir):
    return D.table_plan(db.config_feed(_dim_topic(spark, sf_dir)))


@query("dim_route")
def q_dim_route(spark, sf_dir):
    r = _routed(spark, sf_dir)
    return r.select("source_table", "sink_table", "op", "seq", F.col("data")[F.col("sink_row_key")].alias("row_key"),
                    F.size("data").alias("n_cols"))


@query("dim_column_prune")
def q_dim_column_prune(spark, sf_dir):
    r = _routed(spark, sf_dir)
    return r.select("sink_table", "seq", F.array_join(F.sort_array(F.map_keys("data")), ",").alias("columns"))


#: Columns of the wide dimension rows: a sink table has null where it lacks one.
WIDE = ["id", "uid", "user_id", "order_id", "sku_id", "payment_type", "s_name", "s_nationkey"]


@query("dim_upsert_merge")
def q_dim_upsert_merge(spark, sf_dir):
    return D.upsert_merge(_routed(spark, sf_dir), WIDE)


@query("dim_upsert_md5")
def q_dim_upsert_md5(spark, sf_dir):
    return D.upsert_md5(_routed(spark, sf_dir), WIDE)


@query("dim_build")
def q_dim_build(spark, sf_dir):
    t = _dim_topic(spark, sf_dir)
    out = db.dim_build(t, db.config_feed(t), fx.DB)
    return out.select("sink_table", "row_key", _kv(F.col("data")).alias("cells"))


@query("dim_build_stream")
def q_dim_build_stream(spark, sf_dir):
    """L1 [S]: the change topic as JSON lines in two halves by record time, merged batch by batch, read back. The config
    topic's snapshot is there before the first half; its updates and deletes arrive between the halves, so tables with
    an updated config hold the second half only, and those with a deleted one are gone."""
    from .streaming import dimbuild as SB
    from .streaming import runners as R
    t = _dim_topic(spark, sf_dir)
    base = _scratch(spark, "dim_build_stream")
    # the whole topic is read for the config's few rows: once
    db.config_feed(t).select(*SB.CONFIG_COLUMNS).write.parquet(f"{base}/feed")
    feed = spark.read.parquet(f"{base}/feed")
    config = R.UpsertTable(f"{base}/config", SB.CONFIG_KEYS, "seq", buckets=1)
    cells = R.UpsertTable(f"{base}/cells", SB.CELL_KEYS, "seq")
    changes = [_lines(feed.where("op = 'r'")), _lines(feed.where("op <> 'r'"))]

    def before(i):
        R.replay_path(spark, changes[i:i + 1], lambda raw: _records(raw, feed.schema), f"dim_config{i}",
                      lambda _: lambda batch, n: SB.keep_config(config, f"{base}/ddl")(batch, i))
    lo, hi = t.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    mid = ((lo or 0) + (hi or 0)) // 2
    R.replay_path(spark, [_lines(t.where(F.col("ts_ms") <= mid)), _lines(t.where(F.col("ts_ms") > mid))],
                  lambda raw: _records(raw, t.schema), "dim_build",
                  lambda _: SB.merge_into(cells, R.Pinned(config, f"{base}/pins"), fx.DB), before=before)
    rows = SB.dimension_rows(cells.read(spark), config.read(spark))
    return rows.select("sink_table", "row_key", _kv(F.col("data")).alias("cells"))


# ---------------------------------------------------------------- design-note tags

def _users(spark, sf_dir, as_of=None):
    return lb.user_flat(_topic(spark, sf_dir, "user_info"), as_of if as_of is not None else _as_of())


def _sup_readings(spark, sf_dir, what: str):
    s = lb.user_sup_flat(_topic(spark, sf_dir, "user_info_sup_msg"))
    return s.select(F.col("sup_uid").alias("user_id"), F.col(what).alias("value"),
                    F.col(f"unit_{what}").alias("unit"), F.lit("profile").alias("data_source"),
                    F.col("create_ts").alias("ts"))


@query("tag_age")
def q_tag_age(spark, sf_dir):
    return tg.tag_age(_users(spark, sf_dir), q_label_age_band(spark, sf_dir))


@query("tag_gender")
def q_tag_gender(spark, sf_dir):
    logs = lg.split_logs(_logs(spark, sf_dir))
    ev = tg.behaviour_events(logs["page"], logs["action"])
    d = _dims(spark, sf_dir)
    tree = D.category_tree(d["c3"], d["c2"], d["c1"])
    skc = (d["sku"].join(tree.select(F.col("id").alias("c3"), "b1name"),
                         F.col("category3_id") == F.col("c3")).select(F.col("id").alias("sku_id"), "b1name"))
    return tg.tag_gender(ev, skc)


@query("tag_weight")
def q_tag_weight(spark, sf_dir):
    return tg.tag_weight(_sup_readings(spark, sf_dir, "weight"))


@query("tag_height")
def q_tag_height(spark, sf_dir):
    return tg.tag_height(_sup_readings(spark, sf_dir, "height"))


@query("tag_zodiac")
def q_tag_zodiac(spark, sf_dir):
    return tg.tag_zodiac(_users(spark, sf_dir))


@query("tag_generation")
def q_tag_generation(spark, sf_dir):
    return tg.tag_generation(_users(spark, sf_dir))


@query("tag_update_log")
def q_tag_update_log(spark, sf_dir):
    """Age tags recomputed a year apart: users whose range changed."""
    old = _users(spark, sf_dir, F.lit("2024-05-12").cast("date")).select("uid", "age")
    new = _users(spark, sf_dir).select("uid", "age")

    def snap(u):
        return u.select(F.col("uid").alias("user_id"), tg.age_range(F.col("age")).alias("age_range"))
    return tg.tag_update_log(snap(old), snap(new), "age", "age_range")


@query("tag_behavior_summary")
def q_tag_behavior_summary(spark, sf_dir):
    logs = lg.split_logs(_logs(spark, sf_dir))
    t = _topic(spark, sf_dir, "cart_info", "comment_info")
    purchases = dwd.cart_add(t)
    comments = env_ops.project_after(env_ops.cdc_demux(t, "comment_info"), ["user_id", "create_time"]) \
        .withColumn("create_time", F.col("create_time").cast("long"))
    return tg.behavior_summary(logs["page"], logs["action"], purchases, comments)


# ---------------------------------------------------------------- sources, sinks, late data

def _scratch(spark, name):
    import uuid
    from .session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@query("src_file_stream")
def q_src_file_stream(spark, sf_dir):
    """S1 [S]: the change topic written as JSON lines, consumed as a file
    stream (several micro-batches), parsed and projected."""
    from .streaming import runners as R
    path = _scratch(spark, "topic_db")
    raw = env_ops.envelope_to_json(_topic(spark, sf_dir))
    R.write_jsonl(raw, path)
    files = len(spark.read.text(path).inputFiles())
    stream = spark.readStream.option("maxFilesPerTrigger", max(2, -(-files // 8))).text(path)
    env = env_ops.parse_cdc(stream)
    flat = env.select(F.col("source")["table"].alias("source_table"), F.col("after")["id"].alias("id"), "op",
                      F.size("after").alias("n_after"), "ts_ms")
    return R.run_available_now(flat, "src_file_stream")


def _lines(df):
    return df.select(F.to_json(F.struct("*")).alias("value"))


def _records(raw, schema):
    # behind a one-element explode, else each filter on a record parses it once more
    return raw.select(F.explode(F.array(F.from_json("value", schema))).alias("r")).select("r.*")


def _dwd_stream(spark, sf_dir, name, tables, build):
    """[S] form of a DWD job over the whole change topic of ``tables``: JSON records in two halves by record time (a
    large half in several parts), then a heartbeat beyond every bound, each drained before the next arrives."""
    from .streaming import joins as SJ
    from .streaming import runners as R
    topic = _topic(spark, sf_dir, *tables).drop("seq")
    parts, hi = R.arrivals(topic, name)
    parts.append(SJ.heartbeat(topic, hi + 10 * SJ.BOUND_MS))
    return R.replay(spark, [env_ops.envelope_to_json(p) for p in parts],
                    lambda raw: build(env_ops.parse_cdc(raw)), name)


DETAIL_TABLES = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")


@query("dwd_order_detail_stream")
def q_dwd_order_detail_stream(spark, sf_dir):
    from .streaming import joins as SJ
    return _dwd_stream(spark, sf_dir, "dwd_order_detail", DETAIL_TABLES, SJ.order_detail)


@query("dwd_order_cancel_stream")
def q_dwd_order_cancel_stream(spark, sf_dir):
    from .streaming import joins as SJ
    return _dwd_stream(spark, sf_dir, "dwd_order_cancel", DETAIL_TABLES, SJ.order_cancel)


@query("dwd_pay_success_stream")
def q_dwd_pay_success_stream(spark, sf_dir):
    from .streaming import joins as SJ
    return _dwd_stream(spark, sf_dir, "dwd_pay_success", (*DETAIL_TABLES, "payment_info"), SJ.pay_success)


@query("dwd_order_refund_stream")
def q_dwd_order_refund_stream(spark, sf_dir):
    from .streaming import joins as SJ
    return _dwd_stream(spark, sf_dir, "dwd_order_refund", ("order_refund_info", "order_info"), SJ.order_refund)


@query("dwd_refund_pay_success_stream")
def q_dwd_refund_pay_success_stream(spark, sf_dir):
    from .streaming import joins as SJ
    return _dwd_stream(spark, sf_dir, "dwd_refund_pay_success", ("refund_payment", "order_refund_info", "order_info"),
                       SJ.refund_pay_success)


@query("dwd_comment_info_stream")
def q_dwd_comment_info_stream(spark, sf_dir):
    """L3/J4 [S]: the comment topic in two halves by record time, each joined to the dictionary of its moment."""
    from .streaming import comments as SC
    from .streaming import runners as R
    base = _scratch(spark, "dwd_comment_stream")
    dic = R.UpsertTable(f"{base}/dic", SC.DIC_KEYS, "seq", buckets=1)
    codes = fx.base_dic(spark)
    own = env_ops.snapshot_to_envelope(codes, fx.DB, "base_dic").withColumn("seq", F.lit("1"))
    R.replay_path(spark, [_lines(own)], lambda raw: _records(raw, own.schema), "dic", lambda _: SC.keep_dictionary(dic))
    t = _topic(spark, sf_dir, "comment_info").drop("seq")
    lo, hi = t.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    mid = ((lo or 0) + (hi or 0)) // 2
    parts = [t.where(F.col("ts_ms") <= mid), t.where(F.col("ts_ms") > mid)]
    out = R.replay_path(spark, [env_ops.envelope_to_json(p) for p in parts], env_ops.parse_cdc, "dwd_comment",
                        SC.comment_facts(R.Pinned(dic, f"{base}/pins")))
    return spark.read.parquet(out).drop("batch", "dic_version")


@query("dws_cart_uu_stream")
def q_dws_cart_uu_stream(spark, sf_dir):
    from .streaming import dws as SD
    return _dwd_stream(spark, sf_dir, "dws_cart_uu", ("cart_info",), lambda t: SD.cart_uu(t, EVENT_WINDOW))


def _detail_stream(spark, sf_dir, name, build):
    """[S] form of a job on the order detail topic (L5's output, every version): two halves by record time, then a
    heartbeat beyond every window and timer."""
    from .streaming import dws as SD
    from .streaming import runners as R
    detail = dwd.order_detail(_topic(spark, sf_dir), keep_seq=True)
    lo, hi = detail.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    lo, hi = lo or 0, hi or 0
    mid = (lo + hi) // 2
    parts = [detail.where(F.col("ts_ms") <= mid), detail.where(F.col("ts_ms") > mid),
             SD.detail_heartbeat(detail, hi + 3_600_000)]
    return R.replay(spark, [_lines(p) for p in parts], lambda raw: build(_records(raw, detail.schema)), name)


@query("dws_province_order_stream")
def q_dws_province_order_stream(spark, sf_dir):
    from .streaming import dws as SD
    province = fx.province_dim(spark, sf_dir)
    return _detail_stream(spark, sf_dir, "dws_province_order", lambda d: SD.province_order(d, province, "10 seconds"))


@query("dws_sku_order_stream")
def q_dws_sku_order_stream(spark, sf_dir):
    from .streaming import dws as SD
    dims = _dims(spark, sf_dir)
    return _detail_stream(spark, sf_dir, "dws_sku_order", lambda d: SD.sku_order(d, dims, "10 seconds"))


def _log_phases(spark, sf_dir):
    """The raw page-log topic in two halves by record time (records whose time can't be read come first), then a
    heartbeat; JSON lines of (offset, value)."""
    from .streaming import dws as SD
    raw = fx.page_log_topic(spark, sf_dir)
    ts = F.coalesce(F.get_json_object("value", "$.ts").cast("long"), F.lit(0))
    lo, hi = raw.where(ts > 0).agg(F.min(ts), F.max(ts)).first()
    lo, hi = lo or 0, hi or 0
    mid = (lo + hi) // 2
    beat = spark.range(1).select(F.lit(-1).cast("long").alias("offset"),
                                 F.lit(SD.log_heartbeat(hi + 30 * 86_400_000)).alias("value"))
    return [_lines(p) for p in (raw.where(ts <= mid), raw.where(ts > mid), beat)]


RAW_LOG = "offset long, value string"


def _log_stream(spark, sf_dir, name, build, beat=True):
    """[S] form of a page-log job, records parsed as they arrive."""
    from .streaming import runners as R
    return R.replay(spark, _log_phases(spark, sf_dir)[:3 if beat else 2],
                    lambda line: build(lg.parse_logs(_records(line, RAW_LOG))[0]), name)


@query("log_split_stream")
def q_log_split_stream(spark, sf_dir):
    """L2/P13 [S]: raw log -> flag repair -> page, start, err, display, action and dirty sinks, read back."""
    from .streaming import logs as SL
    from .streaming import runners as R
    out = R.replay_path(spark, _log_phases(spark, sf_dir)[:2], lambda line: SL.repaired(_records(line, RAW_LOG)),
                        "log_split", SL.split_sinks, no_data_batches=False)
    none, mid = F.lit(None).cast("string"), F.col("common.mid")
    is_new = F.col("common.is_new")
    cols = {"page": (mid, is_new, none), "start": (mid, is_new, none), "err": (mid, none, none),
            "display": (mid, none, F.col("display.item")), "action": (mid, none, F.col("action.item")),
            "dirty": (none, none, none)}
    parts = [spark.read.parquet(f"{out}/{n}").select(F.lit(n).alias("sink"), "offset", m.alias("mid"),
                                                     i.alias("is_new"), x.alias("item"))
             for n, (m, i, x) in cols.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@query("interval_join_stream")
def q_interval_join_stream(spark, sf_dir):
    """J5 [S]: ``interval_join`` over the events as they arrive."""
    from .streaming import joins as SJ
    from .streaming import runners as R
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type",
                                                  sc.epoch_ms(F.col("ts")).alias("ms"))
    lo, hi = ev.agg(F.min("ms"), F.max("ms")).first()
    mid = ((lo or 0) + (hi or 0)) // 2

    def build(raw):
        e = _records(raw, ev.schema)
        buy = e.where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("purchase_id"), F.col("user_id").alias("uid"), F.col("ms").alias("buy_ms"))
        view = e.where(F.col("event_type") == "view").select(
            F.col("event_id").alias("view_id"), F.col("user_id").alias("v_uid"), F.col("ms").alias("view_ms"))
        j = SJ.interval_join(buy, view, "uid", "v_uid", "buy_ms", "view_ms", -6 * 3_600_000, 0)
        return j.select("purchase_id", "view_id", "uid", (F.col("buy_ms") - F.col("view_ms")).alias("lag_ms"))
    return R.replay(spark, [_lines(ev.where(F.col("ms") <= mid)), _lines(ev.where(F.col("ms") > mid))], build,
                    "interval_join")


@query("dws_home_detail_uv_stream")
def q_dws_home_detail_uv_stream(spark, sf_dir):
    from .streaming import dws as SD
    return _log_stream(spark, sf_dir, "dws_home_detail_uv",
                       lambda logs: SD.home_detail_uv(lg.split_logs(logs)["page"], EVENT_WINDOW))


@query("dws_traffic_dims_stream")
def q_dws_traffic_dims_stream(spark, sf_dir):
    from .streaming import dws as SD
    return _log_stream(spark, sf_dir, "dws_traffic_dims", lambda logs: SD.traffic_dims(logs, EVENT_WINDOW))


@query("dws_user_login_stream")
def q_dws_user_login_stream(spark, sf_dir):
    from .streaming import dws as SD
    return _log_stream(spark, sf_dir, "dws_user_login",
                       lambda logs: SD.user_login(lg.split_logs(logs)["page"], EVENT_WINDOW))


@query("late_drop")
def q_late_drop(spark, sf_dir):
    """T16 [S]: events arrive as three phases -- days 15-30, then days 3-14, then
    days 1-2 -- with a 0 s watermark. Spark filters late rows with the
    watermark of the previous micro-batch, so the second phase still counts and
    the third (behind a watermark already at day 30) is dropped, as the
    reference drops late data (no allowed lateness, no late side output)."""
    from .streaming import jobs as J
    from .streaming import runners as R
    ev = fx.table(spark, sf_dir, "events").select("event_id", sc.epoch_ms(F.col("ts")).alias("ts"))
    day, ts = 86_400_000, F.col("ts")
    parts = [ev.where(ts >= fx.T0_MS + 14 * day),
             ev.where((ts >= fx.T0_MS + 2 * day) & (ts < fx.T0_MS + 14 * day)),
             ev.where(ts < fx.T0_MS + 2 * day)]
    return R.replay(spark, [_lines(p) for p in parts],
                    lambda raw: J.window_counts(_records(raw, "event_id long, ts long"), "ts", "1 hour"),
                    "late_drop", no_data_batches=False)


@query("sink_jsonl_roundtrip")
def q_sink_jsonl_roundtrip(spark, sf_dir):
    """K1: a DWS result serialised to JSON lines (nulls omitted) and read back."""
    from .streaming import runners as R
    res = q_dws_cart_uu(spark, sf_dir)
    path = _scratch(spark, "sink_cart_uu")
    R.write_jsonl(R.to_value(res), path)
    back = spark.read.text(path).select(F.from_json("value", res.schema).alias("r")).select("r.*")
    return back


@query("sink_dynamic_topic")
def q_sink_dynamic_topic(spark, sf_dir):
    """K2: each record routed to the topic named by its config (dwd_<table>),
    written one folder per topic; read back as (topic, records)."""
    from .streaming import runners as R
    t = _topic(spark, sf_dir)
    routed = t.select(F.concat(F.lit("dwd_"), F.col("source")["table"]).alias("topic"),
                      F.to_json(F.struct("after", "op", "ts_ms")).alias("value"))
    path = _scratch(spark, "sink_topics")
    R.write_jsonl(routed, path, partition_by="topic")
    back = spark.read.text(path)
    return back.groupBy("topic").agg(F.count(F.lit(1)).alias("records"))


#: Streams that keep a state for every order detail: right, but not registered, as a state call takes milliseconds here
#: (README). ``oracle.LARGE_STREAMS`` has their SQL.
LARGE_STREAMS = {k: REGISTRY.pop(k) for k in ("dedup_composite_stream", "dws_sku_order_stream",
                                              "dws_province_order_stream")}
