"""Change-feed and page-log inputs derived by Spark from the driver's tables.

The reference consumes database change envelopes and app page logs. The test
tables are a star schema, so each source table of the reference is bound to a
projection of one test table (see FIXTURES.md). Every derivation is a narrow
projection or a key-partitioned aggregate, so it scales with the tables.

Envelope shape (what ``from_json`` of a change record yields)::

    before map<string,string>, after map<string,string>,
    source map<string,string> {db, table}, op string, ts_ms bigint, seq string

``seq`` is the arrival position (a Kafka partition/offset stand-in): a
zero-padded string that orders the versions of one key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms

# Fixed values of the synthetic feed.
T0_MS = 1704067200000          # 2024-01-01 00:00:00 UTC, base of change-record times
DB = "shop"
HOUR_MS = 3_600_000
MAP_SS = "map<string,string>"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _dec(c: Column) -> Column:
    return c.cast("decimal(16,2)")


def _m(d: dict) -> Column:
    return F.create_map(*[e for k, v in d.items() for e in (F.lit(k), _s(v))])


def to_envelope(df: DataFrame, tbl: str, after: dict, ts_ms: Column, seq: Column,
                op: str = "r", before: dict | None = None) -> DataFrame:
    """Wrap projected rows as change envelopes of ``tbl``."""
    return df.select(
        (_m(before) if before else F.lit(None).cast(MAP_SS)).alias("before"),
        _m(after).alias("after"),
        F.create_map(F.lit("db"), F.lit(DB), F.lit("table"), F.lit(tbl)).alias("source"),
        F.lit(op).alias("op"),
        ts_ms.cast("long").alias("ts_ms"),
        seq.alias("seq"),
    )


def _pad(c: Column, n: int = 16) -> Column:
    return F.lpad(_s(c), n, "0")


# ------------------------------------------------------------------ order side

def order_info_env(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    create = epoch_ms(F.col("o_orderdate")) + (F.col("o_orderkey") % 24) * HOUR_MS
    status = (F.when(F.col("o_orderstatus") == "F", "1003")
              .when(F.col("o_orderstatus") == "O", "1006")
              .when(F.col("o_orderstatus") == "P", "1001"))
    ts = F.lit(T0_MS) + F.col("o_orderkey") * 1000
    return to_envelope(j, "order_info", {
        "id": F.col("o_orderkey"),
        "user_id": F.col("o_custkey"),
        "province_id": F.col("c_nationkey"),
        "order_status": status,
        "consignee": F.col("c_name"),
        "create_time": create,
        "operate_time": create + 1_800_000,
        "total_amount": _dec(F.col("o_totalprice")),
        "original_total_amount": _dec(F.col("o_totalprice")),
    }, ts, _pad(ts))


def payment_info_env(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    create = epoch_ms(F.col("o_orderdate")) + (F.col("o_orderkey") % 24) * HOUR_MS
    status = (F.when(F.col("o_orderkey") % 50 == 0, F.lit(None))
              .when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "1602")
              .otherwise("1601"))
    ts = F.lit(T0_MS) + F.col("o_orderkey") * 1000 + 500
    return to_envelope(o, "payment_info", {
        "id": F.col("o_orderkey"),
        "user_id": F.col("o_custkey"),
        "order_id": F.col("o_orderkey"),
        "payment_type": F.concat(F.lit("110"), _s(F.col("o_orderkey") % 3 + 1)),
        "callback_time": create + 600_000,
        "payment_status": status,
    }, ts, _pad(ts))


def _detail_id() -> Column:
    return F.concat_ws("-", _s(F.col("l_orderkey")), _s(F.col("l_linenumber")))


def _lineitem_seq() -> Column:
    """Arrival order of the versions of one detail id (no ties at any sf)."""
    return F.concat_ws("|", _pad(epoch_ms(F.col("l_shipdate")), 15), _pad(F.col("l_partkey"), 12),
                       _pad(F.col("l_suppkey"), 12), _pad(F.round(F.col("l_extendedprice") * 100).cast("long"), 15))


def _money(x: Column) -> Column:
    return F.round(x, 2).cast("decimal(16,2)")


def order_detail_env(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = _dec(F.col("l_extendedprice"))
    ts = F.lit(T0_MS) + F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10
    return to_envelope(li, "order_detail", {
        "id": _detail_id(),
        "order_id": F.col("l_orderkey"),
        "sku_id": F.col("l_partkey"),
        "sku_name": F.concat(F.lit("sku "), _s(F.col("l_partkey"))),
        "create_time": epoch_ms(F.col("l_shipdate")),
        "source_type": F.lit("2401"),
        "sku_num": F.col("l_quantity").cast("int"),
        "order_price": price,
        "split_total_amount": _money(price * (1 - _dec(F.col("l_discount")))),
        "split_activity_amount": _money(price * _dec(F.col("l_discount"))),
        "split_coupon_amount": _money(price * _dec(F.col("l_tax"))),
    }, ts, _lineitem_seq())


def _latest_line_version(li: DataFrame) -> DataFrame:
    """Latest version per detail id: one shuffle of the plain columns, the same one for all feeds made of it (their
    arrival order, a long text, is made behind it)."""
    cols = ["l_discount", "l_tax", "l_partkey", "l_suppkey"]
    return (li.repartition("l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber")
            .agg(F.max_by(F.struct(*cols), _lineitem_seq()).alias("v"))
            .select("l_orderkey", "l_linenumber", "v.*"))


def order_detail_activity_env(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    v = _latest_line_version(li).where(F.col("l_discount") >= 0.05)
    ts = F.lit(T0_MS) + F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10 + 1
    return to_envelope(v, "order_detail_activity", {
        "id": _detail_id(),
        "order_detail_id": _detail_id(),
        "activity_id": F.col("l_partkey") % 4 + 1,
        "activity_rule_id": F.col("l_suppkey") % 6 + 1,
    }, ts, _pad(ts))


def order_detail_coupon_env(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    v = _latest_line_version(li).where(F.col("l_tax") >= 0.04)
    ts = F.lit(T0_MS) + F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10 + 2
    return to_envelope(v, "order_detail_coupon", {
        "id": _detail_id(),
        "order_detail_id": _detail_id(),
        "coupon_id": F.col("l_orderkey") % 9 + 1,
    }, ts, _pad(ts))


def order_refund_info_env(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    ts = F.lit(T0_MS) + F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10 + 5
    return to_envelope(li, "order_refund_info", {
        "id": _detail_id(),
        "user_id": F.col("l_suppkey"),
        "order_id": F.col("l_orderkey"),
        "sku_id": F.col("l_partkey"),
        "refund_type": F.when(F.col("l_linestatus") == "F", "1502").otherwise("1501"),
        "refund_num": F.col("l_quantity").cast("int"),
        "refund_amount": _dec(F.col("l_extendedprice")),
        "refund_reason_type": F.concat(F.lit("130"), _s(F.col("l_linenumber") % 5 + 1)),
        "refund_reason_txt": F.concat(F.lit("reason "), _s(F.col("l_linenumber"))),
        "create_time": epoch_ms(F.col("l_shipdate")) + 86_400_000,
        "refund_status": F.when(F.col("l_suppkey") % 2 == 0, "0705").otherwise("0701"),
    }, ts, _lineitem_seq())


def refund_payment_env(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    ts = F.lit(T0_MS) + F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 10 + 7
    return to_envelope(li, "refund_payment", {
        "id": F.concat(F.lit("rp"), _detail_id()),
        "order_id": F.col("l_orderkey"),
        "sku_id": F.col("l_partkey"),
        "payment_type": F.lit("1102"),
        "callback_time": epoch_ms(F.col("l_shipdate")) + 86_400_000 + HOUR_MS,
        "total_amount": _dec(F.col("l_extendedprice")),
        "refund_status": F.when(F.col("l_suppkey") % 3 != 0, "1602").otherwise("1601"),
    }, ts, _lineitem_seq())


# ------------------------------------------------------------------ events side

def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("long")


def cart_info_env(spark, sf_dir) -> DataFrame:
    """Snapshot rows for every purchase event, plus a quantity update for k % 7 = 0."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").withColumn("k", _k())
    ts = epoch_ms(F.col("ts"))
    base = {"id": F.col("event_id"), "user_id": F.col("user_id"), "sku_id": F.col("k"),
            "create_time": ts}
    snap = to_envelope(ev, "cart_info", {**base, "sku_num": F.col("k") % 5 + 1}, ts, _pad(ts))
    upd = to_envelope(ev.where(F.col("k") % 7 == 0), "cart_info",
                      {**base, "sku_num": F.col("k") % 5 + 3}, ts + 1000, _pad(ts + 1000), op="u",
                      before={**base, "sku_num": F.col("k") % 5 + 1})
    return snap.unionByName(upd)


def comment_info_env(spark, sf_dir) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    create = F.lit(T0_MS) + F.col("conv_id") * 1000 + F.col("turn") * 10
    return to_envelope(cv, "comment_info", {
        "id": F.concat_ws("-", _s(F.col("conv_id")), _s(F.col("turn"))),
        "user_id": F.col("conv_id"),
        "sku_id": F.col("turn"),
        "spu_id": F.col("turn"),
        "order_id": F.col("conv_id"),
        "appraise": F.col("conv_id") % 5 + 1201,
        "comment_txt": F.col("text"),
        "create_time": create,
    }, create + 1, _pad(create + 1))


def user_info_env(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    ts = F.lit(T0_MS) + key * 1000
    return to_envelope(c, "user_info", {
        "id": key,
        "name": F.concat(F.lit(" "), F.lower(F.col("c_name")), F.lit(" ")),
        "user_level": key % 3 + 1,
        "login_name": F.concat(F.lit("user"), _s(key)),
        "phone_num": F.concat(F.lit("138"), F.lpad(_s(key), 8, "0")),
        "email": F.concat(F.lit("user"), _s(key), F.lit("@example.com")),
        "gender": F.when(key % 3 == 0, F.lit(None)).when(key % 2 == 0, "F").otherwise("M"),
        "birthday": (key * 13) % 16000,
    }, ts, _pad(ts))


def user_info_sup_env(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    ts = F.lit(T0_MS) + key * 1000 + 60_000
    return to_envelope(c, "user_info_sup_msg", {
        "uid": key,
        "height": key % 180 + 90,
        "unit_height": F.when(key % 2 == 0, "cm").otherwise("in"),
        "weight": key % 190 + 25,
        "unit_weight": F.when(key % 3 == 0, "lb").otherwise("kg"),
        "create_ts": ts,
    }, ts, _pad(ts))


ENVELOPES = {
    "order_info": order_info_env,
    "order_detail": order_detail_env,
    "order_detail_activity": order_detail_activity_env,
    "order_detail_coupon": order_detail_coupon_env,
    "payment_info": payment_info_env,
    "order_refund_info": order_refund_info_env,
    "refund_payment": refund_payment_env,
    "cart_info": cart_info_env,
    "comment_info": comment_info_env,
    "user_info": user_info_env,
    "user_info_sup_msg": user_info_sup_env,
}


TOPIC_PATH = "spark.tidemart.topic.path"
TOPIC_SF = "spark.tidemart.topic.sfDir"


def _materialized(spark: SparkSession, sf_dir: str) -> str | None:
    path = spark.conf.get(TOPIC_PATH, None)
    return path if path and spark.conf.get(TOPIC_SF, None) == sf_dir else None


def topic_db(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] | None = None) -> DataFrame:
    """The whole change topic: union of every bound table's envelopes.

    Consumers filter on ``source['table']``; because ``source`` is a literal map
    per branch, Catalyst folds the filter and prunes the other branches. When
    the topic has been materialized (``materialize_topics``) it is read back
    instead, with partition pruning on the table.
    """
    names = tables or tuple(ENVELOPES)
    path = _materialized(spark, sf_dir)
    if path:
        # one branch per table partition; every record of the partition has the
        # same source map, so it is restated as a literal and consumers' table
        # filters fold exactly as on the derived topic (other partitions unread)
        t = spark.read.parquet(f"{path}/topic_db")
        return reduce(DataFrame.unionByName, [
            t.where(F.col("tbl") == n).select(
                "before", "after",
                F.create_map(F.lit("db"), F.lit(DB), F.lit("table"), F.lit(n)).alias("source"),
                "op", "ts_ms", "seq")
            for n in names])
    return reduce(DataFrame.unionByName, [ENVELOPES[n](spark, sf_dir) for n in names])


def materialize_topics(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the change topic (partitioned by source table) and the page-log
    topic once, as the upstream capture would; later ``topic_db`` /
    ``page_log_topic`` calls for ``sf_dir`` read them instead of deriving."""
    spark.conf.unset(TOPIC_PATH)
    (topic_db(spark, sf_dir).withColumn("tbl", F.col("source")["table"])
     .write.mode("overwrite").partitionBy("tbl").parquet(f"{path}/topic_db"))
    page_log_topic(spark, sf_dir).write.mode("overwrite").parquet(f"{path}/page_log")
    spark.conf.set(TOPIC_PATH, path)
    spark.conf.set(TOPIC_SF, sf_dir)


# ------------------------------------------------------------------ dimensions

# Appraise dictionary (code 1205 is left out on purpose).
BASE_DIC = [("1201", "好评"), ("1202", "中评"), ("1203", "差评"), ("1204", "自动")]

# Six brands that the label model scores by name; Brand#1..#6 of
# the test data are renamed to them in this order.
SCORED_BRANDS = ["TCL", "苹果", "联想", "小米", "欧莱雅", "香奈儿"]

# Top-level categories assigned to the part types (two scored
# groups and one default) and the search class of each top-level name.
CATEGORY1_BY_TYPE = [("ECONOMY", "手机"), ("STANDARD", "数码"), ("PROMO", "家居家装"),
                     ("LARGE", "家用电器"), ("MEDIUM", "母婴"), ("SMALL", "运动户外")]
CATEGORY_COMPARE = [("1", "手机", "科技与数码"), ("2", "数码", "时尚与潮流"), ("3", "家居家装", "家庭与育儿"),
                    ("4", "家用电器", "性价比"), ("5", "母婴", "健康与养生"), ("6", "图书", "学习与发展")]


def base_dic(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BASE_DIC, "dic_code string, dic_name string")


def category_compare(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_COMPARE, "id string, category_name string, search_category string")


def province_dim(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(_s(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"))


def _brand_name() -> Column:
    num = F.regexp_extract(F.col("p_brand"), r"#(\d+)$", 1).cast("int")
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, name in enumerate(SCORED_BRANDS, start=1):
        expr = expr.when(num == i, F.lit(name))
    return expr.otherwise(F.col("p_brand"))


def _c3_id() -> Column:
    return F.concat(F.col("p_type"), F.lit("/"), _s(F.col("p_size") % 4))


def _c3_name() -> Column:
    return F.concat(F.lower(F.col("p_type")), F.lit(" "), _s(F.col("p_size") % 4))


def sku_info(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(_s(F.col("p_partkey")).alias("id"), F.col("p_name").alias("sku_name"),
                    F.col("p_name").alias("spu_id"), F.col("p_brand").alias("tm_id"),
                    _c3_id().alias("category3_id"))


def spu_info(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_name").alias("id"), F.col("p_name").alias("spu_name")).distinct()


def base_trademark(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("id"), _brand_name().alias("tm_name")).distinct()


def base_category3(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(_c3_id().alias("id"), _c3_name().alias("name"),
                    F.col("p_type").alias("category2_id")).distinct()


def base_category2(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_type").alias("id"), F.lower(F.col("p_type")).alias("name"),
                    F.col("p_type").alias("category1_id")).distinct()


def base_category1(spark) -> DataFrame:
    return spark.createDataFrame(CATEGORY1_BY_TYPE, "id string, name string")


# ------------------------------------------------------------------ page log

# Fixed values of the page-log binding.
PAGE_BY_EVENT = [("click", "home"), ("view", "good_detail"), ("purchase", "payment"),
                 ("signup", "login"), ("error", "mine")]
CHANNELS = ["appstore", "web", "oppo"]
OSES = ["iOS 17", "Android 14", "Other 1"]
BRANDS = ["Apple", "Xiaomi", "Huawei", "Other"]
DIRTY_EVERY = 97


def _pick(lst: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in lst]), (idx + 1).cast("int"))


def page_log_struct(spark, sf_dir) -> DataFrame:
    """Parsed page-log records (offset = event_id) before serialisation."""
    ev = table(spark, sf_dir, "events").withColumn("k", _k()).withColumn("ts_ms", epoch_ms(F.col("ts")))
    part = table(spark, sf_dir, "part").select("p_partkey", _c3_name().alias("search_word"))
    ev = ev.join(part, ev.k == part.p_partkey, "left")
    # A record of the log is many times its event's size, and there are few values of k: the rows are spread anew by
    # their own key before they grow, else a few tasks build and parse the whole log.
    ev = ev.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")
    k, uid = F.col("k"), F.col("user_id")
    page_id = F.when(F.lit(False), F.lit(None).cast("string"))
    for et, pid in PAGE_BY_EVENT:
        page_id = page_id.when(F.col("event_type") == et, F.lit(pid))
    last_page = (F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, "search")
                 .when(k % 5 == 2, "login").otherwise("home"))
    is_kw = k % 5 == 1
    ts = F.col("ts_ms")
    common = F.struct(
        _s(uid).alias("mid"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(_s(uid)).alias("uid"),
        F.concat(F.lit("v"), _s(k % 3)).alias("vc"),
        _pick(CHANNELS, k % 3).alias("ch"),
        _s(uid % 7).alias("ar"),
        F.when(F.col("event_id") % 2 == 0, "1").otherwise("0").alias("is_new"),
        _pick(OSES, uid % 3).alias("os"),
        F.concat(F.lit("model-"), _s(uid % 4)).alias("md"),
        _pick(BRANDS, uid % 4).alias("ba"),
        F.concat(F.lit("s"), _s(F.floor(F.col("event_id") / 10))).alias("sid"),
    )
    is_start = k % 13 == 0
    page = F.when(is_start, F.lit(None)).otherwise(F.struct(
        page_id.alias("page_id"),
        last_page.alias("last_page_id"),
        F.when(is_kw, F.col("search_word")).otherwise(_s(k)).alias("item"),
        F.when(is_kw, "keyword").otherwise("sku_id").alias("item_type"),
        F.round(F.col("value") * 1000).cast("long").alias("during_time"),
    ))
    start = F.when(is_start, F.struct(F.lit("icon").alias("entry"), (k * 10).alias("loading_time"),
                                      k.alias("open_ad_id")))
    err = F.when(F.col("event_type") == "error",
                 F.struct((k + 1000).alias("error_code"), F.concat(F.lit("err "), _s(k)).alias("msg")))
    displays = F.transform(F.sequence(F.lit(0), (k % 4).cast("int") - 1), lambda i: F.struct(
        _s(k + i).alias("item"), F.lit("sku_id").alias("item_type"), i.alias("pos_id"), i.alias("order")))
    actions = F.transform(F.sequence(F.lit(0), (k % 3).cast("int") - 1), lambda i: F.struct(
        F.when(i == 0, "cart_add").otherwise("favor_add").alias("action_id"), _s(k + i).alias("item"),
        F.lit("sku_id").alias("item_type"), (ts + i * 100).alias("ts")))
    return ev.select(
        F.col("event_id").alias("offset"),
        common.alias("common"), page.alias("page"), ts.alias("ts"),
        F.when(k % 4 > 0, displays).alias("displays"),
        F.when(k % 3 > 0, actions).alias("actions"),
        start.alias("start"), err.alias("err"),
    )


def page_log_topic(spark, sf_dir) -> DataFrame:
    """Raw page-log topic: (offset, value) with every 97th record truncated (dirty).

    A record's text is made once, where the rows are spread: filters on it stay behind the one-element explode, else
    they would make and parse it in the tasks that read the events, and those after it once more.
    """
    path = _materialized(spark, sf_dir)
    if path:
        return spark.read.parquet(f"{path}/page_log")
    s = page_log_struct(spark, sf_dir)
    js = F.to_json(F.struct("common", "page", "ts", "displays", "actions", "start", "err"))
    return (s.select("offset", F.explode(F.array(js)).alias("v_"))
            .select("offset", F.when(F.col("offset") % DIRTY_EVERY == 0,
                                     F.expr("substring(v_, 1, length(v_) - 1)")).otherwise(F.col("v_"))
                    .alias("value")))


def mixed_feed(spark, sf_dir) -> DataFrame:
    """A change feed with foreign databases, unknown ops and deletes (for P3/P7):
    supplier rows, db by key % 3, op by key % 5 (0 d, 1 c, 2 u, 3 r, 4 unknown)."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    row = {"s_suppkey": key, "s_name": F.col("s_name"), "s_nationkey": F.col("s_nationkey")}
    op = F.element_at(F.array(*[F.lit(x) for x in ("d", "c", "u", "r", "x")]), (key % 5 + 1).cast("int"))
    m = _m(row)
    return s.select(
        F.when(op.isin("d", "u"), m).alias("before"),
        F.when(op == "d", F.create_map().cast(MAP_SS)).otherwise(m).alias("after"),
        F.create_map(F.lit("db"), F.when(key % 3 == 0, F.lit("other_db")).otherwise(F.lit(DB)),
                     F.lit("table"), F.lit("supplier")).alias("source"),
        op.alias("op"),
        (F.lit(T0_MS) + key * 1000).alias("ts_ms"),
        _pad(key).alias("seq"),
    )


def supplier_change_feed(spark, sf_dir) -> DataFrame:
    """Versioned supplier changes for dimension upserts (K6/K7):
    r full row for every key; u (even keys) upper-cased name with an empty
    nation cell; d (keys % 5 = 0); c again after the delete (keys % 10 = 0)
    with a new name and an empty nation cell."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    full = {"id": key, "s_suppkey": key, "s_name": F.col("s_name"), "s_nationkey": F.col("s_nationkey")}
    ts = F.lit(T0_MS) + key * 1000

    def env(df, op, after, before, n):
        return df.select(
            (_m(before) if before else F.lit(None).cast(MAP_SS)).alias("before"),
            (_m(after) if after else F.create_map().cast(MAP_SS)).alias("after"),
            F.create_map(F.lit("db"), F.lit(DB), F.lit("table"), F.lit("supplier")).alias("source"),
            F.lit(op).alias("op"), (ts + n).alias("ts_ms"), F.concat(_pad(ts), F.lit(f"-{n}")).alias("seq"))

    return reduce(DataFrame.unionByName, [
        env(s, "r", full, None, 1),
        env(s.where(key % 2 == 0), "u", {"id": key, "s_suppkey": key, "s_name": F.upper("s_name"),
                                         "s_nationkey": F.lit("")}, full, 2),
        env(s.where(key % 5 == 0), "d", None, full, 3),
        env(s.where(key % 10 == 0), "c", {"id": key, "s_suppkey": key, "s_name": F.concat(F.lit("reborn "), _s(key)),
                                          "s_nationkey": F.lit("")}, None, 4),
    ])


def sensitive_word_file(spark, sf_dir, path: str) -> None:
    """The external word list (S8): a text folder with what stands between commas and line ends in ``documents``."""
    d = table(spark, sf_dir, "documents")
    d.select(F.explode(F.split("text", "[,\n]")).alias("value")).where("value <> ''").distinct().write.text(path)


def jdbc_scan(spark: SparkSession, url: str, query: str, properties: dict | None = None,
              camel_case: bool = False, partition_column: str | None = None, lower: int = 0, upper: int = 0,
              num_partitions: int = 1) -> DataFrame:
    """JDBC query scan (config / dimension tables), optional snake->camel
    column names (F24). A numeric ``partition_column`` splits the read into
    ``num_partitions`` parallel range queries."""
    from ..functions.scalars import snake_to_camel
    r = spark.read.format("jdbc").option("url", url).option("query", query) if not partition_column else \
        spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q") \
        .option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper) \
        .option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    df = r.load()
    return df.toDF(*[snake_to_camel(c) for c in df.columns]) if camel_case else df
