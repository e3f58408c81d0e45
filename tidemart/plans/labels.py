"""User-label branch (L19-L22): base6 user basics, base4 order scoring,
base2 device/search scoring, their merge and the age band (A12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..functions import weights as W
from ..operators.dedup import dedup_exact, strictly_newer_apart
from ..operators.dims import dedup_dim
from ..operators.envelope import cdc_demux
from ..operators.joins import interval_join
from ..operators.logs import device_search_flatten
from ..operators.windows import window_start

MIN = 60_000
HOUR = 3_600_000


# ------------------------------------------------------------------ base6

def user_flat(topic: DataFrame, as_of, tz: str = "UTC") -> DataFrame:
    """P17 + F6-F9: user rows with birthday, decade, age, zodiac; gender
    defaults to 'home'. ``as_of`` is the age reference date (a Column)."""
    a = F.col("after")
    b = sc.epoch_day_to_date(a["birthday"])
    u = cdc_demux(topic, "user_info").where(a.isNotNull())
    out = u.select(a["id"].alias("uid"), a["name"].alias("uname"), a["user_level"].alias("user_level"),
                   a["login_name"].alias("login_name"), a["phone_num"].alias("phone_num"), a["email"].alias("email"),
                   F.coalesce(a["gender"], F.lit("home")).alias("gender"),
                   F.date_format(b, "yyyy-MM-dd").alias("birthday"), sc.decade(b).alias("decade"),
                   sc.age_years(b, as_of).alias("age"), sc.zodiac(b).alias("zodiac_sign"), "ts_ms")
    return out.where(~sc.empty_or_null(F.col("uid")))


def name_clean(users: DataFrame) -> DataFrame:
    """Names trimmed and upper-cased."""
    return users.withColumn("uname", F.upper(F.trim(F.col("uname"))))


def user_sup_flat(topic: DataFrame) -> DataFrame:
    a = F.col("after")
    s = cdc_demux(topic, "user_info_sup_msg").where(a.isNotNull())
    out = s.select(a["uid"].alias("sup_uid"), a["height"].alias("height"), a["unit_height"].alias("unit_height"),
                   a["weight"].alias("weight"), a["unit_weight"].alias("unit_weight"),
                   a["create_ts"].cast("long").alias("create_ts"), F.col("ts_ms").alias("sup_ts_ms"))
    return out.where(~sc.empty_or_null(F.col("sup_uid")))


def base6(topic: DataFrame, as_of, tz: str = "UTC") -> DataFrame:
    """User basics ⋈ supplement within ±5 minutes (keyed by uid)."""
    j = interval_join(user_flat(topic, as_of, tz), user_sup_flat(topic), "uid", "sup_uid", "ts_ms", "sup_ts_ms",
                      -5 * MIN, 5 * MIN)
    return j.select("uid", "uname", "user_level", "login_name", "phone_num", "email", "gender", "birthday", "decade",
                    "age", "zodiac_sign", "height", "unit_height", "weight", "unit_weight", "ts_ms")


# ------------------------------------------------------------------ base4

def order_flat(topic: DataFrame, tz: str = "UTC") -> DataFrame:
    """P17 order flatten + F10 pay time slot."""
    a = F.col("after")
    o = cdc_demux(topic, "order_info").select(
        "ts_ms", a["id"].alias("id"), a["user_id"].alias("uid"), a["consignee"].alias("consignee"),
        a["create_time"].cast("long").alias("create_time"), a["original_total_amount"].alias("original_total_amount"),
        a["total_amount"].alias("total_amount"), a["province_id"].cast("long").alias("province_id"))
    return o.withColumn("pay_time_slot", sc.time_slot(F.col("create_time"), tz)).where(~sc.empty_or_null(F.col("id")))


def detail_flat(topic: DataFrame) -> DataFrame:
    a = F.col("after")
    d = cdc_demux(topic, "order_detail").select(
        F.col("ts_ms").alias("d_ts_ms"), a["id"].alias("detail_id"), a["order_id"].alias("order_id"),
        a["sku_id"].alias("sku_id"), a["sku_name"].alias("sku_name"), a["sku_num"].cast("long").alias("sku_num"),
        a["order_price"].alias("order_price"), a["split_activity_amount"].alias("split_activity_amount"),
        a["split_coupon_amount"].alias("split_coupon_amount"), a["split_total_amount"].alias("split_total_amount"),
        "seq")
    return d.where(~sc.empty_or_null(F.col("order_id")))


ORDER_COLS = ["id", "uid", "consignee", "create_time", "original_total_amount", "total_amount", "province_id",
              "pay_time_slot", "ts_ms"]
DETAIL_OUT = ["detail_id", "order_id", "sku_id", "sku_name", "sku_num", "order_price", "split_activity_amount",
              "split_coupon_amount", "split_total_amount"]


def order_detail_join(topic: DataFrame, tz: str = "UTC", bucket_as: str | None = None) -> DataFrame:
    """Orders ⋈ details (order id) within ±2 minutes; merged row. ``bucket_as`` keeps the join's time bucket."""
    j = interval_join(order_flat(topic, tz), detail_flat(topic), "id", "order_id", "ts_ms", "d_ts_ms",
                      -2 * MIN, 2 * MIN, copied="left", bucket_as=bucket_as)
    return j.select(*ORDER_COLS, *DETAIL_OUT, "seq", *([bucket_as] if bucket_as else []))


def score_cols(families: list[str]) -> list[str]:
    return [f"{f}_{b}" for f in families for b in W.BANDS]


BASE4_FAMILIES = ["pay_time", "amount", "tname", "b1name"]
BASE2_FAMILIES = ["device", "search"]


def base4(spark: SparkSession, topic: DataFrame, sku_wide: DataFrame, tree: DataFrame, tz: str = "UTC") -> DataFrame:
    """Joined order details, first version per detail id (T12 on the order
    create time), sku -> c3 / brand, c3 -> top category, then time / amount /
    brand / category scores."""
    # arrival positions of details are composite texts, which have no chunks: one scan of a detail's few versions, which
    # lie by their order and stay there
    j = strictly_newer_apart(order_detail_join(topic, tz, "bucket"), "detail_id", "create_time", "seq", ["order_id", "bucket"])
    # list lookups of the reference: the first match counts
    sw = dedup_dim(sku_wide.select(F.col("skuid").alias("_skuid"), "c3id", "tname"), "_skuid")
    j = j.join(sw, j.sku_id == sw._skuid, "left").drop("_skuid")
    tr = dedup_dim(tree.select(F.col("id").alias("_c3"), F.col("b1name").alias("b1_name")), "_c3")
    j = j.join(tr, j.c3id == tr._c3, "left").drop("_c3")
    j = W.score(j, spark, "pay_time", F.col("pay_time_slot"), ~sc.empty_or_null(F.col("pay_time_slot")))
    j = W.score(j, spark, "amount", W.amount_class(F.col("total_amount")))
    j = W.score(j, spark, "tname", F.col("tname"), ~sc.empty_or_null(F.col("tname")))
    j = W.score(j, spark, "b1name", F.col("b1_name"), ~sc.empty_or_null(F.col("b1_name")))
    return j.select(*ORDER_COLS, *DETAIL_OUT, "c3id", "tname", "b1_name", *score_cols(BASE4_FAMILIES))


# ------------------------------------------------------------------ base2

PROFILE_FIELDS = ["os", "ch", "md", "ba", "search_item"]


def device_rows(pages: DataFrame, keep_offset: bool = False) -> DataFrame:
    """P15 then T13: device/search rows with a non-empty uid, exact duplicates removed.

    ``keep_offset`` carries the arrival position past the dedup (the first of the duplicates)."""
    flat = device_search_flatten(pages, keep=("offset",) if keep_offset else ())
    d = flat.where(~sc.empty_or_null(F.col("uid")))
    if keep_offset:
        return d.groupBy(*[c for c in d.columns if c != "offset"]).agg(F.min("offset").alias("offset"))
    return dedup_exact(d)


def _profile_input(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select("uid", "ts", *[F.col(f"deviceInfo.{c}").alias(c) for c in ("os", "ch", "md", "ba")],
                       "search_item", *extra)


def _profile_states(r: DataFrame) -> DataFrame:
    """Per (uid, wstart): last ``ts_ms``, records so far (pv) and the distinct values so far of each field (arrays).

    The records are first reduced to (uid, window) counts and to the first window of each (uid, field, value); the
    running totals are then window functions over those reduced rows, whose number per uid is bounded by its active
    windows and distinct values, not by its records.
    """
    per_win = r.groupBy("uid", "wstart").agg(F.count(F.lit(1)).alias("cnt"), F.max("ts").alias("ts_ms"))
    vals = (r.select("uid", "wstart", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))
                                                         for f in PROFILE_FIELDS])).alias("fv"))
            .where(F.col("fv.value").isNotNull())
            .groupBy("uid", F.col("fv.field").alias("field"), F.col("fv.value").alias("value"))
            .agg(F.min("wstart").alias("wstart")))
    u = (per_win.select("uid", "wstart", "cnt", "ts_ms", F.lit(None).cast("string").alias("field"),
                        F.lit(None).cast("string").alias("value"), F.lit(1).alias("kind"))
         .unionByName(vals.select("uid", "wstart", F.lit(0).cast("long").alias("cnt"),
                                  F.lit(None).cast("long").alias("ts_ms"), "field", "value", F.lit(0).alias("kind"))))
    w = Window.partitionBy("uid").orderBy("wstart", "kind").rowsBetween(Window.unboundedPreceding, 0)
    cols = [F.sum("cnt").over(w).alias("pv")]
    for f in PROFILE_FIELDS:
        cols.append(F.collect_set(F.when(F.col("field") == f, F.col("value"))).over(w).alias(f))
    return u.select("uid", "wstart", "ts_ms", "kind", *cols).where(F.col("kind") == 1).drop("kind")


def running_profile(rows: DataFrame, width="2 minutes") -> DataFrame:
    """A8 + A9 + A10: per uid and window, the last running state -- records
    seen so far (pv) and the sorted sets of os / ch / md / ba / search words."""
    s = _profile_states(_profile_input(rows).withColumn("wstart", window_start("ts", width)))
    return s.select("uid", "wstart", "ts_ms", "pv", *[sc.join_set(F.col(f)).alias(f) for f in PROFILE_FIELDS])


def running_profile_records(rows: DataFrame, chunk="1 hour") -> DataFrame:
    """A8 + A9 per record, in the order (ts, offset): every record gets its uid's running state, also when several
    share a millisecond.

    Two levels, so that no uid goes through one task: the state before each (uid, time chunk) comes from the reduced
    rows of ``_profile_states``; the running state inside a chunk is a window over (uid, chunk) alone. ``chunk``
    should hold a hot uid's records of that time in one task's memory.
    """
    r = _profile_input(rows, "offset").withColumn("wstart", window_start("ts", chunk))
    prev = Window.partitionBy("uid").orderBy("wstart")
    before = _profile_states(r).select("uid", "wstart", F.lag("pv", 1, 0).over(prev).alias("_pv"),
                                       *[F.lag(f).over(prev).alias(f"_{f}") for f in PROFILE_FIELDS])
    w = Window.partitionBy("uid", "wstart").orderBy("ts", "offset").rowsBetween(Window.unboundedPreceding, 0)
    inside = r.select("uid", "wstart", F.col("ts").alias("ts_ms"), F.count(F.lit(1)).over(w).alias("pv"),
                      *[F.collect_set(f).over(w).alias(f) for f in PROFILE_FIELDS])
    return inside.join(before, ["uid", "wstart"]).select(
        "uid", "ts_ms", (F.col("pv") + F.col("_pv")).alias("pv"),
        *[sc.join_set(F.concat(F.coalesce(F.col(f"_{f}"), F.array().cast("array<string>")), F.col(f))).alias(f)
          for f in PROFILE_FIELDS])


def base2(spark: SparkSession, pages: DataFrame, tree: DataFrame, compare: DataFrame, width="2 minutes") -> DataFrame:
    """Running profile per 2-minute window, os / search-class scoring."""
    p = running_profile(device_rows(pages), width)
    p = p.withColumn("judge_os", sc.first_token(F.col("os"), ","))
    # search words -> top category by category3 name (map load: the last duplicate wins, J12)
    tr = dedup_dim(tree.select(F.col("b3name").alias("_b3"), F.col("b1name").alias("b1_category")), "_b3", "last")
    p = p.join(tr, (p.search_item == tr._b3) & (F.col("search_item") != ""), "left").drop("_b3")
    # top category -> search class (first match of the compare list)
    cmp = (compare.groupBy("category_name").agg(F.min_by("search_category", "id").alias("_sc"))
           .withColumnRenamed("category_name", "_cn"))
    p = p.join(F.broadcast(cmp), p.b1_category == cmp._cn, "left").drop("_cn")
    p = p.withColumn("search_category", F.coalesce(F.col("_sc"), F.lit("unknown"))).drop("_sc")
    p = W.score(p, spark, "device", F.col("judge_os"))
    p = W.score(p, spark, "search", F.col("search_category"))
    return p.select("uid", "ts_ms", "pv", *PROFILE_FIELDS, "judge_os", "b1_category", "search_category",
                    *score_cols(BASE2_FAMILIES))


# ------------------------------------------------------------------ merge

def merge_2_4(b2: DataFrame, b4: DataFrame, hours: int = 24) -> DataFrame:
    """base2 ⋈ base4 on uid within ±24 h; columns are disjoint except uid/ts."""
    left = b2.withColumnRenamed("ts_ms", "base2_ts_ms")
    right = (b4.select("uid", "id", "detail_id", "ts_ms", "pay_time_slot", "total_amount", "tname", "b1_name",
                       *score_cols(BASE4_FAMILIES))
             .withColumnRenamed("uid", "b4_uid").withColumnRenamed("ts_ms", "base4_ts_ms"))
    j = interval_join(left, right, "uid", "b4_uid", "base2_ts_ms", "base4_ts_ms", -hours * HOUR, hours * HOUR,
                      copied="left")
    return j.drop("b4_uid").withColumn("ts_ms", F.col("base4_ts_ms"))


def merge_2_4_6(b24: DataFrame, b6: DataFrame, hours: int = 24) -> DataFrame:
    """The 2-4 result joined again with base6 on uid within ±24 h."""
    right = b6.select(F.col("uid").alias("b6_uid"), F.col("ts_ms").alias("base6_ts_ms"), "gender", "birthday",
                      "decade", "age", "zodiac_sign", "height", "weight")
    return interval_join(b24, right, "uid", "b6_uid", "ts_ms", "base6_ts_ms", -hours * HOUR, hours * HOUR) \
        .drop("b6_uid")


def age_band(b24: DataFrame) -> DataFrame:
    """Six weighted totals per row and the arg-max band."""
    t = W.band_totals(b24, BASE2_FAMILIES + BASE4_FAMILIES)
    return t.select("uid", "base2_ts_ms", "detail_id", "ts_ms", *[f"total_{b}" for b in W.BANDS], "age_band")
