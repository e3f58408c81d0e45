"""DWS windowed summaries (L10-L16, A1-A7, A13, A14) -- batch bodies.

Every aggregate is a hash aggregate on (window, keys): Spark combines map-side
before the shuffle, so even an un-keyed window (one group per window) ships
one partial row per map task. Dimension names are joined *after* the
aggregation (fewer rows to enrich), as the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_str_to_ms, empty_or_null, ms_to_date_str
from ..operators import dims as D
from ..operators.dedup import dedup_latest, first_of_day, retract_versions
from ..operators.windows import label_columns, window_start

MONEY = "decimal(20,2)"


def province_order(detail: DataFrame, province: DataFrame, width="10 seconds", tz: str = "UTC") -> DataFrame:
    """Retraction of superseded detail versions, then per (window, province)
    order amount and distinct order count, then the province name."""
    r = retract_versions(detail.select("id", "order_id", "province_id", "split_total_amount", "ts_ms", "seq"),
                         "id", "seq", ["split_total_amount"])
    w = r.withColumn("wstart", window_start("ts_ms", width))
    agg = (w.groupBy("wstart", "province_id")
           .agg(F.count_distinct("order_id").alias("order_count"),
                F.sum(F.coalesce(F.col("split_total_amount").cast("decimal(16,2)"), F.lit(0))).cast(MONEY)
                .alias("order_amount")))
    out = D.enrich(agg, province, "province_id", "id", {"province_name": "name"}, small=True)
    return out.select(*label_columns(width, tz), "province_id", "province_name", "order_count", "order_amount")


#: Amounts of the sku windows and the detail columns they sum.
SKU_AMOUNTS = {"original_amount": "split_original_amount", "activity_reduce_amount": "split_activity_amount",
               "coupon_reduce_amount": "split_coupon_amount", "order_amount": "split_total_amount"}


def sku_names(agg: DataFrame, sku: DataFrame, spu: DataFrame, tm: DataFrame, c3: DataFrame, c2: DataFrame,
              c1: DataFrame, width, tz: str = "UTC") -> DataFrame:
    """Window sums per sku -> sku -> spu / trademark / category3 -> 2 -> 1 names.

    The names are looked up for the skus, of which there are fewer than sums: a sum crosses one shuffle, by its sku."""
    names = sku.select(F.col("id").alias("_sku"), "sku_name", "spu_id", F.col("tm_id").alias("trademark_id"), "category3_id")
    names = D.enrich(names, spu, "spu_id", "id", {"spu_name": "spu_name"})
    names = D.enrich(names, tm, "trademark_id", "id", {"trademark_name": "tm_name"})
    names = D.category_cascade(names, "category3_id", c3, c2, c1)
    out = D.enrich(agg, names, "sku_id", "_sku", {c: c for c in names.columns if c != "_sku"})
    return out.select(*label_columns(width, tz), "trademark_id", "trademark_name", "category1_id", "category1_name",
                      "category2_id", "category2_name", "category3_id", "category3_name", "sku_id", "sku_name",
                      "spu_id", "spu_name", *SKU_AMOUNTS)


def sku_order(detail: DataFrame, sku: DataFrame, spu: DataFrame, tm: DataFrame, c3: DataFrame, c2: DataFrame,
              c1: DataFrame, width="10 seconds", tz: str = "UTC") -> DataFrame:
    """Latest version per detail id, sums per (window, sku), then
    sku -> spu / trademark / category3 -> 2 -> 1 names."""
    latest = dedup_latest(detail.select("id", "sku_id", *SKU_AMOUNTS.values(), "ts_ms", "seq"), "id", "ts_ms", "seq")
    agg = (latest.withColumn("wstart", window_start("ts_ms", width)).groupBy("wstart", "sku_id")
           .agg(*[F.sum(F.coalesce(F.col(src).cast("decimal(18,4)"), F.lit(0))).cast("decimal(22,4)").alias(dst)
                  for dst, src in SKU_AMOUNTS.items()]))
    return sku_names(agg, sku, spu, tm, c3, c2, c1, width, tz)


def cart_uu(cart: DataFrame, width="2 seconds", tz: str = "UTC") -> DataFrame:
    """Users whose first cart add of the day falls in each window."""
    firsts = first_of_day(cart.select("user_id", "ts_ms", "id"), "user_id", ms_to_date_str(F.col("ts_ms"), tz),
                          ["ts_ms", "id"])
    agg = (firsts.withColumn("wstart", window_start("ts_ms", width)).groupBy("wstart")
           .agg(F.count(F.lit(1)).alias("cart_add_uu_ct")))
    return agg.select(*label_columns(width, tz), "cart_add_uu_ct")


def home_detail_uv(page: DataFrame, width="10 seconds", tz: str = "UTC") -> DataFrame:
    """Per-mid first home / good_detail visit of each day, counted per window."""
    p = page.where(F.col("page.page_id").isin("home", "good_detail")).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts", "offset")
    firsts = first_of_day(p, "mid", F.concat_ws("|", F.col("page_id"), ms_to_date_str(F.col("ts"), tz)),
                          ["ts", "offset"])
    agg = (firsts.withColumn("wstart", window_start("ts", width)).groupBy("wstart")
           .agg(F.sum(F.when(F.col("page_id") == "home", 1).otherwise(0)).cast("long").alias("home_uv_ct"),
                F.sum(F.when(F.col("page_id") == "good_detail", 1).otherwise(0)).cast("long")
                .alias("good_detail_uv_ct")))
    return agg.select(*label_columns(width, tz), "home_uv_ct", "good_detail_uv_ct")


def traffic_dims(page: DataFrame, width="10 seconds", tz: str = "UTC") -> DataFrame:
    """Pv / uv / sv / duration per (window, vc, ch, ar, is_new).

    uv marks the first record of each (mid, day). Instead of joining that flag
    back, the first records are a second input of the same aggregate (uv=1,
    other measures 0): two partial aggregates, no join.
    """
    rows = page.select(F.col("common.mid").alias("mid"), F.col("common.vc").alias("vc"),
                       F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
                       F.col("common.is_new").alias("is_new"), F.col("page.last_page_id").alias("last_page_id"),
                       F.col("page.during_time").alias("during_time"), "ts", "offset")
    pv = rows.select("vc", "ch", "ar", "is_new", "ts", F.lit(0).alias("uv"),
                     F.when(empty_or_null(F.col("last_page_id")), 1).otherwise(0).alias("sv"),
                     F.lit(1).alias("pv"), F.coalesce(F.col("during_time"), F.lit(0)).alias("dur"))
    firsts = first_of_day(rows, "mid", ms_to_date_str(F.col("ts"), tz), ["ts", "offset"])
    uv = firsts.select("vc", "ch", "ar", "is_new", "ts", F.lit(1).alias("uv"), F.lit(0).alias("sv"),
                       F.lit(0).alias("pv"), F.lit(0).cast("long").alias("dur"))
    agg = (pv.unionByName(uv).withColumn("wstart", window_start("ts", width))
           .groupBy("wstart", "vc", "ch", "ar", "is_new")
           .agg(F.sum("uv").cast("long").alias("uv_ct"), F.sum("sv").cast("long").alias("sv_ct"),
                F.sum("pv").cast("long").alias("pv_ct"), F.sum("dur").cast("long").alias("dur_sum")))
    return agg.select(*label_columns(width, tz), "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum")


def login_events(page: DataFrame) -> DataFrame:
    """Uid non-empty and (last page is login or empty)."""
    lp = F.col("page.last_page_id")
    return page.where(~empty_or_null(F.col("common.uid")) & ((lp == "login") | empty_or_null(lp)))


def user_login(page: DataFrame, width="10 seconds", tz: str = "UTC", back_days: int = 8) -> DataFrame:
    """Unique-per-day logins and returning users (>= 8 days since the last
    login date). Pre-aggregating to (uid, day) bounds the per-uid window by the
    number of distinct days, whatever the key skew."""
    days = (login_events(page).select(F.col("common.uid").alias("uid"), "ts")
            .withColumn("day", ms_to_date_str(F.col("ts"), tz))
            .groupBy("uid", "day").agg(F.min("ts").alias("ts")))
    from pyspark.sql import Window
    w = Window.partitionBy("uid").orderBy("day")
    prev = F.lag("day").over(w)
    gap = F.floor((F.col("ts") - date_str_to_ms(prev, tz)) / 86_400_000)
    flagged = days.select("ts", F.when(prev.isNotNull() & (gap >= back_days), 1).otherwise(0).alias("back"))
    agg = (flagged.withColumn("wstart", window_start("ts", width)).groupBy("wstart")
           .agg(F.sum("back").cast("long").alias("back_ct"), F.count(F.lit(1)).alias("uu_ct")))
    return agg.select(*label_columns(width, tz), "back_ct", "uu_ct")


def keyword(words: DataFrame, width="2 seconds", tz: str = "UTC") -> DataFrame:
    """Keyword counts per window (``words`` has ts + keyword)."""
    agg = (words.withColumn("wstart", window_start("ts", width)).groupBy("wstart", "keyword")
           .agg(F.count(F.lit(1)).alias("keyword_count")))
    return agg.select(*label_columns(width, tz), "keyword", "keyword_count")


def rollup_province_amount(province_result: DataFrame) -> DataFrame:
    """Order amount per province name over a province-window result."""
    return (province_result.groupBy("province_name")
            .agg(F.sum("order_amount").cast(MONEY).alias("order_amount")))


def rollup_uv_by_channel(traffic_result: DataFrame) -> DataFrame:
    """Unique visitors per channel over a traffic-window result."""
    return traffic_result.groupBy("ch").agg(F.sum("uv_ct").cast("long").alias("uv_ct"))
