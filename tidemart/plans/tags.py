"""User tags specified only in the design note.

The note gives rules, not code; where it is silent the reading taken is
stated on the function (and in README). All tags are per-user aggregates, so
each is a partial hash aggregate keyed by user (a hot user adds one partial
row per map task, never a whole group in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..functions import weights as W

# Age ranges (upper bound exclusive) of the age tag.
AGE_RANGES = [(25, "18-24"), (30, "25-29"), (35, "30-34"), (40, "35-39"), (50, "40-49")]
AGE_RANGE_TOP = "50+"
BAND_TO_RANGE = dict(zip(W.BANDS, ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"]))

# Generation by birth decade.
GENERATIONS = [(2000, "post-00s"), (1990, "post-90s"), (1980, "post-80s"), (1970, "post-70s"), (1960, "post-60s")]

# Behaviour weights of the gender tag (purchase, cart/favourite, browse).
GENDER_WEIGHTS = {"purchase": 0.5, "cart": 0.3, "browse": 0.2}
# Our reading: first-level categories leaning female / male; any other is family.
FEMALE_CATEGORIES = ["母婴", "个护化妆", "服饰内衣", "家居家装"]
MALE_CATEGORIES = ["数码", "手机", "电脑办公", "家用电器", "汽车用品"]

# Unit conversions and valid ranges of body readings.
LB_TO_KG = "0.4536"
JIN_TO_KG = "0.5"
IN_TO_CM = "2.54"
WEIGHT_RANGE = (30, 200)
HEIGHT_RANGE = (100, 250)
SOURCE_PRIORITY = {"device": 1.0, "order": 0.8, "profile": 0.6}


def age_range(age: Column) -> Column:
    expr = F.when(age.isNull(), F.lit(None).cast("string"))
    for upper, label in AGE_RANGES:
        expr = expr.when(age < upper, F.lit(label))
    return expr.otherwise(F.lit(AGE_RANGE_TOP))


def tag_age(users: DataFrame, age_bands: DataFrame) -> DataFrame:
    """G1: birth year when present (confidence 1), else the behaviour band
    with the largest summed total (confidence = its share of all totals).

    ``users``: uid, birthday (yyyy-MM-dd), age. ``age_bands``: uid + total_<band>.
    """
    u = users.select(F.col("uid").alias("user_id"), F.year(F.to_date("birthday")).alias("birth_year"),
                     age_range(F.col("age")).alias("age_range"))
    sums = age_bands.groupBy("uid").agg(*[F.sum(f"total_{b}").alias(f"t_{b}") for b in W.BANDS])
    best = F.array_max(F.array(*[F.struct(F.col(f"t_{b}").alias("s"), F.lit(-i).alias("neg"),
                                          F.lit(BAND_TO_RANGE[b]).alias("r")) for i, b in enumerate(W.BANDS)]))
    total = sum((F.col(f"t_{b}") for b in W.BANDS), F.lit(0))
    beh = sums.select(F.col("uid").alias("user_id"), best["r"].alias("b_range"),
                      F.when(total > 0, best["s"] / total).otherwise(F.lit(0)).alias("b_conf"))
    j = u.join(beh, "user_id", "full")
    has_year = F.col("birth_year").isNotNull()
    return j.select(
        "user_id",
        F.when(has_year, F.col("age_range")).otherwise(F.col("b_range")).alias("age_range"),
        F.when(has_year, F.lit(1)).otherwise(F.col("b_conf")).cast("decimal(5,2)").alias("confidence_score"),
        F.when(has_year, F.lit("birth_year")).otherwise(F.lit("behavior_analysis")).alias("data_source"),
        "birth_year")


def behaviour_events(pages: DataFrame, actions: DataFrame) -> DataFrame:
    """(uid, ts, kind, item) behaviour rows: payment pages = purchase, cart/favour
    actions = cart, product detail pages = browse."""
    p = pages.where(F.col("common.uid").isNotNull()).select(
        F.col("common.uid").alias("uid"), "ts", F.col("page.item").alias("item"),
        F.when(F.col("page.page_id") == "payment", "purchase")
        .when(F.col("page.page_id") == "good_detail", "browse").alias("kind"))
    a = actions.where(F.col("common.uid").isNotNull()).select(
        F.col("common.uid").alias("uid"), F.col("action.ts").alias("ts"), F.col("action.item").alias("item"),
        F.lit("cart").alias("kind"))
    return p.unionByName(a).where(F.col("kind").isNotNull())


def tag_gender(events: DataFrame, sku_category: DataFrame) -> DataFrame:
    """Weighted behaviour per category lean; female if the female score
    exceeds the male one by more than 10 %, male symmetrically, else family.

    ``sku_category``: (sku_id, b1name) -- joined plainly (grows with skus)."""
    w = F.create_map(*[e for k, v in GENDER_WEIGHTS.items() for e in (F.lit(k), F.lit(str(v)))])
    e = events.join(sku_category, events.item == sku_category.sku_id, "inner")
    lean = (F.when(F.col("b1name").isin(*FEMALE_CATEGORIES), "female")
            .when(F.col("b1name").isin(*MALE_CATEGORIES), "male").otherwise("family"))
    s = e.select("uid", "b1name", lean.alias("lean"), w[F.col("kind")].cast("decimal(4,2)").alias("w"))
    per_cat = s.groupBy("uid", "b1name").agg(F.sum("w").alias("cw"))
    main = per_cat.groupBy("uid").agg(F.max_by("b1name", F.struct(F.col("cw"), F.col("b1name"))).alias("main_category"))
    agg = s.groupBy("uid").agg(*[F.sum(F.when(F.col("lean") == g, F.col("w")).otherwise(0)).cast("decimal(12,2)")
                                 .alias(f"{g}_score") for g in ("female", "male", "family")])
    g = (F.when(F.col("female_score") > F.col("male_score") * F.lit(1.1).cast("decimal(3,1)"), "female")
         .when(F.col("male_score") > F.col("female_score") * F.lit(1.1).cast("decimal(3,1)"), "male")
         .otherwise("family"))
    return agg.join(main, "uid").select(F.col("uid").alias("user_id"), g.alias("gender"), "female_score",
                                        "male_score", "family_score", "main_category")


def _latest_by_priority(readings: DataFrame) -> DataFrame:
    prio = F.create_map(*[e for k, v in SOURCE_PRIORITY.items() for e in (F.lit(k), F.lit(v))])
    r = readings.withColumn("prio", prio[F.col("data_source")])
    payload = F.struct(*[F.col(c) for c in readings.columns])
    return (r.groupBy("user_id").agg(F.max_by(payload, F.struct("prio", "ts")).alias("_r")).select("_r.*"))


def tag_weight(readings: DataFrame) -> DataFrame:
    """(user_id, value, unit, data_source, ts) -> kg, 30-200 kept, highest
    source priority then latest reading wins."""
    v = F.col("value").cast("decimal(10,2)")
    kg = (F.when(F.col("unit") == "lb", v * F.lit(LB_TO_KG).cast("decimal(6,4)"))
          .when(F.col("unit") == "jin", v * F.lit(JIN_TO_KG).cast("decimal(6,4)")).otherwise(v))
    r = readings.withColumn("weight", F.round(kg, 1).cast("decimal(5,1)"))
    r = r.where(F.col("weight").between(*WEIGHT_RANGE))
    best = _latest_by_priority(r.select("user_id", "weight", "data_source", "ts"))
    return best.select("user_id", "weight", "data_source", F.lit(0).alias("is_abnormal"))


def tag_height(readings: DataFrame, mean: bool = False) -> DataFrame:
    """Cm, 100-250 kept; mode of the last three valid readings (ties to
    the latest), or their mean with ``mean=True``."""
    v = F.col("value").cast("decimal(10,2)")
    cm = F.when(F.col("unit") == "in", v * F.lit(IN_TO_CM).cast("decimal(4,2)")).otherwise(v)
    r = readings.withColumn("height", F.round(cm, 0).cast("int")).where(F.col("height").between(*HEIGHT_RANGE))
    # row_number() <= 3 cuts each map task to three readings a user before the shuffle
    latest = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("height"), F.desc("data_source"))
    x = (r.select("user_id", "ts", "height", "data_source", F.row_number().over(latest).alias("_n"))
         .where(F.col("_n") <= 3).drop("_n"))
    if mean:
        return x.groupBy("user_id").agg(F.round(F.avg("height")).cast("int").alias("height"),
                                        F.max_by("data_source", "ts").alias("data_source"))
    cnt = x.groupBy("user_id", "height").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("ts"),
                                             F.max_by("data_source", "ts").alias("data_source"))
    return (cnt.groupBy("user_id").agg(F.max_by(F.struct("height", "data_source"), F.struct("n", "ts")).alias("m"))
            .select("user_id", "m.height", "m.data_source"))


def tag_zodiac(users: DataFrame) -> DataFrame:
    """English sign from the birthday; unknown without one."""
    b = F.to_date("birthday")
    return users.select(F.col("uid").alias("user_id"),
                        F.coalesce(F.lower(sc.zodiac(b, english=True)), F.lit("unknown")).alias("zodiac"),
                        "birthday", F.lit("profile").alias("birthday_source"))


def generation(birth_year: Column) -> Column:
    expr = F.when(birth_year.isNull(), F.lit(None).cast("string"))
    for start, label in GENERATIONS:
        expr = expr.when((birth_year >= start) & (birth_year < start + 10), F.lit(label))
    return expr.otherwise(F.lit("other"))


def tag_generation(users: DataFrame) -> DataFrame:
    """Decade of the birth year -> post-60s ... post-00s, else other."""
    y = F.year(F.to_date("birthday"))
    return users.select(F.col("uid").alias("user_id"), generation(y).alias("generation"), y.alias("birth_year"),
                        F.lit("profile").alias("data_source"))


def tag_update_log(old: DataFrame, new: DataFrame, tag_type: str, value_col: str) -> DataFrame:
    """Full outer join of two tag snapshots on user; changed, added and
    removed values become log rows."""
    o = old.select("user_id", F.col(value_col).cast("string").alias("old_value"))
    n = new.select("user_id", F.col(value_col).cast("string").alias("new_value"))
    j = o.join(n, "user_id", "full")
    changed = ~F.col("old_value").eqNullSafe(F.col("new_value"))
    return j.where(changed).select("user_id", F.lit(tag_type).alias("tag_type"), "old_value", "new_value",
                                   F.lit("recompute").alias("update_reason"), F.lit("system").alias("operator"))


SUMMARY_COUNTS = ["view_count", "search_count", "favorite_count", "cart_count", "order_count", "payment_count",
                  "live_view_count", "comment_count", "share_count"]


def behavior_summary(pages: DataFrame, actions: DataFrame, purchases: DataFrame, comments: DataFrame,
                     tz: str = "UTC") -> DataFrame:
    """Daily per-user counts from three sources, unioned then summed (no
    joins); device type = os of the day's first page."""
    day = lambda ts: sc.ms_to_date_str(ts, tz)
    zero = {c: F.lit(0) for c in SUMMARY_COUNTS}

    def rows(df, uid, ts, counts, os=None):
        cols = {**zero, **counts}
        return df.select(uid.cast("long").alias("user_id"), day(ts).alias("data_date"), ts.alias("ts"),
                         *[cols[c].alias(c) for c in SUMMARY_COUNTS],
                         (os if os is not None else F.lit(None).cast("string")).alias("os"))

    p = pages.where(F.col("common.uid").isNotNull())
    pg = rows(p, F.col("common.uid"), F.col("ts"), {
        "view_count": F.when(F.col("page.page_id") == "good_detail", 1).otherwise(0),
        "search_count": F.when(F.col("page.item_type") == "keyword", 1).otherwise(0),
        "order_count": F.when(F.col("page.page_id") == "payment", 1).otherwise(0)}, F.col("common.os"))
    a = actions.where(F.col("common.uid").isNotNull())
    ac = rows(a, F.col("common.uid"), F.col("action.ts"), {
        "favorite_count": F.when(F.col("action.action_id") == "favor_add", 1).otherwise(0),
        "cart_count": F.when(F.col("action.action_id") == "cart_add", 1).otherwise(0)})
    pu = rows(purchases, F.col("user_id"), F.col("ts_ms"), {"payment_count": F.lit(1)})
    cm = rows(comments, F.col("user_id"), F.col("create_time"), {"comment_count": F.lit(1)})
    u = pg.unionByName(ac).unionByName(pu).unionByName(cm)
    return (u.groupBy("user_id", "data_date")
            .agg(*[F.sum(c).cast("int").alias(c) for c in SUMMARY_COUNTS],
                 F.min_by("os", F.when(F.col("os").isNotNull(), F.col("ts"))).alias("device_type")))
