"""Age-band scoring weights of the user-label model (F11-F16, A12) as tables.

The reference scores with long ``switch`` statements; here each family is a
small weight table (key -> six band weights) joined by broadcast. Scores are
``weight * coefficient`` rounded half-up to three places (F17), kept as
decimals so the sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]
SCORE_TYPE = "decimal(10,3)"

# Family coefficients.
COEF = {"device": 0.1, "search": 0.15, "pay_time": 0.1, "amount": 0.15, "tname": 0.2, "b1name": 0.3}

# Band weights per key, bands in the order of BANDS.
# Device by the first token of the os set; other systems get no device score.
DEVICE = {
    "iOS": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "Android": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
# Search class of the first-level category of the searched words; unknown -> 0.
SEARCH = {
    "时尚与潮流": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "性价比": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "健康与养生": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "家庭与育儿": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "科技与数码": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "学习与发展": (0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
}
SEARCH_DEFAULT = (0, 0, 0, 0, 0, 0)
# Payment hour slot.
PAY_TIME = {
    "凌晨": (0.2, 0.1, 0.1, 0.1, 0.1, 0.1),
    "早晨": (0.1, 0.1, 0.1, 0.1, 0.2, 0.3),
    "上午": (0.2, 0.2, 0.2, 0.2, 0.3, 0.4),
    "中午": (0.4, 0.4, 0.4, 0.4, 0.4, 0.3),
    "下午": (0.4, 0.5, 0.5, 0.5, 0.5, 0.4),
    "晚上": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "夜间": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
}
# Order amount: below 1000; above 1000 and below 4000; anything else.
AMOUNT = {
    "low": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "mid": (0.2, 0.4, 0.6, 0.7, 0.8, 0.7),
    "high": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6),
}
# Brand name; any other non-empty name takes the default row.
BRAND = {
    "TCL": (0.2, 0.3, 0.4, 0.5, 0.6, 0.7),
    "苹果": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "联想": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "小米": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "欧莱雅": (0.5, 0.6, 0.8, 0.8, 0.9, 0.2),
    "香奈儿": (0.3, 0.4, 0.6, 0.8, 0.9, 0.2),
}
BRAND_DEFAULT = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
# First-level category name; any other non-empty name takes the default row.
CATEGORY_GROUP_A = ["数码", "手机", "电脑办公", "个护化妆", "服饰内衣"]
CATEGORY_GROUP_B = ["家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"]
CATEGORY_A = (0.9, 0.8, 0.6, 0.4, 0.2, 0.1)
CATEGORY_B = (0.2, 0.4, 0.6, 0.8, 0.9, 0.7)
CATEGORY_DEFAULT = (0.1, 0.2, 0.4, 0.5, 0.8, 0.9)

DEFAULT_KEY = "\u0000default"


def _category() -> dict:
    d = {k: CATEGORY_A for k in CATEGORY_GROUP_A}
    d.update({k: CATEGORY_B for k in CATEGORY_GROUP_B})
    return d


FAMILIES = {
    "device": (DEVICE, None),
    "search": (SEARCH, SEARCH_DEFAULT),
    "pay_time": (PAY_TIME, None),
    "amount": (AMOUNT, None),
    "tname": (BRAND, BRAND_DEFAULT),
    "b1name": (_category(), CATEGORY_DEFAULT),
}


def weight_table(spark: SparkSession, family: str) -> DataFrame:
    """(key, <family>_<band> ...) scores = weight * coefficient; the default row
    (if the family has one) is keyed ``DEFAULT_KEY``."""
    rows, default = FAMILIES[family]
    items = list(rows.items()) + ([(DEFAULT_KEY, default)] if default is not None else [])
    schema = "key string, " + ", ".join(f"w{i} string" for i in range(6))
    df = spark.createDataFrame([(k, *[str(x) for x in ws]) for k, ws in items], schema)
    coef = F.lit(str(COEF[family])).cast("decimal(3,2)")
    return df.select("key", *[F.round(F.col(f"w{i}").cast("decimal(3,1)") * coef, 3).cast(SCORE_TYPE)
                             .alias(f"{family}_{b}") for i, b in enumerate(BANDS)])


def score(df: DataFrame, spark: SparkSession, family: str, key: Column, apply_when: Column | None = None) -> DataFrame:
    """Adds the six ``<family>_<band>`` columns looked up by ``key``.

    Keys missing from the table take the default row when the family has one
    (only where ``apply_when`` holds, e.g. a non-empty name); otherwise no score
    (null). The weight table is a few rows: broadcast.
    """
    wt = weight_table(spark, family)
    rows, default = FAMILIES[family]
    cond = apply_when if apply_when is not None else F.lit(True)
    known = F.array(*[F.lit(k) for k in rows])
    k = F.when(~cond, F.lit(None).cast("string"))
    if default is not None:
        k = k.when(F.array_contains(known, key), key).otherwise(F.lit(DEFAULT_KEY))
    else:
        k = k.otherwise(key)
    tagged = df.withColumn("_wkey", k)
    return (tagged.join(F.broadcast(wt), tagged["_wkey"] == wt["key"], "left").drop("_wkey", "key"))


def amount_class(total_amount: Column) -> Column:
    """<1000 low; >1000 and <4000 mid; else (incl. exactly 1000) high; missing = 0."""
    a = F.coalesce(total_amount.cast("double"), F.lit(0.0))
    return F.when(a < 1000, "low").when((a > 1000) & (a < 4000), "mid").otherwise("high")


def band_totals(df: DataFrame, families: list[str]) -> DataFrame:
    """Per band, the sum of the families' scores (missing = 0), and the arg-max
    band (ties go to the younger band)."""
    out = df
    for b in BANDS:
        total = None
        for f in families:
            c = F.coalesce(F.col(f"{f}_{b}"), F.lit(0).cast(SCORE_TYPE))
            total = c if total is None else total + c
        out = out.withColumn(f"total_{b}", total.cast("decimal(12,3)"))
    best = F.array_max(F.array(*[F.struct(F.col(f"total_{b}").alias("s"), F.lit(-i).alias("neg"),
                                          F.lit(b).alias("band")) for i, b in enumerate(BANDS)]))
    return out.withColumn("age_band", best["band"])
