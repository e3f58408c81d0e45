"""Edge cases of the scalar functions."""

import datetime as dt

from pyspark.sql import functions as F

from tidemart.functions import scalars as sc
from tidemart.functions import weights as W


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_epoch_day_and_reference_birthdays(spark):
    # golden rows of the reference: 1979-07-06 -> 1970s, Cancer, 45 as of May 2025
    b = sc.epoch_day_to_date(F.lit(3473))
    assert one(spark, F.date_format(b, "yyyy-MM-dd")) == "1979-07-06"
    assert one(spark, sc.decade(b)) == 1970
    assert one(spark, sc.zodiac(b)) == "巨蟹座"
    assert one(spark, sc.age_years(b, F.lit("2025-05-13").cast("date"))) == 45
    b2 = F.lit("2005-08-12").cast("date")
    assert one(spark, sc.zodiac(b2)) == "狮子座"
    assert one(spark, sc.age_years(b2, F.lit("2025-05-13").cast("date"))) == 19
    b3 = F.lit("1997-09-06").cast("date")
    assert one(spark, sc.zodiac(b3)) == "处女座"
    assert one(spark, sc.age_years(b3, F.lit("2025-05-13").cast("date"))) == 27


def test_age_leap_day(spark):
    b = F.lit("2000-02-29").cast("date")
    assert one(spark, sc.age_years(b, F.lit("2023-02-28").cast("date"))) == 22
    assert one(spark, sc.age_years(b, F.lit("2023-03-01").cast("date"))) == 23


def test_zodiac_boundaries(spark):
    cases = {"01-19": "摩羯座", "01-20": "水瓶座", "02-18": "水瓶座", "02-19": "双鱼座", "03-20": "双鱼座",
             "03-21": "白羊座", "04-19": "白羊座", "04-20": "金牛座", "05-20": "金牛座", "05-21": "双子座",
             "06-21": "双子座", "06-22": "巨蟹座", "07-22": "巨蟹座", "07-23": "狮子座", "08-22": "狮子座",
             "08-23": "处女座", "09-22": "处女座", "09-23": "天秤座", "10-23": "天秤座", "10-24": "天蝎座",
             "11-22": "天蝎座", "11-23": "射手座", "12-21": "射手座", "12-22": "摩羯座"}
    rows = spark.createDataFrame([(f"2001-{md}",) for md in cases], "d string") \
        .select("d", sc.zodiac(F.col("d").cast("date")).alias("z")).collect()
    got = {r["d"][5:]: r["z"] for r in rows}
    assert got == cases


def test_time_slot_boundaries(spark):
    base = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    hours = {5: "凌晨", 6: "早晨", 8: "早晨", 9: "上午", 11: "上午", 12: "中午", 13: "中午", 14: "下午", 17: "下午",
             18: "晚上", 21: "晚上", 22: "夜间", 23: "夜间"}
    df = spark.createDataFrame([(h, base + h * 3_600_000) for h in hours], "h int, ms long")
    got = {r["h"]: r["s"] for r in df.select("h", sc.time_slot("ms").alias("s")).collect()}
    assert got == hours


def test_amount_class_boundaries(spark):
    vals = {"999.99": "low", "1000": "high", "1000.01": "mid", "3999.99": "mid", "4000": "high", None: "low"}
    df = spark.createDataFrame([(k,) for k in vals], "a string")
    got = {r["a"]: r["c"] for r in df.select("a", W.amount_class(F.col("a")).alias("c")).collect()}
    assert got == vals


def test_last_token_java_split_semantics(spark):
    df = spark.createDataFrame([("a,b,c",), ("a,b,",), ("only",), ("x,,",)], "t string")
    got = [r["x"] for r in df.select(sc.last_token(F.col("t")).alias("x")).collect()]
    assert got == ["c", "b", "only", "x"]


def test_negate_and_json(spark):
    assert one(spark, sc.negate_str(F.lit("12.50"))) == "-12.50"
    df = spark.createDataFrame([("a", None, 3)], "skuId string, skuName string, ts long")
    js = df.select(sc.to_json_snake(df.columns, hidden=("ts",)).alias("j")).first()["j"]
    assert js == '{"sku_id":"a"}'


def test_millis_round_trip_is_zone_explicit(spark):
    ms = 1704067207179
    assert one(spark, sc.ms_to_datetime_str(F.lit(ms))) == "2024-01-01 00:00:07"
    assert one(spark, sc.ms_to_datetime_str(F.lit(ms), "Asia/Shanghai")) == "2024-01-01 08:00:07"
    assert one(spark, sc.datetime_str_to_ms(F.lit("2024-01-01 08:00:07"), "Asia/Shanghai")) == ms - 179
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert one(spark, sc.ms_to_date_str(F.lit(ms))) == "2024-01-01"
        # 1995-04-02 02:00 Shanghai is inside Los Angeles' spring-forward gap
        assert one(spark, sc.ms_to_datetime_str(F.lit(796759200000), "Asia/Shanghai")) == "1995-04-02 02:00:00"
        assert one(spark, sc.epoch_ms(F.lit("2024-07-01 12:00:00").cast("timestamp_ntz"))) == 1719835200000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scores_are_exact_decimals(spark):
    wt = W.weight_table(spark, "search")
    row = wt.where(F.col("key") == "性价比").first()
    assert str(row["search_35_39"]) == "0.105"   # 0.7 * 0.15, half-up at three places
