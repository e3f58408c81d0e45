"""Comment facts (L17, L18, J9): dictionary enrichment with a default, the
comment ⋈ order interval join, the partition column and the sensitive-word check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators.dims import bounded
from ..operators.envelope import cdc_demux, image
from ..operators.joins import interval_join
from ..operators.text import flag_last_word

MIN = 60_000


def enrich_dic_default(topic: DataFrame, dic: DataFrame) -> DataFrame:
    """Comment records + dic_name looked up by md5(appraise); missing -> 'N/A'.
    The dictionary is keyed by md5 of its code, as the wide-column dim is."""
    c = cdc_demux(topic, "comment_info")
    d = dic.select(sc.md5_key(F.col("dic_code")).alias("_rk"), F.col("dic_name").alias("_dn"))
    j = c.join(bounded(d), sc.md5_key(F.col("after")["appraise"]) == F.col("_rk"), "left")
    return j.withColumn("dic_name", F.coalesce(F.col("_dn"), F.lit("N/A"))).drop("_rk", "_dn")


def comment_flat(enriched: DataFrame) -> DataFrame:
    a = F.col("after")
    return enriched.select(
        "ts_ms", F.col("source")["db"].alias("db"), F.col("source")["table"].alias("table"),
        a["appraise"].alias("appraise"), a["comment_txt"].alias("commentTxt"), "op",
        a["create_time"].cast("long").alias("create_time"), a["user_id"].cast("long").alias("user_id"),
        a["sku_id"].cast("long").alias("sku_id"), a["id"].alias("id"), a["spu_id"].cast("long").alias("spu_id"),
        a["order_id"].cast("long").alias("order_id"), "dic_name")


INFO_FIELDS = ["id", "user_id", "consignee", "total_amount", "order_status", "create_time"]


def order_image(topic: DataFrame) -> DataFrame:
    """P7 variant 2: order rows from the non-empty image, with op and tm_ms; columns prefixed info_."""
    o = cdc_demux(topic, "order_info")
    img = image(o, "nonempty")
    return o.select(F.col("op").alias("info_op"), F.col("ts_ms").alias("info_tm_ms"),
                    *[img[f].alias(f"info_{f}") for f in INFO_FIELDS])


def comment_order_join(topic: DataFrame, dic: DataFrame) -> DataFrame:
    """Comments ⋈ orders (order_id = id) within ±1 minute."""
    c = comment_flat(enrich_dic_default(topic, dic))
    o = order_image(topic).withColumn("_oid", F.col("info_id").cast("long"))
    return interval_join(c, o, "order_id", "_oid", "ts_ms", "info_tm_ms", -MIN, MIN).drop("_oid")


def comment_wide(topic: DataFrame, dic: DataFrame, tz: str = "UTC") -> DataFrame:
    """Joined comment facts plus the ``ds`` partition column (yyyyMMdd of ts_ms)."""
    return comment_order_join(topic, dic).withColumn("ds", sc.ms_to_compact_date(F.col("ts_ms"), tz))


def sensitive_check(wide: DataFrame, words: DataFrame) -> DataFrame:
    """Last comma token checked against the word list."""
    f = flag_last_word(wide, "commentTxt", words)
    return f.select("user_id", F.col("info_consignee").alias("consignee"), "ts_ms", "ds",
                    F.col("commentTxt").alias("msg"), "is_violation", "violation_grade", "violation_msg")
