"""Page-log cleaning and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import first_token, ms_to_date_str
from .dedup import fix_is_new
from .envelope import dirty_split

LOG_SCHEMA = (
    "common struct<mid:string,uid:string,vc:string,ch:string,ar:string,is_new:string,os:string,md:string,"
    "ba:string,sid:string>, "
    "page struct<page_id:string,last_page_id:string,item:string,item_type:string,during_time:bigint>, "
    "ts bigint, "
    "displays array<struct<item:string,item_type:string,pos_id:int,order:int>>, "
    "actions array<struct<action_id:string,item:string,item_type:string,ts:bigint>>, "
    "start struct<entry:string,loading_time:bigint,open_ad_id:bigint>, "
    "err struct<error_code:bigint,msg:string>"
)


def parse_logs(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ("offset",)) -> tuple[DataFrame, DataFrame]:
    """P1 + parse: (parsed page-log records, dirty raw records).

    A record is parsed once: consumers' filters on its fields stay behind the one-element explode, where they would
    otherwise parse each record again for themselves.
    """
    ok, dirty = dirty_split(raw, value_col)
    parsed = ok.select(*keep, F.explode(F.array(F.from_json(F.col(value_col), LOG_SCHEMA))).alias("r")).select(*keep, "r.*")
    return parsed, dirty


def repair_is_new(logs: DataFrame, tz: str = "UTC", offset: str = "offset") -> DataFrame:
    """T8 over parsed logs: ``common.is_new`` corrected per mid."""
    day = ms_to_date_str(F.col("ts"), tz)
    prev = ms_to_date_str(F.col("ts") - 86_400_000, tz)
    fixed = fix_is_new(logs, F.col("common.mid"), "ts", offset, F.col("common.is_new"), day, prev)
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("is_new_fixed"))).drop("is_new_fixed")


def split_logs(logs: DataFrame, err_only: bool = False) -> dict[str, DataFrame]:
    """Five streams from one parsed frame.

    err: a copy of every record with ``err`` (P14: the ``err`` object only);
    start: records with ``start`` (minus err); page: the rest, minus err and the
    exploded arrays; display/action: one row per array element.
    """
    has_err = F.col("err").isNotNull()
    has_start = F.col("start").isNotNull()
    base_cols = [c for c in logs.columns if c != "err"]
    err = logs.where(has_err)
    err = err.select(*[c for c in logs.columns if c in ("offset",)], "err", "ts") if err_only else err
    start = logs.where(has_start).select(*base_cols)
    rest = logs.where(~has_start)
    page = rest.select(*[c for c in base_cols if c not in ("displays", "actions")])
    display = (rest.select(*[c for c in ("offset",) if c in logs.columns], "common", "page",
                           F.explode("displays").alias("display"), "ts"))
    action = (rest.select(*[c for c in ("offset",) if c in logs.columns], "common", "page",
                          F.explode("actions").alias("action")))
    return {"err": err, "start": start, "page": page, "display": display, "action": action}


def device_search_flatten(logs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Uid defaulted to -1, os = first token, search item only for keyword pages."""
    c = F.col("common")
    return logs.select(
        F.coalesce(c["uid"], F.lit("-1")).alias("uid"),
        F.col("ts"),
        F.struct(c["ar"].alias("ar"), c["ba"].alias("ba"), c["ch"].alias("ch"), c["md"].alias("md"),
                 first_token(c["os"], " ").alias("os"), c["uid"].alias("uid"), c["vc"].alias("vc"))
        .alias("deviceInfo"),
        F.when(F.col("page.item_type") == "keyword", F.col("page.item")).alias("search_item"),
        *keep,
    )
