"""Dimension operators.

Per-row lookups of the reference (RPC to a wide-column store, async I/O, a
row cache) become joins. ``bounded()`` marks dims whose size is fixed by the
business (dictionary, config, provinces, category levels 1-2, weight tables):
only those are broadcast. Dims that grow with the data (sku, spu, users) are
joined plainly; AQE turns them into a broadcast join at runtime when the
measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and
keeps the shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import md5_key
from .envelope import keep_keys


def bounded(dim: DataFrame) -> DataFrame:
    """Broadcast hint for a dim whose row count is bounded by construction."""
    return F.broadcast(dim)


def enrich(df: DataFrame, dim: DataFrame, left_key: str, right_key: str, cols: dict[str, str],
           default: str | None = None, small: bool = False) -> DataFrame:
    """Add ``cols`` ({out: dim_col}) looked up by key; a missing dim row
    leaves the row unchanged (left join), or fills ``default`` (J9)."""
    d = dim.select(F.col(right_key).alias("_dk"), *[F.col(v).alias(f"_d_{k}") for k, v in cols.items()])
    d = bounded(d) if small else d
    j = df.join(d, F.col(left_key) == F.col("_dk"), "left").drop("_dk")
    for k in cols:
        v = F.col(f"_d_{k}")
        j = j.withColumn(k, F.coalesce(v, F.lit(default)) if default is not None else v).drop(f"_d_{k}")
    return j


def dedup_dim(dim: DataFrame, key: str, keep: str = "first", order: list[str] | None = None) -> DataFrame:
    """One row per key, so that a join with it multiplies no row; list scans keep the first match, map loads the
    last, by ``order`` (the load order; all columns if the dimension has none)."""
    o = F.struct(*[F.col(c) for c in (order or dim.columns)])
    payload = F.struct(*[F.col(c) for c in dim.columns])
    agg = F.min_by(payload, o) if keep == "first" else F.max_by(payload, o)
    return dim.groupBy(key).agg(agg.alias("_r")).select("_r.*")


def category_tree(c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """category3 ⋈ category2 ⋈ category1 -> (id, b3name, b2name, b1name)."""
    return (c3.alias("b3").join(c2.alias("b2"), F.col("b3.category2_id") == F.col("b2.id"))
            .join(bounded(c1.alias("b1")), F.col("b2.category1_id") == F.col("b1.id"))
            .select(F.col("b3.id").alias("id"), F.col("b3.name").alias("b3name"),
                    F.col("b2.name").alias("b2name"), F.col("b1.name").alias("b1name")))


def sku_wide(sku: DataFrame, spu: DataFrame, tm: DataFrame) -> DataFrame:
    """Sku ⋈ spu ⋈ trademark -> (skuid, spuid, c3id, tname)."""
    return (sku.alias("s").join(spu.alias("p"), F.col("s.spu_id") == F.col("p.id"))
            .join(tm.alias("t"), F.col("s.tm_id") == F.col("t.id"))
            .select(F.col("s.id").alias("skuid"), F.col("s.spu_id").alias("spuid"),
                    F.col("s.category3_id").alias("c3id"), F.col("t.tm_name").alias("tname")))


def category_cascade(df: DataFrame, c3_col: str, c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """category3 -> 2 -> 1, each step supplying the next key (left joins)."""
    out = enrich(df, c3, c3_col, "id", {"category3_name": "name", "category2_id": "category2_id"})
    out = enrich(out, c2, "category2_id", "id", {"category2_name": "name", "category1_id": "category1_id"},
                 small=True)
    return enrich(out, c1, "category1_id", "id", {"category1_name": "name"}, small=True)


def point_lookup(keys: DataFrame, key_col: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Row-key reads -> the dim row or nulls (a left join, never a per-row RPC)."""
    d = dim.select(*[F.col(c).alias(f"dim_{c}") for c in dim.columns])
    return keys.join(d, F.col(key_col) == F.col(f"dim_{dim_key}"), "left")


def latest_config(cfg_feed: DataFrame, key: str = "source_table", seq: str = "seq") -> DataFrame:
    """J13 config state: the last record per config key, minus deletes."""
    payload = F.struct(*[F.col(c) for c in cfg_feed.columns])
    last = cfg_feed.groupBy(key).agg(F.max_by(payload, F.col(seq)).alias("_r")).select("_r.*")
    return last.where(F.col("op") != "d")


def route(env: DataFrame, cfg: DataFrame, carry: list[str] = ()) -> DataFrame:
    """J13 + P8: envelopes of configured tables joined to their config row
    (config is one row per source table: bounded, broadcast), with the image
    pruned to the configured columns. ``carry``: further config columns to keep."""
    # the list is split once a table, on the config's side
    c = cfg.select("source_table", "sink_table", F.split("sink_columns", ",").alias("_keep"), "sink_row_key", *carry)
    j = env.join(bounded(c), env["source"]["table"] == c["source_table"], "inner")
    return j.select(
        F.col("source")["table"].alias("source_table"), "sink_table", "sink_row_key", "op", "ts_ms", "seq", *carry,
        keep_keys(F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")), F.col("_keep")).alias("data"),
    )


def _cell(c: str) -> Column:
    """A cell's value, null where it is empty."""
    v = F.col("data")[c]
    return F.when(v != "", v)


def upsert_merge(routed: DataFrame, columns: list[str]) -> DataFrame:
    """K6: dimension rows after put/delete records.

    A delete removes the row; a put writes only its non-empty cells, so older
    cells survive. Per (sink table, row key): only records after the last
    delete count, and each column takes its last non-empty value.

    One shuffle: a record travels once with its position, not once a column.
    """
    r = routed.select("sink_table", F.col("data")[F.col("sink_row_key")].alias("row_key"), "op", "seq",
                      *[_cell(c).alias(c) for c in columns])
    live = _after_last_delete(r)
    w = Window.partitionBy("sink_table", "row_key").orderBy("seq")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (live.select("sink_table", "row_key", F.lead(F.lit(True)).over(w).alias("_later"),
                        *[F.last(c, ignorenulls=True).over(whole).alias(c) for c in columns])
            .where(F.col("_later").isNull()).drop("_later"))


def _after_last_delete(r: DataFrame) -> DataFrame:
    """The puts after the last delete of their (sink table, row key); a record without a row key is deleted by none."""
    w = Window.partitionBy("sink_table", "row_key")
    gone = F.when(F.col("row_key").isNotNull(), F.max(F.when(F.col("op") == "d", F.col("seq"))).over(w))
    return (r.withColumn("_del_seq", gone).where(F.col("op") != "d")
            .where(F.col("_del_seq").isNull() | (F.col("seq") > F.col("_del_seq"))).drop("_del_seq"))


def upsert_merge_map(routed: DataFrame) -> DataFrame:
    """K6, generic over the image map: (sink_table, row_key, data map).

    A row key's records meet in one shuffle. Where only one is left, its cells are the row; only the others are
    exploded to (table, key, column) groups, each cell taking its last non-empty value."""
    r = routed.select("sink_table", F.col("data")[F.col("sink_row_key")].alias("row_key"), "op", "seq", "data")
    key = Window.partitionBy("sink_table", "row_key")
    live = _after_last_delete(r).withColumn("_n", F.count(F.lit(1)).over(key))
    full = F.map_filter("data", lambda _, v: F.coalesce(v, F.lit("")) != "")
    # a row without a key is one row without cells
    single = live.where("_n = 1").select("sink_table", "row_key", F.when(F.col("row_key").isNotNull() & (F.size(full) > 0), full)
                                         .alias("data"))
    many = live.where("_n > 1").select("sink_table", "row_key", "seq", F.explode_outer(
        F.when(F.col("row_key").isNotNull(), full)).alias("col", "val"))
    # max over (seq, val) per cell; a row mark (no column) keeps rows whose cells are all empty
    merged = (many.groupBy("sink_table", "row_key", "col").agg(F.max_by("val", "seq").alias("val"))
              .groupBy("sink_table", "row_key")
              .agg(F.collect_list(F.when(F.col("col").isNotNull(), F.struct("col", "val"))).alias("es"))
              .select("sink_table", "row_key", F.when(F.size("es") > 0, F.map_from_entries("es")).alias("data")))
    return single.unionByName(merged)


def upsert_md5(routed: DataFrame, columns: list[str]) -> DataFrame:
    """K7: row key = md5 hex of the key, whole row written, deletes ignored."""
    r = routed.where(F.col("op") != "d").select(
        "sink_table", F.col("data")[F.col("sink_row_key")].alias("_key"), "seq", *[F.col("data")[c].alias(c) for c in columns])
    last = Window.partitionBy("sink_table", "_key").orderBy(F.col("seq").desc())
    return (r.withColumn("_n", F.row_number().over(last)).where("_n = 1")
            .select("sink_table", md5_key(F.col("_key")).alias("row_key"), *columns))


def table_plan(cfg_feed: DataFrame) -> DataFrame:
    """DDL action per config record: r/c create, d drop, u drop + create."""
    action = (F.when(F.col("op").isin("r", "c"), F.array(F.lit("create")))
              .when(F.col("op") == "d", F.array(F.lit("drop")))
              .when(F.col("op") == "u", F.array(F.lit("drop"), F.lit("create"))))
    return (cfg_feed.select("seq", "op", "sink_table", "sink_family", "sink_columns",
                            F.posexplode(action).alias("step", "action"))
            .select("seq", "step", "action", "sink_table", "sink_family",
                    F.when(F.col("action") == "create", F.col("sink_columns")).alias("columns")))
