"""Keyed-state operators, batch bodies.

Where the semantics only need "the first / last row of a key" we use
``min_by`` / ``max_by`` aggregates: Spark combines them map-side, so a key that
holds a third of all rows still reaches the shuffle as one partial row per map
task. Only order-dependent scans (T8's later rows, T12) need a window, and
those run after a per-key pre-aggregation or a join that AQE's skew handling
can split.

The streaming bodies live in ``tidemart.streaming.processors``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in ([xs] if isinstance(xs, (str, Column)) else xs)]


def _order_struct(order) -> Column:
    cs = _cols(order)
    return F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(cs)])


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Last row per key by ``order`` (T10 / K4 / A10): partial-aggregated ``max_by``."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    payload = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(*ks).agg(F.max_by(payload, _order_struct(order)).alias("_r"))
            .select("_r.*"))


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """First row per key by ``order`` (T7 filter form, T14 first arrival)."""
    ks = [keys] if isinstance(keys, (str, Column)) else list(keys)
    payload = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(*ks).agg(F.min_by(payload, _order_struct(order)).alias("_r"))
            .select("_r.*"))


def dedup_latest(df: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """Latest version per key -- max ``ts`` (compared as text, as built),
    ties to the later arrival."""
    return latest_per_key(df, key, [F.col(ts).cast("string"), F.col(seq)])


def upsert_latest(df: DataFrame, pk, seq: str) -> DataFrame:
    """K4 table view of an upsert topic: the last arrival per primary key."""
    return latest_per_key(df, pk, [seq])


def first_of_day(df: DataFrame, key: str, day: Column, order) -> DataFrame:
    """T7 filter form: the first row of each (key, day)."""
    return first_per_key(df.withColumn("_day", day), [key, "_day"], order).drop("_day")


def dedup_exact(df: DataFrame) -> DataFrame:
    """Whole-record dedup (hash aggregate on every column)."""
    return df.dropDuplicates()


def dedup_composite(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Exact form of the Bloom-filter dedup on (order_id, ts_ms): the first
    arrival of each composite key (keeps every row the filter keeps, and the
    filter's false drops too)."""
    return first_per_key(df, keys, [seq])


def arrival_chunk(seq: str, width: int = 1_000_000) -> Column:
    """Chunk of an arrival position: the number in ``seq`` div ``width``, whatever its padding."""
    return F.floor(F.col(seq).try_cast("decimal(38,0)") / F.lit(width).cast("decimal(20,0)"))


def strictly_newer(df: DataFrame, key: str, ts: str, seq: str, chunk: Column | None = None) -> DataFrame:
    """Pass a row only if its ``ts`` is greater than every earlier arrival's
    (the first row of a key always passes).

    ``chunk`` (an order-preserving coarsening of ``seq``, see ``arrival_chunk``)
    makes the scan two-level so a hot key is not sorted in one task: the max
    of every earlier chunk comes from a small per-(key, chunk) aggregate, and
    the running max inside a chunk is a window over (key, chunk) only.
    """
    if chunk is None:
        w = (Window.partitionBy(key).orderBy(F.col(seq))
             .rowsBetween(Window.unboundedPreceding, -1))
        marked = df.withColumn("_prev_max", F.max(F.col(ts)).over(w))
    else:
        c = df.withColumn("_chunk", chunk)
        per_chunk = c.groupBy(key, "_chunk").agg(F.max(ts).alias("_cmax"))
        before = per_chunk.withColumn("_before", F.max("_cmax").over(
            Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))) \
            .select(F.col(key).alias("_k"), F.col("_chunk").alias("_c"), "_before")
        inside = Window.partitionBy(key, "_chunk").orderBy(F.col(seq)).rowsBetween(Window.unboundedPreceding, -1)
        same = c[key].eqNullSafe(before["_k"]) & c["_chunk"].eqNullSafe(before["_c"])
        marked = (c.join(before, same, "left").drop("_k", "_c")
                  .withColumn("_prev_max", F.greatest(F.col("_before"), F.max(F.col(ts)).over(inside)))
                  .drop("_chunk", "_before"))
    return marked.where(F.col("_prev_max").isNull() | (F.col(ts) > F.col("_prev_max"))).drop("_prev_max")


def strictly_newer_apart(df: DataFrame, key: str, ts: str, seq: str, by: list[str]) -> DataFrame:
    """T12 for rows that lie by ``by`` (never null), not by ``key``, and are many times their keys' size: only
    (``by``, ``key``, ``ts``, ``seq``) and a digest go to where the key's arrivals meet.

    A row that an earlier arrival of its own group stops is stopped whatever else arrives, and stops no row that this
    earlier one doesn't stop. What is stopped by arrivals of other groups comes back as a short list. (The digest tells rows of one arrival
    position apart; and as both readings take every column, they share their shuffles.)
    """
    before = (Window.unboundedPreceding, -1)
    mine = F.max(ts).over(Window.partitionBy(*by, key).orderBy(seq).rowsBetween(*before))
    rows = df.withColumn("_prev_max", mine).where(F.col("_prev_max").isNull() | (F.col(ts) > F.col("_prev_max"))).drop("_prev_max")
    rows = rows.withColumn("_digest", F.xxhash64(*df.columns))
    mark = [key, ts, seq, "_digest"]
    every = F.max(ts).over(Window.partitionBy(key).orderBy(seq).rowsBetween(*before))
    stopped = (rows.select(*by, *mark).withColumn("_prev_max", every)
               .where(F.col("_prev_max").isNotNull() & F.coalesce(F.col(ts) <= F.col("_prev_max"), F.lit(True)))
               .select(*[F.col(c).alias(f"_s_{c}") for c in by], F.struct(*mark).alias("_stopped")))
    # a range of one: as an equal column it would be a key of the join, and the rows would have to lie by it too
    own = F.struct(*mark)
    same = (own >= F.col("_stopped")) & (own <= F.col("_stopped"))
    for c in by:
        same = same & (F.col(c) == F.col(f"_s_{c}"))
    return rows.join(stopped, same, "left_anti").drop("_digest")


def retract_versions(df: DataFrame, key: str, seq: str, amount_cols: list[str]) -> DataFrame:
    """Every superseded version is emitted again with negated amounts.

    Output = all versions + negated copies of all but the last one; so the sum
    of the output equals the sum of the latest versions. One pass: the last
    ``seq`` of a key is a window over its rows (which spill), and a superseded
    row comes out twice; a frame that lies by ``key`` is not shuffled again.
    """
    last = F.max(seq).over(Window.partitionBy(key))
    old = F.col(key).isNotNull() & (F.col(seq) < last)
    copies = F.when(old, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = df.withColumn("_copies", copies).withColumn("_retract", F.explode("_copies")).drop("_copies")
    return out.select(*[F.when(F.col("_retract"), (-F.col(c).cast("decimal(38,2)")).cast("string"))
                        .otherwise(F.col(c).cast("string")).alias(c) if c in amount_cols else F.col(c)
                        for c in df.columns], "_retract")


def fix_is_new(log: DataFrame, mid: Column, ts: str, offset: str, is_new: Column, day: Column,
               prev_day: Column) -> DataFrame:
    """New-visitor flag repair.

    State per mid is written once, by its first record: that record's date if
    it says new, else the day before. A later record that says new on another
    date is corrected to old. The first record per mid is a partial aggregate,
    joined back on mid (AQE splits a skewed mid).
    """
    tagged = log.withColumn("_mid", mid).withColumn("_isnew", is_new).withColumn("_day", day) \
        .withColumn("_prev", prev_day)
    first = (tagged.groupBy("_mid")
             .agg(F.min_by(F.struct(F.col(ts).alias("fts"), F.col(offset).alias("foff"),
                                    F.when(F.col("_isnew") == "1", F.col("_day")).otherwise(F.col("_prev"))
                                    .alias("d0")),
                           F.struct(F.col(ts), F.col(offset))).alias("_f"))
             .select(F.col("_mid").alias("_fmid"), "_f.*"))
    # a record without a mid is state of its own key, not lost
    j = tagged.join(first, tagged["_mid"].eqNullSafe(first["_fmid"]), "left").drop("_fmid")
    is_first = (F.col(ts) == F.col("fts")) & (F.col(offset) == F.col("foff"))
    fixed = F.when((F.col("_isnew") == "1") & ~is_first & (F.col("d0") != F.col("_day")), F.lit("0")) \
        .otherwise(F.col("_isnew"))
    return j.withColumn("is_new_fixed", fixed).drop("_mid", "_isnew", "_day", "_prev", "fts", "foff", "d0")
