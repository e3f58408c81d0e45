"""Change-envelope and raw-record operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE_SCHEMA = ("before map<string,string>, after map<string,string>, "
                   "source map<string,string>, op string, ts_ms bigint")
CDC_OPS = ("c", "u", "d", "r")


def parse_cdc(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON change records -> envelope columns; null payloads are skipped.

    ``map<string,string>`` stringifies nested numbers, so both CDC number
    encodings (``1999.5`` and ``"1999.50"``) arrive as text.
    """
    parsed = F.from_json(F.col(value_col), ENVELOPE_SCHEMA)
    return (raw.where(F.col(value_col).isNotNull())
            .select(*keep, parsed.alias("e"))
            .select(*keep, "e.*"))


def envelope_to_json(env: DataFrame) -> DataFrame:
    """K1/K3 serializer: envelope -> (value) JSON text; nulls omitted."""
    return env.select(F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("value"))


def snapshot_to_envelope(df: DataFrame, db: str, tbl: str, ts_ms: Column | None = None) -> DataFrame:
    """S4 (re-aimed): wrap a table scan as ``op='r'`` snapshot envelopes."""
    cols = df.columns
    after = F.create_map(*[e for c in cols for e in (F.lit(c), F.col(c).cast("string"))])
    return df.select(
        F.lit(None).cast("map<string,string>").alias("before"),
        after.alias("after"),
        F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(tbl)).alias("source"),
        F.lit("r").alias("op"),
        (ts_ms if ts_ms is not None else F.lit(0)).cast("long").alias("ts_ms"),
    )


def cdc_gate(env: DataFrame, db: str, ops: tuple[str, ...] = CDC_OPS, accept_deletes: bool = False) -> DataFrame:
    """Keep records of ``db`` with a known op and a non-empty image.

    As built, the gate requires a non-empty ``after``, so deletes never pass;
    ``accept_deletes=True`` checks ``before`` for ``op='d'`` instead.
    """
    # the images are made once, behind a one-element explode: a filter on them would make them all a second time where
    # they are derived or parsed, and stand between a derived topic's branches and a shuffle they share
    known = (env.where((F.col("source")["db"] == db) & F.col("op").isin(*ops))
             .withColumn("_i", F.explode(F.array(F.struct("before", "after")))))
    after = F.col("_i.after")
    image = F.when(F.col("op") == "d", F.col("_i.before")).otherwise(after) if accept_deletes else after
    return (known.where(image.isNotNull() & (F.size(image) > 0))
            .select(*[F.col(f"_i.{c}") if c in ("before", "after") else F.col(c) for c in env.columns]))


def cdc_demux(env: DataFrame, tbl: str, op: str | None = None) -> DataFrame:
    """The records of one source table (optionally one op)."""
    cond = F.col("source")["table"] == tbl
    if op is not None:
        cond = cond & (F.col("op") == op)
    return env.where(cond)


def image(env: DataFrame, variant: str = "op") -> Column:
    """Row image. ``op``: before for deletes else after;
    ``nonempty``: after when non-empty else before."""
    if variant == "op":
        return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return F.when(F.size(F.col("after")) > 0, F.col("after")).otherwise(F.col("before"))


def flatten_image(env: DataFrame, fields: list[str], variant: str = "nonempty",
                  extra: tuple[str, ...] = ("op", "ts_ms")) -> DataFrame:
    """P7 variant 2 + P5: chosen image projected to named columns, plus op/ts_ms."""
    img = image(env, variant)
    return env.select(*[img[f].alias(f) for f in fields], *extra)


def project_after(env: DataFrame, fields: list[str] | dict[str, str], extra: tuple[str, ...] = ("ts_ms",)) -> DataFrame:
    """P5: ``after['k'] AS k`` (dict form renames: {out: key})."""
    pairs = fields.items() if isinstance(fields, dict) else [(f, f) for f in fields]
    return env.select(*[F.col("after")[k].alias(out) for out, k in pairs], *extra)


def prune_columns(m: Column, csv: Column) -> Column:
    """Keep only whitelisted keys of a map (whitelist is a csv column)."""
    return keep_keys(m, F.split(csv, ","))


def keep_keys(m: Column, allowed: Column) -> Column:
    """P8 with the whitelist as an array. An image whose keys are all on it, the common one, stays as it is."""
    whole = F.size(F.array_except(F.map_keys(m), allowed)) == 0
    return F.when(whole, m).otherwise(F.map_filter(m, lambda k, v: F.array_contains(allowed, k)))


def event_time_pick(parsed: DataFrame, json_col: str = "value") -> DataFrame:
    """T4: event time = first present of ``ts_ms``, ``ts``; else 0."""
    ts_ms = F.get_json_object(F.col(json_col), "$.ts_ms").cast("long")
    ts = F.get_json_object(F.col(json_col), "$.ts").cast("long")
    return parsed.withColumn("event_ms", F.coalesce(ts_ms, ts, F.lit(0).cast("long")))


def dirty_split(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(valid JSON objects, dirty records) from one raw frame.

    ``try_parse_json`` returns NULL for malformed text; valid JSON that is not
    an object, so does not begin with a brace, is dirty too.
    """
    ok = F.try_parse_json(F.col(value_col)).isNotNull() & F.col(value_col).rlike(r"\A[ \t\n\r]*\{")
    flagged = raw.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return (flagged.where("_ok").drop("_ok"), flagged.where(~F.col("_ok")).drop("_ok"))
