"""Sharding by extendible hashing: only buckets over the limit split on another hash bit.

DataFrame functions only. A document's hash is the first 32 bits of the md5 of its doc_id and the md5 of its text. The
bytes under every hash prefix of up to D bits are summed from one small table of D-bit bins; a bin's bucket is the
shortest prefix that fits the limit, which is where doubling would have stopped. Bins that don't fit at D bits
get a page of eight more bits, and so on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, work_dir

HASH_BITS = 32
PAGE_BITS = 8
#: Bytes of text in a shard.
SHARD_BYTES = 16 << 20
#: Bytes that a row counts beside its text.
ROW_BYTES = 8
#: Bins of a directory page that are broadcast at most (under 50 bytes each).
BROADCAST_BINS = 1 << 16


def _prefix(h: Column, bits: Column) -> Column:
    return F.call_function("shiftright", h, (F.lit(HASH_BITS) - bits).cast("int"))


def _page(rows: DataFrame, base: int, bits: int, limit: int) -> DataFrame:
    """(bin, depth, bytes, docs, fits): for each ``bits``-bit bin its bucket, a prefix of over ``base`` bits."""
    bins = rows.groupBy(_prefix(F.col("h"), F.lit(bits)).alias("bin")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
    each = bins.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(bits))))
    each = each.withColumn("p", F.call_function("shiftright", "bin", (F.lit(bits) - F.col("depth")).cast("int")))
    sums = each.groupBy("depth", "p").agg(F.sum("b").alias("bytes"), F.sum("n").alias("docs"))
    fit = (F.col("bytes") <= limit) | (F.col("docs") == 1) | (F.col("depth") == bits)
    return each.join(sums.where(fit), ["depth", "p"]).groupBy("bin").agg(F.min(F.struct("depth", "bytes", "docs")).alias("s")).select("bin", "s.*", ((F.col("s.bytes") <= limit) | (F.col("s.docs") == 1)).alias("fits"))


def shard(docs: DataFrame, shard_bytes: int = SHARD_BYTES, whole_rows: bool = False) -> DataFrame:
    """(doc_id, n_bytes, shard, shard_depth, shard_bytes, shard_docs) of every row; ``whole_rows`` adds the row as _row.

    shard is the bucket's hash prefix in binary digits (empty: all rows fit one shard). n_bytes is the text's UTF-8
    bytes (null: 0) and ROW_BYTES. A shard is over the limit only if it is one row. Rows with one hash, which
    are repeated rows, cannot be split by bits: if they are over the limit, the bucket is a chain of shards
    "prefix/0", "prefix/1" ... dealt by running bytes, each of at most the limit and one row; shard_bytes and
    shard_docs then are the chain's. An empty table gives no rows.
    """
    path = work_dir(docs.sparkSession, "shards")
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.md5("text"), F.lit(""))).cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("n_bytes"), F.conv(F.substring(key, 1, 8), 16, 10).cast("long").alias("h"), *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] * whole_rows)
    rows = saved(rows, f"{path}/rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    base, bits = 0, min(HASH_BITS, max(4, math.ceil(math.log2(max(1, total / shard_bytes))) + 4))
    out, todo, parts = None, rows, []
    while True:
        page = saved(_page(todo, base, bits, shard_bytes), f"{path}/page{bits}")
        n, over = page.agg(F.count("*"), F.count_if(~F.col("fits"))).first()
        near = F.broadcast(page) if n <= BROADCAST_BINS else page
        placed = todo.withColumn("bin", _prefix(F.col("h"), F.lit(bits))).join(near, "bin")
        if not over or bits == HASH_BITS:
            parts.append(placed)
            break
        parts.append(placed.where("fits"))
        todo = saved(placed.where("NOT fits").select(rows.columns), f"{path}/over{bits}")
        base, bits = bits, min(HASH_BITS, bits + PAGE_BITS)
    name = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin(_prefix(F.col("h"), F.col("depth"))), F.col("depth").cast("int"), F.lit("0")))
    for i, p in enumerate(parts):
        p = p.withColumn("shard", name)
        if i == len(parts) - 1 and over:
            # a chain: running bytes within each input partition, after the bytes of the partitions before it
            chain = saved(p.where("NOT fits").withColumn("part", F.spark_partition_id()), f"{path}/chain")
            sums = chain.groupBy("shard", "part").agg(F.sum("n_bytes").alias("b"))
            before = sums.select("shard", "part", (F.sum("b").over(Window.partitionBy("shard").orderBy("part")) - F.col("b")).alias("before"))
            run = F.sum("n_bytes").over(Window.partitionBy("shard", "part").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_bytes")
            chain = chain.withColumn("run", run).join(before, ["shard", "part"])
            chain = chain.withColumn("shard", F.concat("shard", F.lit("/"), F.floor((F.col("run") + F.col("before")) / shard_bytes).cast("string")))
            p = p.where("fits").unionByName(chain.drop("part", "run", "before"))
        p = p.select("doc_id", "n_bytes", "shard", F.col("depth").cast("int").alias("shard_depth"), F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs"), *["_row"] * whole_rows)
        out = p if out is None else out.unionByName(p)
    return out


def write_shards(docs: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Write ``docs`` below ``path``, one folder a shard ("all" if one holds every row)."""
    placed = shard(docs, shard_bytes, whole_rows=True)
    name = F.when(F.col("shard") == "", "all").otherwise(F.regexp_replace("shard", "/", "-"))
    placed.select(name.alias("_shard"), "_row.*").repartition("_shard").write.partitionBy("_shard").parquet(path)


ORACLE = f"""
WITH rows_ AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + {ROW_BYTES} AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')), 1, 8) AS BIGINT) AS h
  FROM documents),
deep AS (SELECT r.*, d.depth, h >> ({HASH_BITS} - d.depth) AS p FROM rows_ r, (SELECT unnest(range(0, {HASH_BITS + 1}))::INT AS depth) d),
sized AS (SELECT *, sum(n_bytes) OVER (PARTITION BY depth, p) AS bytes, count(*) OVER (PARTITION BY depth, p) AS docs FROM deep),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, h ORDER BY depth) AS k FROM sized WHERE bytes <= {SHARD_BYTES} OR docs = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(p), depth, '0') END AS shard, depth AS shard_depth,
  CAST(bytes AS BIGINT) AS shard_bytes, docs AS shard_docs
FROM placed WHERE k = 1
"""
