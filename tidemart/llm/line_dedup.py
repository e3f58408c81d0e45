r"""Repeated lines: explode normalised lines, hash, count documents per hash, drop, put the rest together by position.

Rows are known by their text's hash, as equal texts lose the same lines; so lines travel as hashes and positions, and
texts are shuffled once, to meet the positions they lose. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, work_dir

#: The characters of ``[\x20\x09-\x0D]``.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashes(c: Column, name: str) -> list[Column]:
    """128 bits: two hashes of ``c`` with different seeds."""
    return [F.xxhash64(c).alias(f"{name}1"), F.xxhash64(F.lit(1), c).alias(f"{name}2")]


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def keyed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(t1, t2, h1, h2, pos, first) of (text): each line with a key, by the hashes of text and key.

    first marks one line of each key of a text, found by sorting the text's hashes.
    """
    lines = F.split(ascii_lower(F.col("text")), "\n", -1)
    keys = F.transform(lines, lambda x: F.trim(x, F.lit(BLANK)))
    keyed = F.transform("keys", lambda x, i: F.when(F.length(x) >= min_chars, F.struct(*hashes(x, "h"), i.alias("pos"))))
    x = rows.select(*hashes(F.col("text"), "t"), keys.alias("keys"))
    x = x.select("t1", "t2", F.sort_array(F.array_compact(keyed)).alias("own"))
    before = F.concat(F.array(F.lit(None).cast("struct<h1:bigint,h2:bigint,pos:int>")), "own")
    x = x.where(F.size("own") > 0).select("t1", "t2", F.explode(F.arrays_zip(F.col("own").alias("x"), before.alias("b"))).alias("z")).where("z.x is not null")
    first = F.col("z.b").isNull() | (F.col("z.b.h1") != F.col("z.x.h1")) | (F.col("z.b.h2") != F.col("z.x.h2"))
    return x.select("t1", "t2", "z.x.h1", "z.x.h2", "z.x.pos", first.alias("first"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    r"""Texts without the lines that ``min_docs`` documents share: (doc_id, text, n_lines, n_dropped) for every row.

    A text is split at \n; a line's key is the line without ``[\x20\x09-\x0D]`` at its ends, A-Z in lower case. Keys of
    ``min_chars`` code points or more that occur in ``min_docs`` rows or more lose all their lines everywhere; the
    others stay as they are, joined by \n. Every row is a document of its own, also one that repeats another's doc_id or
    text or has no doc_id. A null or empty text is one empty line; an empty table gives an empty one; a text of any
    length is one row of at most 2 GB. n_lines counts the lines before. Other columns are ignored.

    A line that a third of all rows hold is counted by partial sums, and its rows meet the frequent keys in a join that
    can be split. Keys are compared by 128 bits of hash.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "lines")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines = saved(keyed_lines(rows, min_chars), f"{path}/lines")
    frequent = lines.groupBy("h1", "h2").agg(F.count_if("first").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")
    frequent = saved(frequent, f"{path}/frequent")
    hit = lines.select("t1", "t2", "h1", "h2", "pos").join(frequent, ["h1", "h2"], "left_semi")
    drops = saved(hit.groupBy("t1", "t2").agg(F.collect_set("pos").alias("drop")), f"{path}/drops")
    x = rows.select("doc_id", "text", *hashes(F.col("text"), "t")).join(drops, ["t1", "t2"], "left")
    x = x.select("doc_id", "text", F.split("text", "\n", -1).alias("lines"), "drop")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop")
    kept = F.transform(stay, lambda i: F.get("lines", i))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return x.select("doc_id", text.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))


ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (SELECT doc_id, l, list_transform(l, lambda x: translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}')) AS k FROM d),
f AS (SELECT key FROM (SELECT unnest(list_distinct(k)) AS key FROM k) WHERE length(key) >= 1 GROUP BY key HAVING count(*) >= 10),
x AS (SELECT doc_id, unnest(l) AS line, unnest(k) AS key, generate_subscripts(l, 1) AS pos FROM k)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM x LEFT JOIN f USING (key) GROUP BY doc_id
"""
