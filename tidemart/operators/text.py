"""Text operators: keyword segmentation (U1) and word-list membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import last_token

# Han runs, runs of other letters, digit runs (lower-cased), as a smart-mode
# segmenter without a dictionary would split mixed text.
TOKEN_PATTERN = r"\p{IsHan}+|[^\P{L}\p{IsHan}]+|\p{N}+"


def tokenize(text: Column) -> Column:
    """Text -> array of lower-cased tokens (JVM regex, no Python)."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def explode_tokens(df: DataFrame, text_col: str, out: str = "keyword") -> DataFrame:
    """``LATERAL TABLE(ik_analyze(text))``: one row per token."""
    return df.withColumn(out, F.explode(tokenize(F.col(text_col))))


HAN_RUN = r"\p{IsHan}+"


def segment_runs(runs: DataFrame, words: DataFrame) -> DataFrame:
    """Forward longest match: (run, tokens) of distinct Han runs (run) by a word table (word).

    From the left, the longest word that begins at a place is a token and the next place follows it; where no word of
    two characters or more begins, one character is. All substrings up to the longest word's length meet the words in
    one equi-join, so the table may have any size; a run's tokens are then found by one pass over its places, in order,
    that keeps where the next token begins."""
    known = words.select(F.lower("word").alias("word")).where(F.char_length("word") > 1).distinct()
    longest = known.agg(F.max(F.char_length("word"))).first()[0] or 1
    size = F.char_length("run")
    places = runs.select("run", F.explode(F.sequence(F.lit(1), size)).alias("at"))
    ends = F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("at") + 1))
    parts = places.select("run", "at", F.explode(ends).alias("n")).select("run", "at", "n", F.substring("run", F.col("at"), F.col("n")).alias("part"))
    hits = parts.join(known, parts["part"] == known["word"], "left").where((F.col("n") == 1) | F.col("word").isNotNull())
    steps = hits.groupBy("run", "at").agg(F.max("n").alias("n")).groupBy("run").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("steps"))
    # (next, taken) after every place: a place that is not the next one is inside a token
    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<at:int,n:int>>").alias("taken"))
    walk = F.aggregate("steps", start, lambda acc, s: F.when(s["at"] < acc["next"], acc).otherwise(F.struct(
        (s["at"] + s["n"]).alias("next"), F.array_append(acc["taken"], s).alias("taken"))))
    return steps.select("run", F.transform(walk["taken"], lambda s: F.substring("run", s["at"], s["n"])).alias("tokens"))


def explode_segments(df: DataFrame, text_col: str, words: DataFrame, out: str = "keyword", at: str = "pos") -> DataFrame:
    """U1 with a dictionary: one row per token with its place from 0; Han runs are cut by ``segment_runs``, all else by
    ``tokenize``. Each distinct run is cut once. A null text, or one without letters and digits, gives no row."""
    rows = df.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_id"), tokenize(F.col(text_col)).alias("_pieces"))
    pieces = rows.select("_row", "_id", F.posexplode("_pieces").alias("_p", "_piece"))
    runs = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(HAN_RUN), 0)).alias("run")).distinct()
    cut = segment_runs(runs, words).select(F.col("run").alias("_run"), F.col("tokens").alias("_tokens"))
    j = pieces.join(cut, F.col("_piece") == F.col("_run"), "left")
    tokens = j.select("_row", "_id", "_p", F.posexplode(F.coalesce("_tokens", F.array("_piece"))).alias("_t", "_token"))
    place = F.row_number().over(Window.partitionBy("_id").orderBy("_p", "_t")) - 1
    return tokens.select("_row", F.col("_token").alias(out), place.alias(at)).select("_row.*", out, at)


def word_list(spark, path: str) -> DataFrame:
    """One word per line of a text file or folder, as it stands there; read anew by every job."""
    return spark.read.text(path).select(F.col("value").alias("word")).where(F.col("word") != "").distinct()


def flag_last_word(df: DataFrame, text_col: str, words: DataFrame, sep: str = ",") -> DataFrame:
    """Exact membership of the text's last token in a word list.

    The list is joined, not broadcast blindly: AQE broadcasts it when small and
    keeps a shuffle join when it grows."""
    w = words.select(F.col("word").alias("_w")).distinct()
    t = df.withColumn("_last", F.coalesce(last_token(F.col(text_col), sep), F.lit("")))
    j = t.join(w, t["_last"] == w["_w"], "left")
    hit = F.col("_w").isNotNull()
    return (j.withColumn("is_violation", F.when(hit, 1).otherwise(0))
            .withColumn("violation_grade", F.when(hit, "P0").otherwise(""))
            .withColumn("violation_msg", F.when(hit, F.col("_last")).otherwise(""))
            .drop("_w", "_last"))
