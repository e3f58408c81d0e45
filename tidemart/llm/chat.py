"""Chat formatting from an event log: fold deltas, edits and regenerations into messages, then render.

DataFrame functions only. An event is (conv_id, seq, message, kind, role, text):

- ``delta`` appends its text to the message;
- ``edit`` replaces the message's text by its own;
- ``regenerate`` drops what the message has so far (its text, if any, begins the new one).

The template writes a turn as TURN role BODY text END.
Control strings inside texts are escaped by turning their first character into a character reference, and every
ampersand into one; so a marker in the output is always a marker, and unescaping gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "\n", "<|end|>"
#: Strings with a meaning in this or a common template; none of them occurs in an escaped text.
CONTROL = (TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
#: The role whose texts carry the loss.
LOSS_ROLE = "assistant"

_ESCAPED = {"<": "&lt;", "[": "&#91;"}


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for first, reference in _ESCAPED.items():
        rest = "|".join(rf"\Q{c[1:]}\E" for c in CONTROL if c[0] == first)
        out = F.regexp_replace(out, rf"\Q{first}\E(?={rest})", reference)
    return out


def unescape(text: Column) -> Column:
    for first, reference in _ESCAPED.items():
        text = F.replace(text, F.lit(reference), F.lit(first))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text, first_seq) of the final messages.

    Events of a message apply in order of seq. What stands before its last edit or regeneration is dropped first,
    by one window sum; then the rest is joined. Null texts count as empty; the role is the last that isn't null.
    """
    by = Window.partitionBy("conv_id", "message").orderBy("seq", "kind", "role", "text")
    cut = F.when(F.col("kind").isin("edit", "regenerate"), 1).otherwise(0)
    e = events.withColumn("epoch", F.sum(cut).over(by)).withColumn("at", F.row_number().over(by))
    e = e.withColumn("last", F.max("epoch").over(Window.partitionBy("conv_id", "message")))
    part = F.when(F.col("epoch") == F.col("last"), F.struct("at", F.coalesce("text", F.lit("")).alias("text")))
    role = F.max(F.when(F.col("role").isNotNull(), F.struct("at", "role")))["role"]
    out = e.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(part)).alias("parts"), role.alias("role"), F.min("seq").alias("first_seq"))
    return out.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "first_seq")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns) by order of message: turns has (start, end, loss_start, loss_end) in code points.

    start and end bound a turn with its markers; the loss mask is the escaped text of a LOSS_ROLE turn (else null).
    """
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;"))
    head = F.concat(F.lit(TURN), role, F.lit(BODY))
    m = messages.select("conv_id", "message", (F.col("role") == LOSS_ROLE).alias("loss"), head.alias("head"), escape(F.col("text")).alias("body"))
    size = F.length("head") + F.length("body") + len(END)
    start = F.sum(size).over(Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, 0)) - size
    m = m.withColumn("start", start.cast("long")).withColumn("end", (start + size).cast("long"))
    inside = F.col("start") + F.length("head")
    turn = F.struct(
        "message", F.concat("head", "body", F.lit(END)).alias("text"), "start", "end",
        F.when(F.col("loss"), inside).alias("loss_start"), F.when(F.col("loss"), inside + F.length("body")).alias("loss_end"))
    one = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    fields = ("start", "end", "loss_start", "loss_end")
    return one.select("conv_id", F.array_join(F.transform("t", lambda t: t["text"]), "").alias("formatted"), F.transform("t", lambda t: F.struct(*[t[f].alias(f) for f in fields])).alias("turns"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (role, text, loss_text)) from the formatted text and its mask alone.

    The text is split at the end marker, so each turn's mask is cut out of its own part.
    """
    parts = F.split("formatted", rf"\Q{END}\E")

    def turn(part, mask):
        inside = F.substring(part, len(TURN) + 1, F.lit(2**31 - 1))
        role = F.substring_index(inside, BODY, 1)
        text = F.substring(inside, F.length(role) + len(BODY) + 1, F.lit(2**31 - 1))
        masked = F.substring(part, (mask["loss_start"] - mask["start"]).cast("int") + 1, (mask["loss_end"] - mask["loss_start"]).cast("int"))
        return F.struct(unescape(F.replace(role, F.lit("&#10;"), F.lit("\n"))).alias("role"), unescape(text).alias("text"), unescape(masked).alias("loss_text"))

    turns = F.zip_with(F.slice(parts, F.lit(1), F.size("turns")), "turns", turn)
    return rendered.select("conv_id", turns.alias("turns"), F.length("formatted").cast("long").alias("formatted_chars"))


def as_events(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log: each row is one message, in order of turn, role and text.

    So rows that repeat a turn stay messages of their own. A null turn comes first. A message's log folds back to its
    text: a draft is regenerated in two deltas, and every third message is edited instead and goes on with a delta.
    """
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    r = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    half = F.ceil(F.length("text") / 2).cast("int")
    head, tail = F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.lit(2**31 - 1))
    draft, third = F.concat(F.lit("draft "), F.substring("text", 1, 20)), F.col("message") % 3 == 0

    def event(i, kind, role, text):
        return F.struct((F.col("message") * 4 + i).alias("seq"), kind.alias("kind"), role.cast("string").alias("role"), text.alias("text"))

    log = F.array(
        event(0, F.lit("delta"), F.col("role"), draft), event(1, F.when(third, "edit").otherwise("regenerate"), F.lit(None), F.when(third, head)),
        event(2, F.lit("delta"), F.lit(None), F.when(third, tail).otherwise(head)), event(3, F.lit("delta"), F.lit(None), F.when(~third, tail)))
    return r.withColumn("message", n).select("conv_id", "message", F.explode(log).alias("e")).select("conv_id", "e.seq", "message", "e.kind", "e.role", "e.text")


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns) of conversation rows; rows with a null conv_id are one conversation."""
    return render(fold(as_events(rows)))


def digests(rendered: DataFrame) -> DataFrame:
    """n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation, read back."""
    back = read_back(rendered)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("turns", lambda t: F.coalesce(t["loss_text"], F.lit(""))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def _sql_escape(text: str) -> str:
    out = f"replace({text}, '&', '&amp;')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{_ESCAPED[c[0]]}{c[1:]}')"
    return out


ORACLE = f"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  CAST(sum({len(TURN) + len(BODY) + len(END)} + length(replace({_sql_escape('role')}, chr(10), '&#10;')) + length({_sql_escape('text')})) AS BIGINT) AS formatted_chars
FROM rows_ GROUP BY conv_id
"""
