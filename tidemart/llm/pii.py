"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score.

DataFrame functions only. Spark's expressions give matches but not their places: a text split at an expression
gives the gaps, and gaps and matches in turn give every place in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Countries by the length of their IBAN (the registry's).
IBAN_LENGTH = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """A listed country's IBAN ends at its length, whatever follows; another code's at the last group, or before a listed one."""
    listed = "|".join(IBAN_LENGTH.values()).replace(" ", "|")
    each = []
    for n, codes in IBAN_LENGTH.items():
        groups, rest = divmod(n - 4, 4)
        each.append(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else ""))
    other = f"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:(?! (?:{listed})[0-9]{{2}} ?[A-Z0-9]{{4}}) ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(each)}|{other})(?![A-Za-z0-9])"


#: In order of their number. A repeated part never gives back what it took (++), and a run is tried at its first
#: character only, so the time is linear in the text; the matches are those of the plain expressions.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": _iban(),
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
BASE_KINDS = 4
#: A character that every match of a kind has.
MARK = {"email": "@", "phone": "+", "ssn": "-"}
#: Score of a confirmed span, and words nearby that raise or lower it.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
RAISE = {
    "email": "e-?mail|contact|write|reach", "ip": "address|server|host|client", "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|call|mobile|tel|fax", "iban": "iban|account|bank|konto|compte|cuenta", "ssn": "ssn|social|security",
}
LOWER = {"ip": "version|release|section", "card": "order|tracking|serial|isbn", "ssn": "part|model|serial"}
STEP, NEAR = 0.3, 40
#: Spans of the added kinds under this score are dropped; those of the base kinds stay.
ADD_SCORE = 0.6

SPAN = "array<struct<start:long,kind:int,end:long,value:string,score:double>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _remainder_97(value: Column) -> Column:
    """An IBAN as a number modulo 97: the first four characters go to the end, letters count from 10."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(acc, c):
        code = F.ascii(c)
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(add(acc, c)))


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, " ", "")).between(15, 34) & (_remainder_97(value) == 1)
    return F.lit(True)


def _spans(text: Column, kind: str) -> Column:
    number, pattern = list(PATTERNS).index(kind), PATTERNS[kind]
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    nothing = F.expr(f"cast(array() as {SPAN})")

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["found"])
        near = F.lower(F.concat(F.substring(text, F.greatest(start - NEAR, F.lit(0)).cast("int") + 1, F.least(start, F.lit(NEAR)).cast("int")), F.lit(" "), F.substring(text, end.cast("int") + 1, F.lit(NEAR))))
        score = F.lit(SCORE[kind]) + F.when(near.rlike(RAISE[kind]), STEP).otherwise(0.0)
        if kind in LOWER:
            score = score - F.when(near.rlike(LOWER[kind]), STEP).otherwise(0.0)
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"), x["found"].alias("value"), F.round(score, 2).alias("score"))
        keep = x["found"].isNotNull() & _confirmed(kind, x["found"])
        return F.struct(F.coalesce(end, start).alias("at"), F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("spans"))
    all_ = F.aggregate(F.arrays_zip(gaps.alias("gap"), found.alias("found")), zero, step, lambda acc: acc["spans"])
    mark = text.contains(MARK[kind]) if kind in MARK else text.rlike("[0-9]")
    return F.when(mark, all_).otherwise(nothing)


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``_spans``: array of (start, kind, end, value, score) by start, then kind.

    start and end count code points, end exclusive; kind numbers PATTERNS. Spans of base kinds that pass their
    check all stay, those of the added kinds (iban, ssn) from ADD_SCORE on. A null or empty text has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    each = [_spans(text, kind) for kind in PATTERNS]
    found = F.array_sort(F.concat(*each))
    return docs.withColumn("_spans", F.filter(found, lambda s: (s["kind"] < BASE_KINDS) | (s["score"] >= ADD_SCORE)))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in PATTERNS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row; repeated rows repeat."""
    found = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")

    def of(number):
        return F.size(F.filter("_spans", lambda s: s["kind"] == number)).cast("long")

    count = [of(i).alias(f"n_{k}") for i, k in enumerate(list(PATTERNS)[:BASE_KINDS])]
    base = F.filter("_spans", lambda s: s["kind"] < BASE_KINDS)
    return found.select("doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"), (F.size("_spans") - F.size(base)).cast("long").alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span's characters replaced by its kind in brackets; overlapping spans are one.

    n_chars, if there, follows the new text. A text without spans, a null one too, stays as it is.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in PATTERNS])
    text = F.col("text")

    def step(acc, s):
        gap = F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.get(names, s["kind"]))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    new = F.aggregate("_spans", zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, F.lit(2**31 - 1))))
    out = find(docs).withColumn("text", F.when(F.size("_spans") > 0, new).otherwise(text)).drop("_spans")
    return out.withColumn("n_chars", F.when(text.isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))) if "n_chars" in docs.columns else out
