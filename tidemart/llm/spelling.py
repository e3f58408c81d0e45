r"""Spelling variants: blocked Gram matrices of letter counts propose pairs of words, an edit check confirms them.

Two words one edit apart differ by one in the number of letters and by at most two in the squared distance of their
letter counts. Letters fall into a few groups; a block holds the words with equal numbers of letters of each group, so
a word's near words lie in its own block and in the few whose numbers differ by one inserted or replaced letter.
A task takes two slices of such blocks, has all their squared distances from one matrix product, and checks the pairs
at most two apart letter by letter. Each slice is bounded, so a block of any size becomes many tasks. Only sums by word
leave a task, never pairs.
"""

from __future__ import annotations

import math
import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, work_dir

#: Words of a block that one task compares, and the words of other blocks that it compares them with.
HOMES, GUESTS = 2048, 16384
#: Distinct words that a counting task holds at most before it passes its counts on.
HELD = 500_000
#: An occurrence whose checksum this divides loses a letter.
MISPRINT = 199
#: Runs of ``[A-Za-zÀ-ÿ]``, lower-cased in A-Z before.
RUN = re.compile("[a-zÀ-ÿ]+")
#: Letters are their code points in Latin-1.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])


def misprint(doc_id, word: str) -> str:
    """The word, or without one letter if 199 divides the checksum of ``<doc_id>:<word>`` (null doc_id: nothing before the colon)."""
    import zlib

    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    return word if h % MISPRINT else word[: h % len(word)] + word[h % len(word) + 1 :]


def _count(min_chars: int):
    """(doc_id, text) to (word, n), partial counts of a task."""
    from collections import Counter

    def batch_of(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = Counter(RUN.findall((text.as_py() or b"").lower().decode("utf-8", "replace")))
                for word, n in runs.items():
                    if len(word) >= min_chars and len(word := misprint(doc_id, word)) >= min_chars:
                        held[word] += n
                if len(held) > HELD:
                    yield batch_of(held)
                    held.clear()
        yield batch_of(held)

    return run


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row of letter counts for each word in Latin-1."""
    column = np.full(256, len(LETTERS), np.int64)
    column[LETTERS] = np.arange(len(LETTERS))
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.repeat(np.arange(len(words)), size) * (len(LETTERS) + 1) + column[np.frombuffer(b"".join(words), np.uint8)]
    return np.bincount(at, minlength=len(words) * (len(LETTERS) + 1)).reshape(len(words), -1)[:, :-1]


def _blocks(groups: int):
    """(word, n) to (block, guest, word, n): a word's own block, and the blocks before its own that hold near words.

    A block is (length, letters of each group) in order, as bytes.
    """

    def run(batches):
        of_group = np.zeros((len(LETTERS), groups), np.int64)
        of_group[np.arange(len(LETTERS)), np.arange(len(LETTERS)) % groups] = 1
        one = np.eye(groups, dtype=np.int64)
        # with a letter less, or with one of a later group in its place: these blocks come before
        steps = [np.zeros(groups, np.int64), *-one, *[one[j] - one[i] for i in range(groups) for j in range(i + 1, groups)]]
        for batch in batches:
            if not batch.num_rows:
                continue
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            sums = letter_counts(words) @ of_group
            for k, step in enumerate(steps):
                other = sums + step
                rows = np.flatnonzero((other >= 0).all(axis=1))
                key = np.concatenate([other[rows].sum(axis=1, keepdims=True), other[rows]], axis=1).astype(">u4")
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes() for x in key], pa.binary()), pa.array(np.full(len(rows), k > 0)), batch.column(0).take(take), batch.column(1).take(take)],
                    names=["block", "guest", "word", "n"])

    return run


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two letter arrays are exactly one edit apart; b's words are as long as a's or longer by one."""
    size = a.shape[1]
    differ = a != b[:, :size]
    if b.shape[1] == size:
        return differ.sum(axis=1) == 1
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    return ((a == b[:, 1:]) | (np.arange(size) < first[:, None])).all(axis=1)


class _Slice:
    """Words of one length with their letter counts and the near words found so far."""

    def __init__(self, rows):
        self.words = [r[4].encode("latin-1") for r in rows]
        self.n = np.array([r[5] for r in rows], np.int64)
        self.letters = np.frombuffer(b"".join(self.words), np.uint8).reshape(len(rows), -1)
        counts = letter_counts(self.words)
        squares = (counts * counts).sum(axis=1)
        kind = np.float32 if squares.max() < 1 << 22 else np.float64  # all sums stay exact
        self.counts, self.squares = counts.astype(kind), squares.astype(kind)
        self.near = np.zeros(len(rows), np.int64)
        self.best: dict[int, tuple] = {}

    def found(self, mine: np.ndarray, other: _Slice, theirs: np.ndarray) -> None:
        """Notes near words: how many, and the most frequent one (ties: the smallest)."""
        self.near += np.bincount(mine, minlength=len(self.near))
        for i, j in zip(mine.tolist(), theirs.tolist()):
            if (new := (-int(other.n[j]), other.words[j])) < self.best.get(i, (1,)):
                self.best[i] = new

    def rows(self):
        for i, (n, word) in self.best.items():
            yield self.words[i].decode("latin-1"), int(self.near[i]), -n, word.decode("latin-1")


def _compare(homes: _Slice, guests: _Slice, same: bool) -> None:
    """Notes the near pairs of two slices, 2048 guests at a time by one matrix product."""
    for at in range(0, len(guests.words), HOMES):
        part = slice(at, at + HOMES)
        distance = homes.squares[:, None] + guests.squares[None, part] - 2 * (homes.counts @ guests.counts[part].T)
        near = distance <= 2
        if same:
            near &= np.arange(len(homes.words))[:, None] < np.arange(len(guests.words))[None, part]
        x, y = np.nonzero(near)
        for i in range(0, len(x), 1 << 16):
            a, b = x[i : i + (1 << 16)], y[i : i + (1 << 16)] + at
            edit = one_edit(homes.letters[a], guests.letters[b])
            homes.found(a[edit], guests, b[edit])
            guests.found(b[edit], homes, a[edit])


def _near():
    """Rows (block, i, j, guest, word, n) in this order to (word, near, best_n, best)."""

    def run(batches):
        out = []

        def compared(held):
            homes = [r for r in held if not r[3]]
            if homes and len(held) > 1:
                home = _Slice(homes)
                if held[0][2] == 0:
                    _compare(home, home, True)
                rest = sorted((r for r in held if r[3]), key=lambda r: len(r[4]))
                for _, rows in groupby(rest, key=lambda r: len(r[4])):
                    guests = _Slice(list(rows))
                    _compare(home, guests, False)
                    out.extend(guests.rows())
                out.extend(home.rows())

        def batch_of():
            b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "near", "best_n", "best"])
            out.clear()
            return b

        held, at = [], None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[:3] != at:
                    compared(held)
                    held, at = [], row[:3]
                    if len(out) > 50_000:
                        yield batch_of()
                held.append(row)
        compared(held)
        yield batch_of()

    return run


def near_words(words: DataFrame, path: str) -> DataFrame:
    """(word, n_near, best_n, best) of words (word, n) that have near words: how many, and the most frequent one."""
    groups = max(3, min(24, round(math.log2(max(2, words.count())) / 3)))
    rows = saved(words.mapInArrow(_blocks(groups), "block binary, guest boolean, word string, n long"), f"{path}/blocks")
    size = rows.groupBy("block").agg(F.count_if("guest").alias("guests"), F.count_if(~F.col("guest")).alias("homes")).where("homes > 0 and homes + guests > 1")
    parts = F.ceil(F.col("homes") / HOMES).cast("int")
    chunks = F.ceil((F.col("guests") + F.when(parts > 1, F.col("homes")).otherwise(0)) / GUESTS).cast("int")
    size = saved(size.select("block", parts.alias("parts"), F.greatest(chunks, F.lit(1)).alias("chunks")), f"{path}/sizes")
    x = rows.join(size, "block").withColumn("i", F.pmod(F.xxhash64("word"), "parts").cast("int")).withColumn("j", F.pmod(F.xxhash64("word", F.lit(1)), "chunks").cast("int"))
    # a word of the block goes to all chunks of its slice, and as a guest to the slices before it; a guest to all slices
    at_home = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.struct(F.col("i").alias("i"), j.alias("j"), F.lit(False).alias("guest")))
    before = F.when(F.col("i") > 0, F.sequence(F.lit(0), F.col("i") - 1)).otherwise(F.array().cast("array<int>"))
    visits = F.transform(F.when(F.col("guest"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(before), lambda i: F.struct(i.alias("i"), F.col("j").alias("j"), F.lit(True).alias("guest")))
    to = F.when(F.col("guest"), visits).otherwise(F.concat(at_home, visits))
    dealt = x.select("block", F.explode(to).alias("to"), "word", "n").select("block", "to.i", "to.j", "to.guest", "word", "n")
    found = dealt.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "guest").mapInArrow(_near(), "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.word").alias("best"))


def spelling_variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5) -> DataFrame:
    r"""(word, form, root, n, n_near, form_n) of the words of ``min_chars`` code points and ``min_count`` occurrences.

    Words are the runs ``[A-Za-zÀ-ÿ]+`` of the texts, A-Z in lower case, after ``misprint``. Near words differ
    by exactly one inserted, deleted or replaced code point; n_near counts them. A word's form is its most frequent near
    word (ties: smallest in code-point order) if that occurs ``ratio`` times as often or more, else null; its root is
    where the forms from it end, itself without any. ``ratio`` is 2 or more.

    A null text has no words, a null doc_id reads as nothing in ``misprint``, a repeated row counts again, an empty
    table gives no row. Long texts are read whole, words of any length compared. Other columns are ignored.
    """
    path = work_dir(docs.sparkSession, "spelling")
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counts = rows.mapInArrow(_count(min_chars), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = saved(counts.where(F.col("n") >= min_count), f"{path}/words")
    near = near_words(words, path)
    x = words.join(near, "word", "left")
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    x = saved(x.select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), f"{path}/forms")
    # a form occurs ratio times as often, so a chain of forms is short; every round doubles the steps taken
    up = x.where("form is not null").select("word", F.col("form").alias("root"))
    for i in range(math.ceil(math.log2(63 / math.log2(ratio)))):
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = saved(up.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"{path}/roots{i}")
    x = x.join(up, "word", "left")
    return x.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: SQL: the checksum by its public polynomial over the UTF-8 bytes; near words by patterns with one letter left out.
ORACLE = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS k FROM r WHERE length(run) >= 6 GROUP BY 1, 2),
b AS (SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS bytes FROM d),
h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(bytes, lambda x: x::BIGINT)), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS h FROM b, crc),
w AS (SELECT word, sum(k)::BIGINT AS n FROM (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM h)
  WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5),
p AS (SELECT word, n, length(word) AS size, unnest(range(1, length(word) + 1)) AS pos FROM w),
g AS (SELECT word, n, size, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS rest FROM p),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM g a JOIN g b ON a.rest = b.rest AND a.pos = b.pos AND a.size = b.size AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM g JOIN w ON w.word = g.rest
  UNION SELECT w.word, g.word, g.n FROM g JOIN w ON w.word = g.rest),
near AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM (SELECT DISTINCT * FROM pairs) GROUP BY word),
f AS (SELECT w.word, CASE WHEN best_n >= 5 * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM w LEFT JOIN near USING (word)),
s AS (SELECT word, word AS top FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.top WHERE f.form IS NOT NULL),
up AS (SELECT s.word, s.top AS root FROM s JOIN f ON f.word = s.top WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN up USING (word)
"""
