"""Token counts that follow edits: a segment tree of pre-token runs for each document.

A leaf holds a run of whole pre-tokens that begins where a pre-token begins whatever stands around it: between a
character that isn't white space and white space. So leaves are encoded apart. Inner nodes sum code points and
tokens. An edit finds its leaves by descending the code points, re-encodes only those, together with a neighbour
where the edit changed what stands at a leaf's border, and updates the sums above them.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import WHITE

#: Code points of a leaf at least, unless the text ends; it goes on to the next safe place.
LEAF_CHARS = 256
EDIT = "array<struct<start:long,length:long,insert:string>>"


@lru_cache(maxsize=2)
def counter(ranks: str):
    """Token count of a text: the public tokenizer's merges within each match of its pattern."""
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path(ranks), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


@lru_cache(maxsize=1)
def _cuts():
    import regex

    return regex.compile(f".{{{LEAF_CHARS},}}?(?<![{WHITE}])(?=[{WHITE}])|.+", regex.S)


class Counts:
    """Segment tree over the leaves of one text: ``chars`` and ``tokens`` hold sums, leaf i at ``size + i``."""

    def __init__(self, text: str, count):
        self.count = count
        self.leaves = _cuts().findall(text) or [""]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.leaves += [""] * (self.size - len(self.leaves))
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        self.encoded = 0
        for i, leaf in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = len(leaf), self._encode(leaf)
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _encode(self, leaf):
        self.encoded += len(leaf)
        return self.count(leaf) if leaf else 0

    def _sum(self, i):
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _set(self, i, leaf):
        self.leaves[i] = leaf
        at = self.size + i
        self.chars[at], self.tokens[at] = len(leaf), self._encode(leaf)
        while at := at >> 1:
            self._sum(at)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, place: int) -> tuple[int, int]:
        """(leaf, place in it) of a place between 0 and the text's length; a border belongs to the left leaf."""
        i = 1
        while i < self.size:
            i *= 2
            if place > self.chars[i]:
                place -= self.chars[i]
                i += 1
        return i - self.size, place

    def _next(self, i, step):
        i += step
        while 0 <= i < self.size and not self.leaves[i]:
            i += step
        return i if 0 <= i < self.size else None

    def edit(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` code points from ``start`` (cut to the text) by ``insert``."""
        start = min(max(start, 0), self.chars[1])
        end = min(start + max(length, 0), self.chars[1])
        first, a = self.find(start)
        last, b = self.find(end)
        text = self.leaves[first][:a] + insert + self.leaves[last][b:]
        for i in range(first + 1, last + 1):
            if self.leaves[i]:
                self._set(i, "")
        # the borders must still be safe; an empty leaf has none of its own
        while (left := self._next(first, -1)) is not None and not _safe(self.leaves[left], text):
            text = self.leaves[left] + text
            self._set(left, "")
        while (right := self._next(max(first, last), 1)) is not None and not _safe(text, self.leaves[right]):
            text += self.leaves[right]
            self._set(right, "")
            last = right
        self._set(first, text)


@lru_cache(maxsize=1)
def _white():
    import regex

    return regex.compile(f"[{WHITE}]")


def _safe(left: str, right: str) -> bool:
    return bool(left and right and not _white().match(left[-1]) and _white().match(right[0]))


def count_tokens(docs: DataFrame, edits: str = "edits", ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, n_tokens, n_tokens_edited, n_leaves, chars_encoded, chars_reencoded) of every row.

    ``edits`` is a column EDIT; its edits apply in order, each to the text that the ones before it left. A null
    text counts as empty, a null edit list as none, null fields as 0 or "". Repeated rows repeat. One Arrow pass.
    """

    def run(batches):
        count = counter(ranks)
        for batch in batches:
            rows = []
            for text, changes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tree = Counts(text or "", count)
                before, whole, leaves = tree.total, tree.encoded, sum(map(bool, tree.leaves))
                for e in changes or ():
                    if e:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["insert"] or "")
                rows.append((before, tree.total, leaves, whole, tree.encoded - whole))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]], names=["doc_id", "n_tokens", "n_tokens_edited", "n_leaves", "chars_encoded", "chars_reencoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(edits).cast(EDIT).alias("edits"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_tokens_edited long, n_leaves long, chars_encoded long, chars_reencoded long")


def revision(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``edits`` that every text gets: a deletion, an insertion and a replacement.

    Places follow from doc_id and the text's length, so they fall anywhere in texts of any size.
    """
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long") + 1
    key = F.coalesce(F.col("doc_id"), F.lit(0))
    place = lambda salt: F.pmod(F.xxhash64(key, F.lit(salt)), n)
    edit = lambda start, length, insert: F.struct(start.alias("start"), F.lit(length).cast("long").alias("length"), insert.alias("insert"))
    return docs.withColumn("edits", F.array(
        edit(place(1), 20, F.lit("")),
        edit(place(2), 0, F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit("'s\n"))),
        edit(place(3), 5, F.lit("-edited "))))
