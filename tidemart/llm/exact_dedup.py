"""Exact duplicates by an extendible-hash index on shared files.

1. Each input task folds its rows: one member row for a document, and one entry for a different text with the
   number of copies and the best of them. A group of copies of any size reaches the index as one entry for a task
   (and for ``FOLD_BYTES`` of held texts).
2. The directory doubles: the bytes of the entries are summed by hash prefix, and a bucket over its limit splits
   on another bit, until it fits or holds one key only, which no bit can split. A directory has at most
   ``2 * MAX_BUCKETS`` buckets; the limit grows with the input beyond that.
3. Owner tasks take whole key ranges. Entries of a bucket come in key order; those with the same key form a chain
   and are compared byte by byte. The bucket files hold a row for a different text: (key, slot in the chain, sha,
   the row that stays, group size).
4. Member rows look up their text's row in the bucket files.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import release_encoders
from .common import DOC_COLUMNS, SPACES, first_of_copies, id_in, id_out, saved, work_dir

KEY_BITS = 63
FOLD_BYTES = 16 << 20
#: What one Arrow batch of entries holds: it lies in the task's Python worker, on its way and in the JVM at a time.
BATCH_BYTES = 2 << 20
BUCKET_BYTES = 1 << 20
MAX_BUCKETS = 1 << 17

ENTRY = "id long, th long, key long, sha binary, norm binary, n_bytes long, n long, best_chars long, best_id long, best_th long"
GROUP = "bucket int, key long, slot int, sha binary, keep_id long, keep_th long, group_size long"


def _better(a, b):
    """The row that stays of two (n_chars, id, th): most code points, then smallest id, then smallest text hash."""
    return a if (-a[0], a[1], a[2]) <= (-b[0], b[1], b[2]) else b


def _slices(held: dict):
    """The held texts in lists of about ``BATCH_BYTES``; they leave ``held`` as they go."""
    rows, size = [], 0
    while held:
        rows.append(held.popitem())
        size += len(rows[-1][0])
        if size > BATCH_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _fold(batches):
    def flush(rows):
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([_key(h[0]) for _, h in rows], pa.int64()), pa.array([h[0] for _, h in rows], pa.binary()),
             pa.array([t for t, _ in rows], pa.binary()), pa.array([len(t) for t, _ in rows], pa.int64()), pa.array([h[1] for _, h in rows], pa.int64()),
             *[pa.array([h[2][i] for _, h in rows], pa.int64()) for i in range(3)]], names=names)

    names = [c.split()[0] for c in ENTRY.split(", ")]
    release_encoders()
    held: dict[bytes, list] = {}
    size = 0
    for batch in batches:
        ids, ths, chars = (batch.column(i).to_pylist() for i in (0, 1, 3))
        keys, shas = [], []
        for i, text in enumerate(batch.column(2)):
            norm = (text.as_py() or b"").translate(None, SPACES)
            row = (chars[i], ids[i], ths[i])
            at = held.get(norm)
            if at is None:
                at = held[norm] = [hashlib.sha256(norm).digest(), 0, row]
                size += len(norm) + 200
            at[1] += 1
            at[2] = _better(at[2], row)
            keys.append(_key(at[0]))
            shas.append(at[0])
            if size > FOLD_BYTES:
                yield from map(flush, _slices(held))
                held, size = {}, 0
        n = len(ids)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(shas, pa.binary()), pa.nulls(n, pa.binary()), *[pa.nulls(n, pa.int64())] * 5], names=names)
    yield from map(flush, _slices(held))


def _key(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "big") >> (64 - KEY_BITS)


def directory(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> list[tuple[int, int]]:
    """Buckets (first key, depth) in key order, found by doubling: only buckets over the limit get another bit.

    Sums by prefix come from Spark, ten more bits at a time and only below buckets that are still too large.
    """
    total = entries.agg(F.sum("n_bytes")).first()[0] or 0
    limit = max(bucket_bytes, math.ceil(total / MAX_BUCKETS))
    done, open_ = [], [(0, 0, total)] if total > limit else []
    while open_:
        base = open_[0][1]
        depth = min(KEY_BITS, base + (max(4, math.ceil(math.log2(total / limit)) + 2) if base == 0 else 10))
        prefix = F.shiftright("key", KEY_BITS - depth)
        parent = F.shiftright("key", KEY_BITS - base)
        below = entries.where(parent.isin([b[0] for b in open_])) if base else entries
        sums = {r.p: r for r in below.groupBy(prefix.alias("p")).agg(F.sum("n_bytes").alias("s"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()}
        by_depth = {depth: {p: r.s for p, r in sums.items()}}
        for d in range(depth - 1, base, -1):
            up: dict[int, int] = {}
            for p, s in by_depth[d + 1].items():
                up[p >> 1] = up.get(p >> 1, 0) + s
            by_depth[d] = up
        todo, again = [(b[0], base, b[2]) for b in open_], []
        while todo:
            p, d, s = todo.pop()
            if s > limit and d < depth:
                todo += [(q, d + 1, by_depth[d + 1].get(q, 0)) for q in (2 * p, 2 * p + 1)]
            elif s > limit and sums[p].lo != sums[p].hi and d < KEY_BITS:
                again.append((p, d, s))
            else:
                done.append((p << (KEY_BITS - d), d))
        open_ = again
    return sorted(done) or [(0, 0)]


def _bucket_of(entries: DataFrame, buckets: list[tuple[int, int]]) -> DataFrame:
    """Entries with the number of their bucket: a directory row for a prefix lists the buckets that begin in it."""
    bits = min(14, max(d for _, d in buckets))
    first: dict[int, list[int]] = {}
    for start, _ in buckets:
        first.setdefault(start >> (KEY_BITS - bits), []).append(start)
    rows, seen = [], 0
    for p in range(1 << bits):
        starts = first.get(p, [])
        rows.append((p, seen - 1, starts))
        seen += len(starts)
    table = entries.sparkSession.createDataFrame(rows, "p int, before int, starts array<long>")
    found = F.col("before") + F.size(F.filter("starts", lambda s: s <= F.col("key")))
    return entries.withColumn("p", F.shiftright("key", KEY_BITS - bits).cast("int")).join(F.broadcast(table), "p").withColumn("bucket", found.cast("int")).drop("p", "before", "starts")


def _own(batches):
    """Chains of one key: entries with equal bytes are one group; others get the next slot."""
    names = [c.split()[0] for c in GROUP.split(", ")]
    key, chain, out = None, [], []

    def close():
        out.extend((bucket, key, slot, sha, best[1], best[2], n) for slot, (sha, _, n, best) in enumerate(chain))

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names=names)

    bucket = 0
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6, 7)]
        norms = batch.column(3)
        for i, (b, k, sha, n, *best) in enumerate(zip(*cols)):
            if k != key:
                close()
                key, chain, bucket = k, [], b
            norm = norms[i].as_py()
            for link in chain:
                if link[1] == norm:
                    link[2] += n
                    link[3] = _better(link[3], tuple(best))
                    break
            else:
                chain.append([sha, norm, n, tuple(best)])
        if len(out) > 20_000:
            yield batch_of(out)
            out.clear()
    close()
    yield batch_of(out)


def build_index(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """(members, groups): a row for a document, and the bucket files with a row for a different text."""
    spark = docs.sparkSession
    path = work_dir(spark, "exact")
    rows = docs.select(id_in().alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    log = saved(rows.mapInArrow(_fold, ENTRY), f"{path}/log")
    entries = log.where("norm IS NOT NULL").drop("id", "th")
    owned = _bucket_of(entries, directory(entries, bucket_bytes)).repartition("bucket").sortWithinPartitions("bucket", "key", "sha")
    groups = owned.select("bucket", "key", "sha", "norm", "n", "best_chars", "best_id", "best_th").mapInArrow(_own, GROUP)
    return log.where("id IS NOT NULL").select("id", "th", "key", "sha"), saved(groups, f"{path}/buckets")


def exact_duplicates(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Groups of documents whose texts are equal after deleting white space (space, \\t to \\r).

    Returns (doc_id, keep_id, group_size, kept, text_sha256, th) for every row. A null text counts as empty. The row
    with the most code points stays, then the smallest doc_id (null last). Repeated rows with the same doc_id and
    text cannot be told apart: they count in the group and share their decision; ``without_copies`` keeps one of
    them. An empty table gives no rows; other columns are ignored.
    """
    members, groups = build_index(docs, bucket_bytes)
    got = members.join(groups.select("key", "sha", "keep_id", "keep_th", "group_size"), ["key", "sha"])
    kept = (F.col("id") == F.col("keep_id")) & F.col("th").eqNullSafe(F.col("keep_th"))
    return got.select(id_out(F.col("id")).alias("doc_id"), id_out(F.col("keep_id")).alias("keep_id"), "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "th")


def without_copies(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, one for each group, with all their columns."""
    _, groups = build_index(docs.select(*[c for c in DOC_COLUMNS if c in docs.columns]), bucket_bytes)
    return first_of_copies(docs, groups.select(F.col("keep_id").alias("id"), F.col("keep_th").alias("th")))
