r"""Phrase collocations: multikey three-way quicksort of suffix pointers, routed by leading words, scored by exact counts.

One pass over the texts for each number of words: a map task sorts the suffix pointers of a block of words; the equal
partitions at depth d are the block's phrases of d words, their sizes the counts. Each phrase goes with its count to the
bucket of its leading words, so a phrase that fills a third of the table reaches its bucket as one entry of each block.
The bucket's task sorts what it got once more and abandons every partition whose counts sum to less than the least count;
the next pass leaves out the suffixes that begin with an abandoned phrase, but for those that a filter of bounded size
mistakes. Words travel as hashes of (lang, word) of 48 bits; a bucket of words compares the words themselves, and if two
share a hash, all is done anew with another seed and 8 bits more, up to 64.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, work_dir
from .minhash import mixed

#: Words of a block that a map task sorts at once.
BLOCK = 3 << 19
#: Bytes of text whose phrases share a bucket, on average.
BUCKET_BYTES = 16_000_000
#: A longer text is cut at the next end of a piece.
CHUNK = 1 << 18

#: The characters of ``[.,;:!?\x0A-\x0D]`` end a piece: all become the full stop. A tab becomes a space.
PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"......... ")

#: Bits of the filter of frequent phrases at most (32 MB); beyond 10^8 of them it lets more and more infrequent ones pass.
FILTER_BITS = 1 << 28

#: Words of one lang, their hashes and counts.
ROUTED_WORDS = "bucket long, lang binary, words binary, hashes binary, counts binary"
#: Hashes of words, phrases as places in these, and counts.
ROUTED_PHRASES = "bucket long, hashes binary, ids binary, counts binary"
#: kind 0 are the words of a lang, a greater one the phrases of so many words, -1 two words with one hash.
COUNTED = "kind int, lang binary, word binary, h array<long>, route long, f long"


def chunks(text: bytes):
    """The text in parts of about CHUNK bytes that end where a piece does."""
    at = 0
    while at < len(text):
        end = at + CHUNK
        end = len(text) if end >= len(text) else text.find(b".", end) + 1 or len(text)
        yield text[at:end]
        at = end


def equal_partitions(text: np.ndarray, p: np.ndarray, depth: int, weight: np.ndarray | None = None, least: int = 1):
    """The prefixes of 1 to ``depth`` words of the suffixes that ``p`` points to, counted by three-way partitioning.

    ``text`` holds word numbers; 0 ends a suffix, and ``depth`` of them end the text. A round parts every open segment
    by the word of its middle element into smaller, equal and larger suffixes; an equal part is a phrase and goes on
    with the next word. Segments whose weights (1 each if not given) sum to less than ``least`` are abandoned.
    Returns (pointers, counts) for each depth, with one pointer for each phrase.
    """
    found: list[list] = [[(np.empty(0, p.dtype), np.empty(0, np.int64))] for _ in range(depth)]
    sizes, at = np.array([len(p)] if len(p) else [], np.int64), np.zeros(min(1, len(p)), np.int64)
    while len(p):
        if least <= 1 and (one := sizes == 1).any():  # a suffix alone in its segment needs no more rounds
            mine = np.repeat(one, sizes)
            q, d, w = p[mine], at[one], None if weight is None else weight[mine]
            for j in range(depth):
                live = (d > j) | (text[q + j] != 0)
                q, d, w = q[live], d[live], w if w is None else w[live]
                new = d <= j
                found[j].append((q[new], np.ones(np.count_nonzero(new), np.int64) if w is None else w[new]))
            p, weight, at, sizes = p[~mine], weight if weight is None else weight[~mine], at[~one], sizes[~one]
            if not len(p):
                break
        starts = np.cumsum(sizes) - sizes
        word = text[p + np.repeat(at, sizes)]
        pivot = word[starts + sizes // 2]
        each = np.repeat(pivot, sizes)
        parts = []
        for i, side in enumerate((word < each, word == each, word > each)):
            ends = np.concatenate(([0], np.cumsum(side)))
            n = ends[starts + sizes] - ends[starts]
            total = n if weight is None else np.add.reduceat(np.where(side, weight, 0), starts)
            keep = (n > 0) & (total >= least)
            if i == 1:
                keep &= pivot != 0
            live = side & np.repeat(keep, sizes)
            q, w, n, d, total = p[live], weight if weight is None else weight[live], n[keep], at[keep], total[keep]
            if i == 1:
                head = np.cumsum(n) - n
                for j in range(depth):
                    here = d == j
                    found[j].append((q[head[here]], total[here]))
                more = d + 1 < depth
                go = np.repeat(more, n)
                q, w, n, d = q[go], w if w is None else w[go], n[more], d[more] + 1
            parts.append((q, w, n, d))
        p, sizes, at = (np.concatenate([x[i] for x in parts]) for i in (0, 2, 3))
        weight = None if weight is None else np.concatenate([x[1] for x in parts])
    return [tuple(np.concatenate(x) for x in zip(*f)) for f in found]


def routes(hashes: np.ndarray) -> np.ndarray:
    """One hash for each row of word hashes."""
    h = np.full(len(hashes), hashes.shape[1], np.uint64)
    for j in range(hashes.shape[1]):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + hashes[:, j])
    return h


class _Numbers(dict):
    """Numbers from 1 for the words of a language, in the list that all languages of a block share; 0 ends a piece."""

    def __init__(self, words: list):
        self.words = words
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = n = len(self.words)
        return n


def _small(x: np.ndarray) -> bytes:
    """Unsigned integers in the least number of bytes that holds the largest one."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0)).tobytes()


def _large(x: bytes, n: int) -> np.ndarray:
    """``n`` numbers of ``_small``."""
    return np.frombuffer(x, f"u{len(x) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def _width(seed: int) -> int:
    """Bytes of a word's hash: a collision means another seed and a byte more."""
    return min(8, 6 + seed)


def _packed(hashes: np.ndarray, seed: int) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _width(seed)].tobytes()


def _unpacked(hashes: bytes, seed: int) -> np.ndarray:
    out = np.zeros((len(hashes) // _width(seed), 8), np.uint8)
    out[:, : _width(seed)] = np.frombuffer(hashes, np.uint8).reshape(len(out), -1)
    return out.view("<u8").ravel()


def _hashes(langs: dict, words: list, seed: int) -> np.ndarray:
    import xxhash

    out = np.zeros(len(words) + 1, np.uint64)
    for lang, numbers in langs.items():
        salt = xxhash.xxh64_intdigest(lang, seed)
        for word, n in numbers.items():
            if n:
                out[n] = xxhash.xxh64_intdigest(word, salt)
    return out & np.uint64((1 << (8 * _width(seed))) - 1)


def _blocks(batches, size: int):
    """(langs, words, text) of blocks of about ``size`` words: numbers of words by lang, 0 between pieces."""
    langs, words, parts, n = {}, [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for chunk in chunks((text.as_py() or b"").lower().translate(PIECES)):
                tokens = chunk.replace(b".", b" . ").split()
                numbers = langs.setdefault(lang, _Numbers(words))
                parts += np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens)), np.zeros(1, np.int32)
                n += len(tokens)
                if n >= size:
                    yield langs, words, np.concatenate(parts)
                    langs, words, parts, n = {}, [], [], 0
    if parts:
        yield langs, words, np.concatenate(parts)


def _in_batches(rows, schema: pa.Schema, size: int):
    rows = iter(rows)
    while some := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _route_words(buckets: int, seed: int):
    """(lang, text) to ROUTED_WORDS: the words of a block with their counts, by bucket and lang."""
    schema = pa.schema([("bucket", pa.int64()), *[(c, pa.binary()) for c in ("lang", "words", "hashes", "counts")]])

    def rows(batches):
        for langs, words, text in _blocks(batches, BLOCK):
            hashes = _hashes(langs, words, seed)
            bucket = routes(hashes[:, None]) % np.uint64(buckets)
            count = np.bincount(text, minlength=len(hashes))
            for lang, numbers in langs.items():
                own = np.fromiter(numbers.values(), np.int64, len(numbers))[1:]
                own = own[np.argsort(bucket[own], kind="stable")]
                for x in np.split(own, np.flatnonzero(np.diff(bucket[own])) + 1):
                    if len(x):
                        yield int(bucket[x[0]]), lang, b"\n".join([words[i - 1] for i in x.tolist()]), _packed(hashes[x], seed), _small(count[x])

    return lambda batches: _in_batches(rows(batches), schema, 64)


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    at = h & np.uint64(8 * len(bits) - 1)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _each(text: np.ndarray, hashes: np.ndarray, p: np.ndarray, d: int) -> np.ndarray:
    """Route hashes of the ``d`` words at each pointer."""
    out = np.zeros(len(p), np.uint64)
    for i in range(0, len(p), 1 << 18):
        out[i : i + (1 << 18)] = routes(hashes[np.stack([text[p[i : i + (1 << 18)] + j] for j in range(d)], axis=1)])
    return out


def _route_phrases(d: int, buckets: int, seed: int, words_kept: bytes, kept: bytes):
    """(lang, text) to ROUTED_PHRASES: a block's phrases of ``d`` words with their counts, by bucket.

    ``words_kept`` and ``kept`` are the filters of frequent words and of frequent phrases of d - 1 words."""
    schema = pa.schema([("bucket", pa.int64()), *[(c, pa.binary()) for c in ("hashes", "ids", "counts")]])

    def rows(batches):
        for langs, words, text in _blocks(batches, BLOCK):
            hashes = _hashes(langs, words, seed)
            stay = _passes(np.frombuffer(words_kept, np.uint8), hashes)
            stay[0] = False
            text = np.concatenate([np.where(stay[text], text, 0).astype(np.int32), np.zeros(d, np.int32)])
            whole = text[:-d] != 0
            for j in range(1, d):
                whole &= text[j : j - d] != 0
            p = np.flatnonzero(whole).astype(np.int32)
            if d > 2:
                bits = np.frombuffer(kept, np.uint8)
                p = p[_passes(bits, _each(text, hashes, p, d - 1))]
                p = p[_passes(bits, _each(text, hashes, p + 1, d - 1))]
            p, n = equal_partitions(text, p, d)[d - 1]
            bucket = _each(text, hashes, p, d) % np.uint64(buckets)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
            p, n, bucket = p[order], n[order], bucket[order]
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(p)]
            rank, seen = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
            for x in (slice(*e) for e in itertools.pairwise(edges) if e[0] < e[1]):
                ids = np.concatenate([text[p[x] + j] for j in range(d)])
                seen[ids] = True
                own = np.flatnonzero(seen)
                seen[own] = False
                rank[own] = np.arange(len(own))
                yield int(bucket[x.start]), _packed(hashes[own], seed), rank[ids].astype(np.min_scalar_type(len(own))).tobytes(), _small(n[x])

    return lambda batches: _in_batches(rows(batches), schema, 32)


def _of_buckets(count):
    """Rows in order of bucket to COUNTED rows, by ``count`` of each bucket's rows."""
    schema = pa.schema([("kind", pa.int32()), ("lang", pa.binary()), ("word", pa.binary()), ("h", pa.list_(pa.int64())), ("route", pa.int64()), ("f", pa.int64())])

    def rows(batches):
        all_rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        for _, own in itertools.groupby(all_rows, key=lambda row: row[0]):
            yield from count(list(own))

    return lambda batches: _in_batches(rows(batches), schema, 50_000)


def _count_words(least: int, seed: int):
    def count(rows):
        names, sums, totals = {}, {}, {}
        for _, lang, words, hashes, counts in rows:
            hashes = _unpacked(hashes, seed).view(np.int64).tolist()
            n = _large(counts, len(hashes)).tolist()
            totals[lang] = totals.get(lang, 0) + sum(n)
            for word, h, c in zip(words.split(b"\n"), hashes, n):
                if names.setdefault(h, (lang, word)) != (lang, word):
                    yield -1, lang, word, [h], h, c
                sums[h] = sums.get(h, 0) + c
        for lang, n in totals.items():
            yield 0, lang, None, None, None, n
        for h, n in sums.items():
            if n >= least:
                yield 1, *names[h], [h], h, n

    return count


def _count_phrases(d: int, least: int, seed: int):
    def count(rows):
        parts = [_unpacked(r[1], seed) for r in rows]
        known, place = np.unique(np.concatenate(parts), return_inverse=True)
        text, n, shift = [], [], 0
        for (_, _, ids, counts), size in zip(rows, map(len, parts)):
            at = np.frombuffer(ids, np.min_scalar_type(size)).astype(np.int64).reshape(d, -1)
            text.append(place[at + shift].T)
            n.append(_large(counts, at.shape[1]))
            shift += size
        text, n = np.concatenate(text).astype(np.int32) + 1, np.concatenate(n)
        p, total = equal_partitions(np.concatenate([text.ravel(), np.zeros(d, np.int32)]), np.arange(len(n)) * d, d, n, least)[d - 1]
        h = known[text[p // d] - 1]
        for *row, f in zip(h.view(np.int64).tolist(), routes(h).view(np.int64).tolist(), total.tolist()):
            yield d, None, None, *row, f

    return count


def _filter(phrases: DataFrame) -> bytes:
    """A bit for every ``route`` of COUNTED rows, by its lowest bits; two bytes a phrase, FILTER_BITS in all at most."""
    size, n = 1 << 15, phrases.count()
    while size < FILTER_BITS and size < 16 * n:
        size *= 2
    byte = phrases.selectExpr(f"shiftright(route & {size - 1}L, 3) AS byte", "shiftleft(1, cast(route & 7 AS int)) AS bit")
    parts = byte.groupBy("byte").agg(F.bit_or("bit").alias("bits")).groupBy(F.shiftright("byte", 12).alias("part"))
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("byte", "bits"))).alias("own")).select("part", "own.byte", "own.bits")

    def blocks(batches):
        for batch in batches:
            found = []
            for at, bits in zip(batch.column(1), batch.column(2)):
                block = np.zeros(1 << 12, np.uint8)
                block[at.values.to_numpy() & 4095] = bits.values.to_numpy()
                found.append(block.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["part", "block"])

    out = bytearray(size // 8)
    for part, block in parts.mapInArrow(blocks, "part long, block binary").collect():
        out[part << 12 : part + 1 << 12] = block
    return bytes(out)


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """COUNTED rows: the phrases of 1 to ``longest`` words with ``least`` occurrences or more, and all words of each lang.

    h are the hashes of the words; a word's own row (kind 1) names it and its lang.
    """
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "collocations")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"), F.col("text").cast("binary").alias("text"))
    buckets = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES + 1

    def dealt(routed):
        return routed.repartition(int(min(buckets, 1 << 20)), "bucket").sortWithinPartitions("bucket")

    for seed in itertools.count():
        words = dealt(rows.mapInArrow(_route_words(buckets, seed), ROUTED_WORDS)).mapInArrow(_of_buckets(_count_words(least, seed)), COUNTED)
        words = saved(words, f"{path}/words{seed}")
        if words.where("kind = -1").isEmpty():
            break
    counted, kept = words, spark.sparkContext.broadcast(_filter(words.where("kind = 1")))
    words_kept = kept
    for d in range(2, longest + 1):
        def phrases(batches, d=d, kept=kept):
            return _route_phrases(d, buckets, seed, words_kept.value, kept.value)(batches)

        found = dealt(rows.mapInArrow(phrases, ROUTED_PHRASES)).mapInArrow(_of_buckets(_count_phrases(d, least, seed)), COUNTED)
        found = saved(found, f"{path}/phrases{d}")
        counted = counted.union(found)
        if d < longest:
            kept = spark.sparkContext.broadcast(_filter(found))
    return counted


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000) -> DataFrame:
    r"""The best phrases of 2 to ``longest`` words of each lang: (lang, rank, phrase, a, l, r, n, score).

    Texts are split at ``[.,;:!?\x0A-\x0D]`` into pieces and these at spaces and tabs into words, A-Z in lower case. A
    candidate occurs a >= ``least`` times within pieces, overlaps included. Cut after k words its parts occur l and r
    times; its score is the least floor(1000000 a a / (l r)) of its cuts (ties: smallest k), in exact decimals up to
    a = 10^16. Candidates are dropped that lie within a longer one with 100 f >= ``covered`` a. The ``top`` ones of each
    lang by (score, a) descending and phrase ascending are ranked from 1; n are all words of the lang.

    A null text is empty and a null lang is ``und``; a text without words adds nothing, a repeated row counts again,
    an empty table gives no row, a text of any length is read whole. Bytes that are no UTF-8 are letters like others.
    Other columns are ignored.
    """
    counted = phrase_counts(docs, longest, least)
    path = work_dir(docs.sparkSession, "collocations-scored")
    part = {d: counted.where(F.col("kind") == d).select("h", "f") for d in range(1, longest + 1)}
    named = {1: counted.where("kind = 1").select("h", F.col("lang").cast("string").alias("lang"), F.col("word").cast("string").alias("phrase"), "f")}
    for d in range(2, longest + 1):
        t = part[d].withColumnRenamed("f", "a").withColumn("first", F.slice("h", 1, 1)).withColumn("rest", F.slice("h", 2, d - 1))
        t = t.join(named[1].select(F.col("h").alias("first"), "lang", F.col("phrase").alias("word"), F.col("f").alias("l1")), "first")
        t = t.join(named[d - 1].select(F.col("h").alias("rest"), F.col("phrase").alias("more"), F.col("f" if d == 2 else "a").alias("r1")), "rest")
        for k in range(2, d):
            t = t.withColumn("head", F.slice("h", 1, k)).join(part[k].select(F.col("h").alias("head"), F.col("f").alias(f"l{k}")), "head")
            t = t.withColumn("tail", F.slice("h", k + 1, d - k)).join(part[d - k].select(F.col("h").alias("tail"), F.col("f").alias(f"r{k}")), "tail")
        whole = "cast({} as decimal(19,0))".format
        cuts = [F.struct(F.expr(f"(cast(1000000 as decimal(7,0)) * {whole('a')} * {whole('a')}) div ({whole(f'l{k}')} * {whole(f'r{k}')})").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, d)]
        cut = F.least(*cuts) if d > 2 else cuts[0]
        named[d] = saved(t.select("h", "lang", F.concat_ws(" ", "word", "more").alias("phrase"), "a", cut.alias("cut")), f"{path}/phrases{d}")
    kept = []
    for d in range(2, longest + 1):
        inside = [named[e].select(F.slice("h", i, d).alias("h"), "a") for e in range(d + 1, longest + 1) for i in range(1, e - d + 2)]
        t = named[d]
        if inside:
            over = inside[0]
            for x in inside[1:]:
                over = over.union(x)
            t = t.join(over.groupBy("h").agg(F.max("a").alias("over")), "h", "left").where(f"over is null or 100 * over < {covered} * a")
        kept.append(t.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    rows = kept[0]
    for t in kept[1:]:
        rows = rows.union(t)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    totals = counted.where("kind = 0").groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("f").alias("n"))
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: SQL for two and three words.
ORACLE = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
x AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
c1 AS (SELECT lang, w[i] AS p, count(*) AS f FROM x GROUP BY 1, 2),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c1 GROUP BY 1),
c2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM x WHERE i < len(w) GROUP BY 1, 2, 3 HAVING count(*) >= 10),
c3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM x WHERE i + 1 < len(w) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
cuts AS (
  SELECT c2.lang, x || ' ' || y AS phrase, c2.f AS a, 1 AS k, u.f AS l, v.f AS r FROM c2 JOIN c1 u ON u.lang = c2.lang AND u.p = x JOIN c1 v ON v.lang = c2.lang AND v.p = y
    WHERE NOT EXISTS (SELECT 1 FROM c3 WHERE c3.lang = c2.lang AND c3.x = c2.x AND c3.y = c2.y AND 100 * c3.f >= 50 * c2.f)
      AND NOT EXISTS (SELECT 1 FROM c3 WHERE c3.lang = c2.lang AND c3.y = c2.x AND c3.z = c2.y AND 100 * c3.f >= 50 * c2.f)
  UNION ALL SELECT c3.lang, c3.x || ' ' || c3.y || ' ' || z, c3.f, 1, u.f, v.f FROM c3 JOIN c1 u ON u.lang = c3.lang AND u.p = c3.x JOIN c2 v ON v.lang = c3.lang AND v.x = c3.y AND v.y = z
  UNION ALL SELECT c3.lang, c3.x || ' ' || c3.y || ' ' || z, c3.f, 2, u.f, v.f FROM c3 JOIN c2 u ON u.lang = c3.lang AND u.x = c3.x AND u.y = c3.y JOIN c1 v ON v.lang = c3.lang AND v.p = z),
s AS (SELECT *, (1000000 * a::HUGEINT * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
b AS (SELECT lang, phrase, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase, a ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
