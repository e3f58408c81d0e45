"""Packing by lexical retrieval: a sharded BM25 index returns unused neighbours, which fill a seed's window.

Documents are encoded once, and document frequencies and the mean length are those of the whole table. Documents are
dealt to shards of about ``SHARD_BYTES`` of text by content: in order of the terms of largest weight, so those that share such
terms lie together, and a group that is over the limit is split by its next terms. A shard's task
builds an inverted index over the token ids with BM25 weights, and lays the documents out: the document
that is open at the end of the last window is the next seed, its best unused neighbours fill the window, and
the one that runs over the end is cut there. So a sequence is full unless it is its shard's last.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import release_encoders, word_bpe
from .common import saved, work_dir

WINDOW = 4096
END_ID = 2
SHARD_BYTES = 8 << 20
#: A seed asks with its terms of largest weight.
QUERY_TERMS = 32
#: Terms of those that deal a document.
KEY_TERMS = 8
IDS = 1 << 16
K1, B = 1.2, 0.75

#: Documents sampled for each shard.
SAMPLED = 20
#: Shards of a range, as bits.
PART_BITS = 12

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, ids binary"


def terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order and how often each occurs: the stable sort of 16-bit numbers is a radix sort."""
    at = np.sort(ids, kind="stable")
    new = np.ones(len(at), bool)
    np.not_equal(at[1:], at[:-1], out=new[1:])
    first = np.flatnonzero(new)
    end = np.full(len(first), len(at))
    end[:-1] = first[1:]
    return at[first], end - first


def heaviest(weight: np.ndarray) -> np.ndarray:
    """Places of the ``QUERY_TERMS`` largest weights above 0, largest first, ties in order."""
    some = np.arange(len(weight))
    if len(weight) > 4 * QUERY_TERMS:
        least = np.partition(weight, len(weight) - QUERY_TERMS)[len(weight) - QUERY_TERMS]
        some = np.flatnonzero(weight >= least)
    top = some[np.argsort(-weight[some], kind="stable")[:QUERY_TERMS]]
    return top[weight[top] > 0]


class Corpus:
    """Document frequencies and the mean length of a whole table, and the BM25 weights that follow from them."""

    def __init__(self, n: int, df: np.ndarray, mean: float):
        self.df, self.mean = df, mean
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)

    def weight(self, term: np.ndarray, tf: np.ndarray, length) -> np.ndarray:
        return self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))


class Index:
    """BM25 inverted index of one shard: postings in order of term, with the weight of the term in the document."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        self.n = len(docs)
        own, counts, sizes = [], [], []
        for ids in docs:
            t, c = terms(ids)
            own.append(t)
            counts.append(c)
            sizes.append(len(t))
        length = np.array([max(1, len(d)) for d in docs], np.float32)
        term, tf = np.concatenate(own), np.concatenate(counts).astype(np.float32)
        doc = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        df = np.bincount(term, minlength=IDS)
        weight = (corpus or Corpus(self.n, df, length.mean())).weight(term, tf, length[doc]).astype(np.float32)
        self.own = np.concatenate([[0], np.cumsum(sizes)])
        self.own_term, self.own_weight = term, np.where(df[term] > 1, weight, 0)
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.first = np.concatenate([[0], np.cumsum(df)])

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share a query term with ``seed``, best first (ties in order of the shard)."""
        a, b = self.own[seed], self.own[seed + 1]
        score = np.zeros(self.n, np.float32)
        for t in self.own_term[a:b][heaviest(self.own_weight[a:b])]:
            at = slice(self.first[t], self.first[t + 1])
            score[self.doc[at]] += self.weight[at]
        score[used] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def layout(docs: list[np.ndarray], corpus: Corpus | None = None) -> list[int]:
    """Order of the documents in the stream that is cut into windows; without ``corpus`` they are all there is."""
    index, used, order, filled, next_ = Index(docs, corpus), np.zeros(len(docs), bool), [], 0, 0

    def put(d):
        used[d] = True
        order.append(d)
        return len(docs[d])

    while len(order) < len(docs):
        if not filled:
            while used[next_]:
                next_ += 1
            filled = put(next_) % WINDOW
            continue
        room, found = WINDOW - filled, False
        for d in index.neighbours(order[-1], used):
            found = True
            room -= put(d)
            if room <= 0:
                break
        if room > 0 and not found and len(order) < len(docs):
            while used[next_]:
                next_ += 1
            room -= put(next_)
        filled = -room % WINDOW if room <= 0 else WINDOW - room
    return order


KEYED = "doc_id long, place long, n_bytes long, ids binary, key binary, part long"
ENCODED = "doc_id long, place long, n_bytes long, n_tokens long, ids binary, df array<int>"


def _encode(tokenizer: str):
    """Rows of ENCODED: one for each document, and one a task with the number of its documents that hold each id."""

    def batch_of(doc_id, place, n_bytes, ids, df):
        n = [None if i is None else len(i) // 2 for i in ids]
        return pa.RecordBatch.from_arrays(
            [doc_id, place, n_bytes, pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(df, pa.list_(pa.int32()))], names=[c.split()[0] for c in ENCODED.split(", ")])

    def run(batches):
        bpe, end, df = word_bpe(tokenizer), END_ID.to_bytes(2, "little"), np.zeros(IDS, np.int32)
        for batch in batches:
            ids = [bpe.encode(t or "") + end for t in batch.column(3).to_pylist()]
            for i in ids:
                df[terms(np.frombuffer(i, "<u2"))[0]] += 1
            yield batch_of(batch.column(0), batch.column(1), batch.column(2), ids, [None] * len(ids))
        none = pa.array([None], pa.int64())
        yield batch_of(none, none, none, [None], [df])

    return run


def _key(corpus: Corpus, fits: float, cuts: list[tuple[bytes, int]]):
    """Adds the key that deals a document, its terms of largest weight that others have too, and its range by ``cuts``.

    First those whose documents fit one shard, the most frequent before the others; then the rest, rarest first.
    """
    df = corpus.df
    rank = np.empty(IDS, np.uint16)
    rank[np.lexsort((np.where(df <= fits, -df, df), df > fits))] = np.arange(IDS, dtype=np.uint16)

    def key(ids: bytes) -> bytes:
        at = np.frombuffer(ids, "<u2")
        term, tf = terms(at)
        w = np.where(df[term] > 1, corpus.weight(term, tf, len(at)), 0)
        return np.sort(rank[term[heaviest(w)]])[:KEY_TERMS].astype(">u2").tobytes()

    def run(batches):
        release_encoders()
        for batch in batches:
            keys = [key(i) for i in batch.column(3).to_pylist()]
            part = [bisect.bisect_right(cuts, k) for k in zip(keys, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary()), pa.array(part, pa.int64())], names=[c.split()[0] for c in KEYED.split(", ")])

    return run


def _cuts(sample: list[tuple[bytes, int, int]], shards: int) -> list[tuple[bytes, int]]:
    """Where (key, place) in order pass each of ``shards`` equal shares of the bytes of rows (key, place, n_bytes)."""
    sample = sorted(sample)
    share = np.cumsum([r[2] for r in sample]) * shards // max(1, sum(r[2] for r in sample))
    return [sample[i][:2] for i in range(1, len(sample)) if share[i] > share[i - 1] and share[i] < shards]


def _pack(corpus: Corpus, limit: int, keep_ids: bool):
    """Windows of the documents of each range, which is cut into shards of at most ``limit`` bytes or one document."""

    def packed(shard: int, doc_ids: list, docs: list[np.ndarray]) -> pa.RecordBatch:
        out, position = [], 0
        total = sum(map(len, docs))
        last, rest = divmod(total, WINDOW)
        last_length = rest if rest & (rest - 1) == 0 else WINDOW
        for d in layout(docs, corpus):
            ids, start = docs[d], 0
            while start < len(ids):
                sequence, offset = divmod(position, WINDOW)
                piece = ids[start : start + WINDOW - offset].astype("<u4").tobytes()
                n = len(piece) // 4
                out.append((doc_ids[d], start, n, zlib.crc32(piece), len(ids), (shard << 32) + sequence, offset, last_length if sequence == last else WINDOW, piece if keep_ids else None))
                start += n
                position += n
        names = [c.split()[0] for c in PIECE.split(", ")]
        kinds = [pa.int64()] * 8 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(9)], names=names)

    def run(batches):
        release_encoders()
        at, shard, size, doc_ids, docs = None, 0, 0, [], []
        for batch in batches:
            for part, doc_id, n, ids in zip(*[batch.column(c).to_pylist() for c in range(4)]):
                if docs and (part != at or size + n > limit):
                    yield packed(shard, doc_ids, docs)
                    size, doc_ids, docs = 0, [], []
                    shard += 1
                if part != at:
                    at, shard = part, part << PART_BITS
                size += n
                doc_ids.append(doc_id)
                docs.append(np.frombuffer(ids, "<u2"))
        if docs:
            yield packed(shard, doc_ids, docs)

    return run


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", shard_bytes: int = SHARD_BYTES, keep_ids: bool = True) -> DataFrame:
    """Sequences of at most 4096 tokens that hold every token of every document once.

    Returns a row for a piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length,
    ids as little-endian unsigned 32 bit). A document is its ids and the end id 2; a null text counts as empty and
    is the end id alone. Repeated rows are packed each. sequence_length is 4096, or the tokens of a shard's last
    sequence if they are a power of two; what it has beyond its pieces is padding. An empty table gives no rows.
    Shards are ranges of the keys of ``_key`` (cut by a sample), then of a hash of doc_id and place in the input, so rows with one key
    are spread too; a range over twice ``shard_bytes`` is cut.
    """
    path = work_dir(docs.sparkSession, "packing")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
    place = F.xxhash64("doc_id", F.monotonically_increasing_id())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), place.alias("place"), size.cast("long").alias("n_bytes"), F.col("text").cast("string").alias("text"))
    encoded = saved(rows.mapInArrow(_encode(tokenizer), ENCODED), f"{path}/encoded")
    n, tokens, total = encoded.where("n_tokens IS NOT NULL").agg(F.count("*"), F.sum("n_tokens"), F.sum("n_bytes")).first()
    df = np.zeros(IDS, np.int64)
    for t, c in encoded.where("df IS NOT NULL").select(F.posexplode("df").alias("t", "c")).where("c > 0").groupBy("t").agg(F.sum("c")).collect():
        df[t] = c
    corpus, shards = Corpus(n, df, (tokens or 1) / max(1, n)), -(-(total or 0) // shard_bytes) or 1
    rows = encoded.where("n_tokens IS NOT NULL").select("doc_id", "place", "n_bytes", "ids")

    def keyed(rows, cuts):
        return rows.mapInArrow(_key(corpus, n / shards, cuts), KEYED)

    some = max(1, n // min(max(1000, SAMPLED * shards), 1_000_000))
    cuts = _cuts([tuple(r) for r in keyed(rows.where(F.pmod("place", F.lit(some)) == 0), []).select("key", "place", "n_bytes").collect()] if shards > 1 else [], shards)
    dealt = keyed(rows, cuts).repartition(shards, "part").sortWithinPartitions("part", "key", "place")
    return dealt.select("part", "doc_id", "n_bytes", "ids").mapInArrow(_pack(corpus, 2 * shard_bytes, keep_ids), PIECE)
