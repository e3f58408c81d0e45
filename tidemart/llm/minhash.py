"""Near duplicates: universal hash minima, banding, signature check, exact check, components by alternating stars.

Documents with the same shingle set form a class first, so copies cost nothing further. A band's bucket never
gives all pairs of its classes: it gives a star around one of them, links are confirmed on full shingle sets, and
components are found; buckets that then lie in one component are done. What is left gets a second star round
with other centres, and then every pair of classes of a bucket that still lie in different components and whose
signatures agree is compared, in blocks. So each link between components is found wherever the bands propose it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import release_encoders
from .common import first_of_copies, id_in, id_out, saved, work_dir

BANDS, ROWS = 50, 6
HASHES = BANDS * ROWS
#: Agreement of signatures below which a pair isn't compared: five standard deviations under the threshold.
SLACK = 5.0
#: Classes of a bucket that one task compares with as many others.
BLOCK = 2048
#: Shingle hashes of a bottom sketch.
SMALLEST = 1024
#: Ids of candidate documents that are broadcast at most (16 bytes each).
BROADCAST_IDS = 1_000_000

SKETCH = "id long, th long, n long, fp binary, sig binary, bands array<long>"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public constants of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words are one shingle; none give none."""
    import xxhash

    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    w = min(k, len(words))
    out = np.full(len(h) - w + 1, w, np.uint64)
    for j in range(w):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - w + 1 + j]
    return np.unique(mixed(out))


def shingle_set(text: bytes, k: int) -> set:
    words = text.lower().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*[words[j:] for j in range(k)]))


def _coefficients():
    rng = np.random.default_rng(20_240_607)
    return rng.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, HASHES, np.uint32)


def _sketcher(k: int):
    def run(batches):
        import xxhash

        release_encoders()
        a, b = _coefficients()
        weights = np.random.default_rng(7).integers(0, 1 << 63, HASHES, np.uint64) | np.uint64(1)
        band_salt = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        known: dict[bytes, tuple] = {}
        for batch in batches:
            n, fps, sigs, bands = [], [], [], []
            for text in batch.column(2):
                s = shingle_hashes((text.as_py() or b"").lower().split(), k)
                fp = xxhash.xxh3_128_digest(s.tobytes())
                if (got := known.get(fp)) is None:
                    if len(known) > 20_000:
                        known.clear()
                    got = (None, None)
                    if len(s):
                        low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
                        x = (s >> np.uint64(32)).astype(np.uint32)
                        for i in range(0, len(x), 1024):
                            np.minimum(low, (a[:, None] * x[None, i : i + 1024] + b[:, None]).min(axis=1), out=low)
                        keys = mixed((low.astype(np.uint64) * weights).reshape(BANDS, ROWS).sum(axis=1) + band_salt)
                        got = (low.astype(np.uint8).tobytes(), keys.view(np.int64))
                    known[fp] = got
                n.append(len(s))
                fps.append(fp)
                sigs.append(got[0])
                bands.append(got[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(fps, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "th", "n", "fp", "sig", "bands"])

    return run


def agreement_floor(threshold: int) -> float:
    """Share of equal signature bytes that a pair at the threshold falls below by chance once in millions."""
    j = threshold / 100
    return j - SLACK * (j * (1 - j) / HASHES) ** 0.5


def _signatures_agree(threshold: int):
    floor = agreement_floor(threshold)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3))
            same = (x == y).mean(axis=1) >= floor
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(same)) for i in range(2)], names=["a", "b"])

    return run


def _confirm(k: int, threshold: int):
    """Pairs whose full shingle sets are similar; rows come in order of a, whose set is built once."""

    def run(batches):
        last, sets = None, None
        for batch in batches:
            hit = []
            for i, a in enumerate(batch.column(0).to_pylist()):
                if a != last:
                    last, sets = a, shingle_set(batch.column(2)[i].as_py(), k)
                other = shingle_set(batch.column(3)[i].as_py(), k)
                both = len(sets & other)
                hit.append(100 * both >= threshold * (len(sets) + len(other) - both))
            m = pa.array(hit, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(m), batch.column(1).filter(m)], names=["a", "b"])

    return run


def components(links: DataFrame, path: str) -> DataFrame:
    """(node, comp) of every linked node but comp itself by alternating large-star and small-star; comp is the smallest node.

    Both steps attach neighbours to the smallest neighbour; minima are pre-aggregated, so a node with very many
    neighbours reaches its task as one row from each map task, and the join that follows can be split. Each round
    is a written table; rounds grow with the logarithm of the longest chain.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = saved(edges, f"{path}/edges0")
    before = None
    for i in range(1, 100):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = saved(small, f"{path}/edges{i}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp")


def _sketch_of(k: int):
    """(node, low) of (node, text): the SMALLEST lowest shingle hashes, in order, as unsigned 32-bit numbers."""

    def run(batches):
        for batch in batches:
            low = [(shingle_hashes(t.as_py().lower().split(), k)[:SMALLEST] >> np.uint64(32)).astype(np.uint32).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(low, pa.binary())], names=["node", "low"])

    return run


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[float, int]:
    """Estimate from two bottom sketches, and how many hashes it rests on; exact if neither sketch is full."""
    both = np.sort(np.concatenate([a, b]))
    twice = both[:-1][both[1:] == both[:-1]]
    union = len(both) - len(twice)
    if max(len(a), len(b)) < SMALLEST:
        return len(twice) / max(1, union), 0
    edge = np.unique(both)[SMALLEST - 1]
    return np.count_nonzero(twice <= edge) / SMALLEST, SMALLEST


def _pairs_in_blocks(threshold: int):
    """Pairs of different components of rows (key, i, j, block, node, comp, sig, bands, low) in order of key, i, j.

    A pair is looked at in its first common bucket only. Its signatures must agree, then its bottom sketches: they
    are whole sets up to SMALLEST shingles and leave five standard deviations beyond.
    """
    floor, j0 = agreement_floor(threshold), threshold / 100

    def pairs(rows):
        nodes, comps, block = (np.array([r[c] for r in rows]) for c in (4, 5, 3))
        sig = np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(-1, HASHES)
        bands = np.array([r[7] for r in rows])
        low = [np.frombuffer(r[8], np.uint32) for r in rows]
        key, i, j = rows[0][:3]
        for x in np.flatnonzero(block == i):
            at = np.flatnonzero((comps != comps[x]) & ((block == j) if i != j else (nodes > nodes[x])))
            if not len(at):
                continue
            at = at[(sig[at] == sig[x]).mean(axis=1) >= floor]
            at = at[bands[x][(bands[at] == bands[x]).argmax(axis=1)] == key]
            for y in at:
                s, n = similarity(low[x], low[y])
                if s >= j0 - (SLACK * (j0 * (1 - j0) / n) ** 0.5 if n else 0.002):
                    yield min(nodes[x], nodes[y]), max(nodes[x], nodes[y])

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array([p[c] for p in out], pa.int64()) for c in (0, 1)], names=["a", "b"])

    def run(batches):
        held, at, out = [], None, []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in range(9)]):
                if row[:3] != at:
                    if len(held) > 1:
                        out += pairs(held)
                    held, at = [], row[:3]
                held.append(row)
            if out:
                yield batch_of(out)
                out = []
        if len(held) > 1:
            out += pairs(held)
        yield batch_of(out)

    return run


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """Components of documents with 100 * intersection >= threshold * union of their k-word shingle sets.

    Words are split at space and \\t to \\r, A-Z in lower case. A text with fewer than k words is one shingle; a null
    text, or one without words, has none and is linked with nothing. Returns (doc_id, n_shingles, component_id,
    kept, th) for every row; component_id is the smallest doc_id reachable. Rows are linked by their texts alone, so
    rows that share a doc_id, or have none, stay apart unless their texts are similar. Of a component the
    rows with the smallest (doc_id, th) are kept, a row without shingles always. A null doc_id counts as the largest
    id and comes back as null. Other columns are ignored.

    A pair at the threshold shares no band with probability below 3e-7, so recall isn't exact but above 0.999999;
    every link is confirmed on the full sets.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "minhash")
    rows = docs.select(id_in().alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text"))
    sketch = saved(rows.mapInArrow(_sketcher(k), SKETCH), f"{path}/sketch")

    # classes of equal sets, numbered as they are written; the row with the smallest id stands for its class
    one = sketch.where("n > 0").groupBy("fp").agg(F.min(F.struct("id", "th", "sig", "bands")).alias("r"))
    classes = saved(one.select("fp", F.monotonically_increasing_id().alias("node"), F.col("r.id").alias("id"), F.col("r.th").alias("th"), F.col("r.sig").alias("sig"), F.col("r.bands").alias("bands")), f"{path}/classes")
    nodes = classes.select("node", "sig")

    # buckets with two classes or more
    slots = classes.select("node", F.explode("bands").alias("key"))
    shared = slots.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("low")).where("size > 1")
    slots = saved(slots.join(shared, "key").select("key", "node", "size", "low"), f"{path}/slots")

    # texts of the documents that any bucket proposes
    wanted = slots.select("node").distinct().join(classes.select("node", "id", "th"), "node")
    wanted = saved(wanted, f"{path}/wanted")
    texts = rows.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, ["id", "th"]).select("node", "text")
    texts = saved(texts.dropDuplicates(["node"]), f"{path}/texts")

    def confirmed(pairs: DataFrame, check: bool, name: str) -> DataFrame:
        p = pairs
        if check:
            p = p.join(nodes.toDF("a", "asig"), "a").join(nodes.toDF("b", "bsig"), "b")
            p = p.select("a", "b", "asig", "bsig").mapInArrow(_signatures_agree(threshold), "a long, b long")
        p = p.join(texts.toDF("a", "atext"), "a").join(texts.toDF("b", "btext"), "b")
        found = p.select("a", "b", "atext", "btext").sortWithinPartitions("a").mapInArrow(_confirm(k, threshold), "a long, b long")
        return saved(found, f"{path}/{name}")

    links = confirmed(slots.where("node > low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct(), True, "links0")
    comp = saved(components(links, f"{path}/cc0"), f"{path}/comp0")

    def still_open(comp: DataFrame, name: str) -> DataFrame:
        """Slots of buckets with classes of two components or more; pairs in buckets of two are already compared."""
        s = slots.where("size > 2").drop("low").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        parts = s.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("key")
        return saved(s.join(parts, "key"), f"{path}/{name}")

    left = still_open(comp, "open1")
    centre = left.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(1)).alias("h"), "node", "comp")).alias("c"))
    star = left.join(centre, "key").where("comp <> c.comp").select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")).distinct()
    more = confirmed(star, True, "links1")
    links = links.union(more)
    comp = saved(components(links, f"{path}/cc1"), f"{path}/comp1")

    left = still_open(comp, "open2")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(2)), blocks).cast("int")
    left = left.withColumn("blocks", blocks).withColumn("block", block)
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = left.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "comp")
    open_nodes = left.select("node").distinct().join(classes.select("node", "sig", "bands"), "node")
    low = open_nodes.join(texts, "node").select("node", "text").mapInArrow(_sketch_of(k), "node long, low binary")
    known = saved(open_nodes.select("node", "sig", "bands").join(low, "node"), f"{path}/known")
    left = left.join(known, "node").select("key", "i", "j", "block", "node", "comp", "sig", "bands", "low").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    rest = left.mapInArrow(_pairs_in_blocks(threshold), "a long, b long").distinct()
    links = links.union(confirmed(rest, False, "links2"))
    comp = saved(components(links, f"{path}/cc2"), f"{path}/comp2")

    # a component's first row by id and text stands for it; every row takes that of its class
    own = F.struct("id", "th")
    comp = comp.union(comp.select("comp", "comp").distinct())
    first = saved(comp.join(classes.select("node", "id", "th"), "node").groupBy("comp").agg(F.min(own).alias("first")), f"{path}/first")
    linked = comp.join(first, "comp").select("node", "first")
    by_class = classes.select("fp", "node", "id", "th").join(linked, "node", "left").select("fp", F.coalesce("first", own).alias("first"))
    got = sketch.select("id", "th", "n", "fp").join(by_class, "fp", "left").withColumn("first", F.coalesce("first", own))
    return got.select(id_out(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), id_out(F.col("first.id")).alias("component_id"), (own == F.col("first")).alias("kept"), "th")


def one_of_each(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the smallest doc_id (then hash of the text)."""
    found = near_duplicates(docs.select("doc_id", "text"), k, threshold).where("kept")
    return first_of_copies(docs, found.select(id_in().alias("id"), "th"))
