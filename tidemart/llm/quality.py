"""Quality rules: hashed word and character n-gram logistic regression, calibrated, against fixed thresholds.

A text's features are the shares of its hashed word 1- and 2-grams and character 3- and 4-grams, so its logit is a
mean of weights: no vocabulary, and no work beyond one pass over the text. Training reads a bounded sample of the
labelled rows (``SAMPLE_ROWS``, chosen by the hash of doc_id); a fifth of it calibrates the logit (Platt scaling).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import release_encoders
from .minhash import mixed

BITS = 16
SAMPLE_ROWS = 2_000
#: A text with a calibrated probability of good quality under this is rejected.
KEEP_PROBABILITY = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

FEATURES = 4
EPOCHS, RATE, DECAY = 80, 0.5, 1e-5
#: Rows whose features are held as float64 at a time while the model is fitted.
BLOCK_ROWS = 100
#: Weight of the pull of the calibration to the logit itself, so that a fifth that is fully separated has an optimum.
PULL = 1.0
#: Shares are small numbers: they are scaled so that weights stay near one.
SCALE = 20.0

SCORES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def feature_buckets(text: str, words: list[bytes]) -> list[np.ndarray]:
    """Buckets of the word 1-, 2-grams and character 3-, 4-grams, one array for each kind, with repeats."""
    import xxhash

    out = []
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out.append(h)
    out.append(mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]))
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    c = c * np.uint64(0xD6E8FEB86659FD93)
    for n in (3, 4):
        k = max(0, len(c) - n + 1)
        x = np.full(k, n, np.uint64)
        for j in range(n):
            x = (x ^ c[j : j + k]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        out.append(x)
    return [(x >> np.uint64(64 - BITS)).astype(np.int32) for x in out]


@dataclass
class Model:
    weights: np.ndarray  # a row for each kind of feature
    bias: float
    slope: float
    shift: float

    def logit(self, buckets: list[np.ndarray]) -> float:
        return self.bias + SCALE * sum(float(w[b].mean()) for w, b in zip(self.weights, buckets) if len(b))

    def probability(self, buckets: list[np.ndarray]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.logit(buckets) + self.shift, -30, 30))))


def _sparse(batches):
    """(y, part, kind, bucket, share) arrays of a row, for training."""
    for batch in batches:
        flat, share = [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            idx, val = [], []
            for kind, b in enumerate(feature_buckets(text, text.encode("utf-8", "surrogatepass").split())):
                u, n = np.unique(b, return_counts=True)
                idx.append(u.astype(np.int32) + (kind << BITS))
                val.append((n / max(1, len(b))).astype(np.float32))
            flat.append(np.concatenate(idx).tobytes())
            share.append(np.concatenate(val).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flat, pa.binary()), pa.array(share, pa.binary()), batch.column(2)], names=["y", "idx", "val", "h"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model from at most ``sample_rows`` labelled rows; None without rows of both classes."""
    chosen = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
    chosen = chosen.groupBy("id").agg(F.min("y").alias("y")).withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(sample_rows)
    sample = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id").select("y", "text", "h")
    # a doc_id that repeats in the documents counts once
    sample = sample.groupBy("h").agg(F.min(F.struct("text", "y")).alias("r")).select("r.y", "r.text", "h")
    rows = sample.mapInArrow(_sparse, "y int, idx binary, val binary, h long").toArrow()
    order = np.argsort(rows["h"].to_numpy())
    y = rows["y"].to_numpy().astype(np.float64)[order]
    if len(set(y)) < 2:
        return None
    # views of the table's buffers, not copies
    idx, val = ([np.frombuffer(x.as_buffer(), kind) for x in rows[name]] for name, kind in (("idx", np.int32), ("val", np.float32)))
    idx, val = [idx[i] for i in order], [val[i] for i in order]
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held[:] = False

    def logits(at):
        """Logits of a few rows, the row of each of their features, the features and their values."""
        row = np.repeat(np.arange(len(at)), [len(idx[i]) for i in at])
        col, x = np.concatenate([idx[i] for i in at]), np.concatenate([val[i] for i in at]) * SCALE
        return bias + np.bincount(row, x * w[col], len(at)), row, col, x

    def blocks(which):
        at = np.flatnonzero(which)
        return [at[i : i + BLOCK_ROWS] for i in range(0, len(at), BLOCK_ROWS)]

    # classes weigh the same; Adagrad on the full sample, whose features are widened a block of rows at a time
    t = y[~held]
    each = np.where(y == 1, 0.5 / (t == 1).mean(), 0.5 / (t == 0).mean())
    w, g2, bias, b2 = np.zeros(FEATURES << BITS), np.full(FEATURES << BITS, 1e-8), 0.0, 1e-8
    for _ in range(EPOCHS):
        g, es = np.zeros(len(w)), []
        for at in blocks(~held):
            z, row, col, x = logits(at)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) * each[at] / len(t)
            np.add.at(g, col, x * e[row])
            es.append(e)
        g += DECAY * w
        g2 += g * g
        w -= RATE * g / np.sqrt(g2)
        gb = np.concatenate(es).sum()
        b2 += gb * gb
        bias -= RATE * gb / np.sqrt(b2)
    slope, shift = 1.0, 0.0
    if held.any():
        t = y[held]
        z = np.concatenate([logits(at)[0] for at in blocks(held)])
        # Platt scaling with smoothed targets and a weak pull to (1, 0), by damped Newton steps
        good, bad = (t == 1).sum(), (t == 0).sum()
        target = np.where(t == 1, (good + 1) / (good + 2), 1 / (bad + 2))
        m = np.stack([z, np.ones_like(z)], 1)
        ab = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(m @ ab, -30, 30)))
            grad = m.T @ (p - target) + PULL * (ab - [1, 0])
            step = np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + PULL * np.eye(2), grad)
            ab -= step * min(1, 1 / max(1e-9, np.abs(step).max()))
        slope, shift = ab
    return Model(w.reshape(FEATURES, -1).astype(np.float32), float(bias), float(slope), float(shift))


def repeat_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur twice or more, every occurrence included.

    Windows are found by 64-bit hashes; a text in which any are equal is counted again on the words themselves.
    """
    import xxhash

    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    x = np.zeros(n, np.uint64)
    for j in range(window):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    s = np.sort(x)
    if not (s[1:] == s[:-1]).any():
        return 0
    seen: dict[tuple, int] = {}
    which = [seen.setdefault(tuple(words[i : i + window]), i) for i in range(n)]
    many = np.bincount(which, minlength=n)[which] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(many), 1)
    np.add.at(edge, np.flatnonzero(many) + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measures(raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    chars = sum(map(len, words)) if raw.isascii() else len(b"".join(words).decode("utf-8", "surrogatepass"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def quality(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, sample_rows: int = SAMPLE_ROWS, keep_probability: float = KEEP_PROBABILITY) -> DataFrame:
    """The rows of ``docs`` with their columns ``carry`` (all if None) and a struct ``_quality`` of SCORES.

    A null or empty text has zeros and base_failed. Without labelled rows of both classes there is no model:
    probability is null and the base rules decide alone. Repeated rows repeat; an empty table gives no rows.
    """
    model = fit(docs, labels, sample_rows)
    names = [c.split()[0] for c in SCORES.split(", ")]
    carry = docs.columns if carry is None else carry

    def run(batches):
        release_encoders()
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            rows = []
            for text in (batch.column("_text") if "_text" in batch.schema.names else batch.column("_row").field("text")).to_pylist():
                text = text or ""
                raw = text.encode("utf-8", "surrogatepass")
                words = raw.split()
                m = measures(raw, words)
                failed = m[0] < MIN_WORDS or 100 * m[4] > MAX_REPEAT_PERCENT * m[0]
                p = model.probability(feature_buckets(text, words)) if model else None
                rows.append((*m, failed, p, not failed and (p is None or p >= keep_probability)))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            scores = pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(8)], names=names)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), scores], names=["_row", "_quality"])

    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"), *[F.col("text").alias("_text")] * ("text" not in carry))
    kind = held.schema["_row"].dataType.simpleString()
    scores = ",".join(c.replace(" ", ":") for c in SCORES.split(", "))
    return held.mapInArrow(run, f"_row {kind}, _quality struct<{scores}>").select("_row.*", "_quality")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return quality(docs, labels).where("_quality.kept").drop("_quality")
