import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def make(spark):
    """Documents of texts (or (doc_id, text) pairs), with clashing further columns."""
    def build(texts, extra=True):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], DOCS)
        if extra:
            from pyspark.sql import functions as F
            for c in ("key", "id", "th", "bucket", "sha", "comp", "shard", "h", "kept", "_spans2"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return build


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty, spaces, very long, ties and repeated rows."""
    long = " ".join(WORDS[i % 20] + str(i) for i in range(30_000))
    return [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, long), (5, "Some words\nin two lines, at 5."), (5, "Some words\nin two lines, at 5."), (None, "no id at all"), (7, "Some  words in two lines, at 5."), (8, "x" * 50_000)]
