import random

import numpy as np
import pytest
from test_text import base_spans

import corpus_pipeline
from tidemart.llm import minhash, quality
from tidemart.llm.bpe import word_bpe
from tidemart.llm.queries import ORACLE, QUERIES
from tidemart.testing import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) == []


def test_pipeline_by_stages(spark, make, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4]
    packed = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert packed == {r.doc_id for r in docs.collect()}


def test_stages_take_odd_and_empty_tables(spark, make, odd):
    for rows in (odd, []):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, make(rows), SF).count() >= 0, name


def corpus():
    """Clean documents, white-space copies, near copies, documents with personal data, short and repeating ones, null and repeated ids."""
    r = random.Random(17)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrst"]
    clean = [" ".join(r.choices(words, k=80 + i)) for i in range(16)]
    edited = [t.split() for t in clean[:5]]
    for w in edited:
        w[40] = "changed"
    rows = list(enumerate(clean)) + [(100 + i, t.replace(" ", "  ", 3)) for i, t in enumerate(clean[3:6])] + [(200 + i, " ".join(w)) for i, w in enumerate(edited)]
    rows += [(300, clean[7] + " mail a.b@c.org from 10.1.2.3"), (301, " ".join(r.choices(words, k=90)) + " call +1 (988) 555-2485 or 4111 1111 1111 1111.")]
    rows += [(400, "too short"), (401, "one two three four five six seven eight nine ten " * 9), (402, None), (403, "")]
    rows += [(None, " ".join(r.choices(words, k=n))) for n in (97, 103, 109)] + [(500, " ".join(r.choices(words, k=n))) for n in (98, 104)] + [(None, clean[9] + " tail")]
    r.shuffle(rows)
    return rows


def expected(rows):
    """What the stages leave by plain Python: base rules, normalised equality, all pairs, plain expressions."""
    def order(row):
        return row[0] is None, row[0] or 0

    def passes(t):
        w = (t or "").split()
        windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        inside = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(8)}
        return len(w) >= quality.MIN_WORDS and 100 * len(inside) <= quality.MAX_REPEAT_PERCENT * len(w)

    groups = {}
    for row in (x for x in rows if passes(x[1])):
        groups.setdefault("".join(row[1].split()), []).append(row)
    left = sorted((min(g, key=lambda x: (-len(x[1]), order(x))) for g in groups.values()), key=order)
    sets, comp = [minhash.shingle_set(t.encode(), 5) for _, t in left], list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp = [comp[j] if c == comp[i] else c for c in comp] if comp[j] < comp[i] else [comp[i] if c == comp[j] else c for c in comp]
    out = []
    for i, t in (left[n] for n, c in enumerate(comp) if n == c):
        for kind, a, b in reversed([s.split(":") for s in base_spans(t).split(",") if s]):
            t = t[:int(a)] + f"[{kind.upper()}]" + t[int(b):]
        out.append((i, t))
    return out


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    # without labels there is no classifier: the base rules decide alone
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    pieces = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    got = {k: [i for _, ids in sorted(p) for i in ids] for k, p in pieces.items()}
    bpe, want = word_bpe("word_bpe_49k.json"), {}
    for i, t in expected(rows):
        ids = [*np.frombuffer(bpe.encode(t), "<u2").tolist(), 2]
        want[i, len(ids)] = ids
    assert len(want) == len(expected(rows)) and got == want
