"""Spelling variants, line dedup and collocations: nulls, odd and empty tables, brute force on small ones."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import collocations, line_dedup, spelling

LANG = "doc_id long, text string, lang string"


def edits(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def variants(rows, min_chars=6, min_count=5):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "a" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    near = {w: [x for x in n if edits(w, x) == 1] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def words(r, letters, stems, k):
    """Words around few stems, with a letter more, less or another."""
    for _ in range(k):
        w = r.choice(stems)
        at, kind = r.randrange(len(w)), r.randrange(5)
        c = r.choice(letters)
        yield w if kind < 2 else w[:at] + (c if kind != 3 else "") + w[at + (kind != 4):]


@pytest.mark.parametrize("homes, guests", [(2048, 16384), (3, 4)])
def test_spelling_matches_brute_force(spark, make, monkeypatch, homes, guests):
    # slices of 3 and 4 words: every block is cut up; workers take the module's own sizes, which only slice reading
    monkeypatch.setattr(spelling, "HOMES", homes)
    monkeypatch.setattr(spelling, "GUESTS", guests)
    r = random.Random(homes)
    stems = ["abcabc", "cbacba", "straße", "ÉÀÿxyzw", "abababab", "x" * 40, "lettersofsomeword"] + ["".join(r.choices("abc", k=7)) for _ in range(5)]
    rows = [(i if i % 7 else None, " ".join([*words(r, "abcÿ", stems, 60), "Ab1abcabc,ABCABC"] + [stems[0]] * (40 * (i % 2)))) for i in range(60)]
    rows += [(900 + i, w) for i, w in enumerate(["chained"] * 6 + ["chainer"] * 31 + ["chainers"] * 160)]
    want = variants(rows)
    assert len(want) > 50 and any(f for _, f, *_ in want) and any(f and root != f for _, f, root, *_ in want)
    assert {tuple(x) for x in spelling.spelling_variants(make(rows)).collect()} == want


def test_spelling_of_odd_and_empty_tables(spark, make, odd):
    short = [x for x in odd if len(x[1] or "") < 1000] * 5
    assert {tuple(x) for x in spelling.spelling_variants(make(short)).collect()} == variants(short)
    long = [(i, "x" * (50_000 + i % 2)) for i in (8, 9, 8, 9, 8, 9, 8, 9, 8, 9)]
    got = spelling.spelling_variants(make(long)).collect()
    assert [(len(x.word), x.n, x.n_near, x.form) for x in sorted(got)] == [(50_000, 5, 1, None), (50_001, 5, 1, None)]
    assert spelling.spelling_variants(make([])).collect() == []


def test_letter_counts_and_one_edit():
    r = random.Random(3)
    said = ["".join(r.choices("abÿ", k=r.choice((3, 4)))) for _ in range(60)]
    for a in said:
        for b in said:
            if len(b) - len(a) in (0, 1):
                x, y = (np.frombuffer(w.encode("latin-1"), np.uint8)[None] for w in (a, b))
                assert spelling.one_edit(x, y)[0] == (edits(a, b) == 1), (a, b)
                d = spelling.letter_counts([a.encode("latin-1"), b.encode("latin-1")])
                assert edits(a, b) != 1 or ((d[0] - d[1]) ** 2).sum() <= 2


def kept_lines(rows, least=10):
    def key(x):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))

    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if seen[key(x)] < least]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def test_line_dedup_matches_brute_force(spark, make, odd):
    r = random.Random(5)
    said = ["", " ", "Ünï CÖDE", "ünï cöde", "one line", " ONE LINE\t", "tail\r", "tail", "\x0bx"] + [f"line {i}" for i in range(40)]
    rows = odd + [(r.choice([None, i, 3]), "\n".join(r.choices(said, k=r.randrange(9)))) for i in range(70)]
    rows += [(9, "same text\nin every row\nown")] * 30
    want = kept_lines(rows)
    assert sum(x[3] for x in want) > 50 and any(0 < x[3] < x[2] for x in want)
    got = line_dedup.drop_repeated_lines(make(rows))
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_line_dedup_of_a_very_long_text_and_an_empty_table(spark, make):
    long = "\n".join(f"w{i % 9000}" for i in range(200_000))
    rows = [(i, "\n".join(f"w{j}" for j in range(5000))) for i in range(10)] + [(99, long)]
    got = {x.doc_id: x for x in line_dedup.drop_repeated_lines(make(rows)).where("doc_id = 99").collect()}[99]
    assert (got.doc_id, got.text, got.n_lines, got.n_dropped) == next(x for x in kept_lines(rows) if x[0] == 99)
    assert line_dedup.drop_repeated_lines(make([])).collect() == []


def test_line_dedup_runs_no_python(spark, make):
    plan = line_dedup.drop_repeated_lines(make([(1, "a\nb")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_equal_partitions_match_counts():
    r = random.Random(1)
    for trial in range(200):
        v = r.choice([1, 2, 3, 8])
        t = np.array([r.randint(0, v) for _ in range(r.randint(0, 60))] + [0, 0, 0], np.int32)
        for least, weight in ((1, None), (3, None), (4, np.random.default_rng(trial).integers(1, 4, np.count_nonzero(t)))):
            p = np.flatnonzero(t).astype(np.int32)
            got = collocations.equal_partitions(t, p, 3, weight, least)
            for d in (1, 2, 3):
                want = Counter()
                for q, w in zip(p.tolist(), [1] * len(p) if weight is None else weight.tolist()):
                    if all(t[q : q + d]):
                        want[tuple(t[q : q + d].tolist())] += w
                assert sorted((tuple(t[q : q + d].tolist()), c) for q, c in zip(*(x.tolist() for x in got[d - 1]))) == sorted((k, n) for k, n in want.items() if n >= least)


def best_phrases(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split("[.,;:!?\n-\r]", t):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for d in (1, 2, 3):
                for i in range(len(w) - d + 1):
                    f[(lang, *w[i : i + d])] += 1
    found = []
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        if len(w) == 2 and any(c >= least and 100 * c >= 50 * a and len(p) == 4 and p[0] == lang and w in (list(p[1:3]), list(p[2:4])) for p, c in f.items()):
            continue
        score, k = min((1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        found.append((lang, -score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


def talk(r):
    stock = ["new york", "New York City", "of the", "the city of new york", "straße\tÄß", "a a a a", "red; herring", "x\ny", "İ ı", "b c d"]
    return " ".join(r.choices(stock + ["of", "the", "a", "city", "."], k=r.randrange(30)))


@pytest.mark.parametrize("bucket, top", [(4_000_000, 2000), (100, 3)])
def test_collocations_match_brute_force(spark, monkeypatch, bucket, top):
    monkeypatch.setattr(collocations, "BUCKET_BYTES", bucket)
    r = random.Random(11)
    rows = [(i, talk(r), r.choice(["en", "en", None, "und", "fr"])) for i in range(120)]
    rows += [(7, "cover me up", "fr")] * 15 + [(None, "me up", "fr")] * 12 + [(1, None, None), (2, "", "en"), (3, " \t.\n", "xx"), (4, "long " * 30_000, "en")]
    want = best_phrases(rows, top=top)
    assert len(want) >= 8
    got = collocations.collocations(spark.createDataFrame(rows, LANG).selectExpr("*", "'x' as h", "1 as kind", "2 as f"), top=top)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_collocations_of_an_empty_table(spark):
    got = collocations.collocations(spark.createDataFrame([], LANG))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.collect() == []


def in_one_batch(rows, names):
    return [pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in rows])]


def rows_of(batches):
    return [tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows)]


def filter_of(counts, every):
    """A filter that lets all phrases pass, or those with 10 occurrences."""
    bits = np.full(1024, 255 if every else 0, np.uint8)
    for k, _, _, _, route, _ in counts:
        if k > 0:
            bits[route % 8192 // 8] |= 1 << route % 8
    return bits.tobytes()


def test_a_bucket_tells_of_two_words_with_one_hash():
    seed = 2
    rows = [(0, b"en", b"one\ntwo", np.array([5, 5]).tobytes(), bytes([20, 30]))]
    out = rows_of(collocations._of_buckets(collocations._count_words(10, seed))(in_one_batch(rows, ("bucket", "lang", "words", "hashes", "counts"))))
    assert -1 in [x[0] for x in out]


@pytest.mark.parametrize("every, seed", [(True, 0), (False, 1), (False, 5)])
@pytest.mark.parametrize("block, chunk, buckets", [(1 << 21, 1 << 20, 1), (50, 20, 7)])
def test_blocks_and_chunks_lose_no_phrase(monkeypatch, block, chunk, buckets, every, seed):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    r = random.Random(block)
    rows = [(i, talk(r), "en") for i in range(80)] + [(99, "of the a b c d. " * 50, "en"), (100, "common " * 700, "en")]
    texts = [pa.RecordBatch.from_pydict({"lang": [x.encode() for _, _, x in rows[i : i + 9]], "text": [t.encode() for _, t, _ in rows[i : i + 9]]}) for i in range(0, len(rows), 9)]
    routed = sorted(rows_of(collocations._route_words(buckets, seed)(texts)))
    counts = rows_of(collocations._of_buckets(collocations._count_words(10, seed))(in_one_batch(routed, ("bucket", "lang", "words", "hashes", "counts"))))
    names = {h[0]: w.decode() for k, _, w, h, _, _ in counts if k == 1}
    kept = words_kept = filter_of(counts, every)
    for d in (2, 3):
        routed = sorted(rows_of(collocations._route_phrases(d, buckets, seed, words_kept, kept)(texts)))
        found = rows_of(collocations._of_buckets(collocations._count_phrases(d, 10, seed))(in_one_batch(routed, ("bucket", "hashes", "ids", "counts"))))
        kept = filter_of(found, every)
        counts += found
    got = sorted((" ".join(names[x] for x in h), f) for k, _, _, h, _, f in counts if k > 0)
    want = Counter()
    for _, t, _ in rows:
        for piece in re.split("[.,;:!?\n-\r]", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            want.update(" ".join(w[i : i + d]) for d in (1, 2, 3) for i in range(len(w) - d + 1))
    assert got == sorted((p, n) for p, n in want.items() if n >= 10)
