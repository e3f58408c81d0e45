import hashlib
import random

from pyspark.sql import functions as F

from tidemart.llm import exact_dedup as X
from tidemart.llm import minhash as M

WORDS = [f"w{i}" for i in range(400)]


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), 1 << 63 if i is None else i))
    return {k: (len(v), min(v)[1]) for k, v in groups.items()}


def test_exact_matches_brute_force(make, odd):
    want = brute_exact(odd)
    got = X.exact_duplicates(make(odd), bucket_bytes=1000).collect()
    assert len(got) == len(odd)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        n, keep = by_sha[r.text_sha256]
        assert r.group_size == n and (1 << 63 if r.keep_id is None else r.keep_id) == keep
        assert r.kept == (r.doc_id == r.keep_id)


def test_directory_splits_only_large_buckets(make):
    docs = make([f"{i} " + "x" * (i % 50) for i in range(500)])
    members, groups = X.build_index(docs, bucket_bytes=600)
    assert groups.select("bucket").distinct().count() > 10
    assert groups.count() == 500 and members.count() == 500
    # a group of copies can't be split and stays one bucket
    members, groups = X.build_index(make(["same text"] * 300), bucket_bytes=5)
    assert groups.count() == 1 and groups.first().group_size == 300


def test_without_copies_keeps_one_row_each(make, odd):
    got = X.without_copies(make(odd)).collect()
    assert len(got) == len(brute_exact(odd))
    assert "key" in got[0].asDict() and X.without_copies(make([])).count() == 0


def near_truth(rows, k):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, set()).update(M.shingle_set((t or "").encode(), k))
    ids = sorted(sets)
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = root(a), root(b)
                comp[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def copies(seed, families=12, size=25, words=60):
    """Chains of edits: far members of a family are similar only by way of others."""
    r = random.Random(seed)
    rows = []
    for _ in range(families):
        text = r.choices(WORDS, k=words)
        for _ in range(size):
            rows.append((len(rows), " ".join(text)))
            if r.random() < 0.8:
                text = list(text)
                text[r.randrange(words)] = r.choice(WORDS)
    return rows


def test_near_duplicates_match_brute_force(make):
    for k in (2, 5):
        rows = copies(k) + [(1000, None), (1001, ""), (1002, "One"), (1003, "one\t"), (1004, "a b c d e"), (1005, "a b c d")]
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_duplicates(make(rows), k=k).collect()}
        assert got == near_truth(rows, k)


def test_near_duplicates_odd_rows(make, odd):
    got = M.near_duplicates(make(odd), k=2).collect()
    assert len(got) == len(odd)
    ids = {r.doc_id: r for r in got}
    assert ids[0].n_shingles == 0 and ids[0].kept and ids[7].component_id == 5 and ids[None].kept
    assert M.one_of_each(make(odd), k=2).count() == 8
    assert M.near_duplicates(make([])).count() == 0


def test_null_and_repeated_ids_stay_apart(make):
    r = random.Random(3)
    clean = [" ".join(r.choices(WORDS, k=60)) for _ in range(9)]
    near = [t + " tail" for t in clean]
    rows = [(1, clean[0]), (None, near[0]), (None, clean[1]), (None, clean[2]), (None, near[2]), (None, clean[2]),
            (2, clean[3]), (9, near[3]), (9, clean[4]), (9, clean[5]), (9, near[5]), (None, near[5]), (None, None), (None, "")]
    got = {(x.doc_id, x.th): (x.component_id, x.kept) for x in M.near_duplicates(make(rows), k=5).collect()}
    assert sorted(map(str, got.values())) == sorted(map(str, [
        (1, True), (1, False), (None, True), (None, True), (None, False), (2, True), (2, False), (9, True), (9, True), (9, False), (9, False), (None, True), (None, True)]))
    stay = [x.text for x in M.one_of_each(make(rows), k=5).collect()]
    groups = [{clean[0]}, {clean[1]}, {clean[2], near[2]}, {clean[3]}, {clean[4]}, {clean[5], near[5]}, {None}, {""}]
    assert len(stay) == len(groups) and all(sum(t in g for t in stay) == 1 for g in groups)


def test_components_of_a_long_chain(spark):
    from tidemart.llm.common import work_dir
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    comp = M.components(links, work_dir(spark, "chain"))
    assert comp.count() == 200 and comp.where("comp <> 0").count() == 0
