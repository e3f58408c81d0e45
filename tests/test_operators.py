"""Hand-made edge cases for the keyed-state, join and dimension operators."""

import random

from pyspark.sql import functions as F

from tidemart.operators import dedup as dd
from tidemart.operators import dims as D
from tidemart.operators.joins import interval_join
from tidemart.plans import dws, labels
from tidemart.operators.logs import LOG_SCHEMA  # noqa: F401  (schema import check)

DAY = 86_400_000


def test_retraction_sums_to_latest(spark):
    rows = [("A", "o1", "10.00", 1, "s1"), ("A", "o1", "12.00", 1, "s2"), ("A", "o1", "15.50", 1, "s3"),
            ("B", "o2", "7.00", 2, "s1")]
    df = spark.createDataFrame(rows, "id string, order_id string, amt string, ts_ms long, seq string")
    out = dd.retract_versions(df, "id", "seq", ["amt"])
    assert out.count() == 6
    total = out.agg(F.sum(F.col("amt").cast("decimal(10,2)"))).first()[0]
    assert str(total) == "22.50"
    negs = sorted(r["amt"] for r in out.where("_retract").collect())
    assert negs == ["-10.00", "-12.00"]


def test_strictly_newer_and_latest_tie(spark):
    rows = [("k", 5, "01"), ("k", 3, "02"), ("k", 7, "03"), ("k", 7, "04"), ("k", 9, "05"), ("j", 1, "01")]
    df = spark.createDataFrame(rows, "key string, ts long, seq string")
    passed = sorted((r["key"], r["seq"]) for r in dd.strictly_newer(df, "key", "ts", "seq").collect())
    assert passed == [("j", "01"), ("k", "01"), ("k", "03"), ("k", "05")]
    tie = spark.createDataFrame([("k", 7, "03"), ("k", 7, "04"), ("k", 6, "05")], "key string, ts long, seq string")
    assert dd.dedup_latest(tie, "key", "ts", "seq").first()["seq"] == "04"


def test_strictly_newer_chunked_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice("aab"), rnd.randint(0, 50), f"{i:06d}") for i in range(400)]
    df = spark.createDataFrame(rows, "key string, ts long, seq string")
    want = []
    best: dict = {}
    for k, t, s in sorted(rows, key=lambda r: r[2]):
        if k not in best or t > best[k]:
            want.append((k, s))
            best[k] = t
    got = dd.strictly_newer(df, "key", "ts", "seq", chunk=F.substring("seq", 1, 4))
    assert sorted((r["key"], r["seq"]) for r in got.collect()) == sorted(want)
    plain = dd.strictly_newer(df, "key", "ts", "seq")
    assert sorted((r["key"], r["seq"]) for r in plain.collect()) == sorted(want)


def test_first_of_day_and_exact(spark):
    rows = [("u", 1000, "a"), ("u", 2000, "b"), ("u", DAY + 5, "c"), ("v", 3000, "d"), ("v", 3000, "d")]
    df = spark.createDataFrame(rows, "user string, ts long, id string")
    firsts = dd.first_of_day(df, "user", F.floor(F.col("ts") / DAY), ["ts", "id"])
    assert sorted(r["id"] for r in firsts.collect()) == ["a", "c", "d"]
    assert dd.dedup_exact(df).count() == 4


def _brute_interval(left, right, lo, hi):
    return sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] + lo <= b[2] <= a[2] + hi)


def test_interval_join_bounds_and_brute_force(spark):
    left = [("L1", "k", 1_000_000)]
    right = [("R1", "k", 1_000_000 - 120_000), ("R2", "k", 1_000_000 + 120_000), ("R3", "k", 1_000_000 + 120_001),
             ("R4", "x", 1_000_000)]
    l = spark.createDataFrame(left, "lid string, lk string, lts long")
    r = spark.createDataFrame(right, "rid string, rk string, rts long")
    got = sorted((x["lid"], x["rid"]) for x in interval_join(l, r, "lk", "rk", "lts", "rts", -120_000, 120_000).collect())
    assert got == [("L1", "R1"), ("L1", "R2")]
    # a hot key spread over many buckets, asymmetric bounds
    rnd = random.Random(7)
    left = [(f"l{i}", rnd.choice("aab"), rnd.randint(0, 50_000)) for i in range(300)]
    right = [(f"r{i}", rnd.choice("aabc"), rnd.randint(0, 50_000)) for i in range(300)]
    l = spark.createDataFrame(left, "lid string, lk string, lts long")
    r = spark.createDataFrame(right, "rid string, rk string, rts long")
    got = sorted((x["lid"], x["rid"]) for x in interval_join(l, r, "lk", "rk", "lts", "rts", -700, 300).collect())
    assert got == _brute_interval(left, right, -700, 300)


def test_upsert_merge_delete_and_recreate(spark):
    rows = [  # sink_table, sink_row_key, op, seq, data
        ("t", "id", "r", "1", {"id": "1", "name": "a", "nation": "7"}),
        ("t", "id", "u", "2", {"id": "1", "name": "A", "nation": ""}),
        ("t", "id", "r", "1", {"id": "2", "name": "b", "nation": "8"}),
        ("t", "id", "d", "3", {"id": "2", "name": "b", "nation": "8"}),
        ("t", "id", "c", "4", {"id": "2", "name": "b2", "nation": ""}),
        ("t", "id", "r", "1", {"id": "3", "name": "c", "nation": "9"}),
        ("t", "id", "d", "2", {"id": "3", "name": "c", "nation": "9"}),
    ]
    df = spark.createDataFrame(rows, "sink_table string, sink_row_key string, op string, seq string, "
                                     "data map<string,string>")
    got = {r["row_key"]: dict(r["data"]) for r in D.upsert_merge_map(df).collect()}
    assert got == {"1": {"id": "1", "name": "A", "nation": "7"}, "2": {"id": "2", "name": "b2"}}
    cols = {r["row_key"]: (r["name"], r["nation"]) for r in D.upsert_merge(df, ["name", "nation"]).collect()}
    assert cols == {"1": ("A", "7"), "2": ("b2", None)}


def test_latest_config_drops_deleted(spark):
    rows = [("a", "x", "r", "1"), ("a", "y", "u", "2"), ("b", "z", "r", "1"), ("b", "z", "d", "2")]
    cfg = spark.createDataFrame(rows, "source_table string, sink_table string, op string, seq string")
    assert [(r["source_table"], r["sink_table"]) for r in D.latest_config(cfg).collect()] == [("a", "y")]


def _log(spark, rows):
    schema = ("offset long, common struct<mid:string,uid:string,vc:string,ch:string,ar:string,is_new:string,"
              "os:string,md:string,ba:string,sid:string>, page struct<page_id:string,last_page_id:string,item:string,"
              "item_type:string,during_time:bigint>, ts long")
    data = [(o, (mid, uid, "v1", "web", "1", isn, "iOS 17", "m", "b", "s"), (pid, last, None, None, 10), ts)
            for o, mid, uid, isn, pid, last, ts in rows]
    return spark.createDataFrame(data, schema)


def test_is_new_repair(spark):
    from tidemart.operators.logs import repair_is_new
    rows = [(1, "m1", "u", "1", "home", None, 1000), (2, "m1", "u", "1", "home", None, 2000),
            (3, "m1", "u", "1", "home", None, DAY + 10), (4, "m2", "u", "0", "home", None, 1000),
            (5, "m2", "u", "1", "home", None, 5000)]
    got = {r["offset"]: r["common"]["is_new"] for r in repair_is_new(_log(spark, rows)).collect()}
    assert got == {1: "1", 2: "1", 3: "0", 4: "0", 5: "0"}


def test_login_back_after_eight_days(spark):
    rows = [(1, "m", "u1", "0", "home", "login", 0), (2, "m", "u1", "0", "home", "login", 7 * DAY + 1),
            (3, "m", "u2", "0", "home", "login", 0), (4, "m", "u2", "0", "home", None, 8 * DAY + 1),
            (5, "m", "u2", "0", "home", "login", 8 * DAY + 2)]
    out = dws.user_login(_log(spark, rows), "1 day")
    got = {r["cur_date"]: (r["back_ct"], r["uu_ct"]) for r in out.collect()}
    assert got == {"1970-01-01": (0, 2), "1970-01-08": (0, 1), "1970-01-09": (1, 1)}


def test_running_profile_matches_brute_force(spark):
    rnd = random.Random(3)
    recs = []
    for i in range(200):
        uid = rnd.choice(["a", "b", "c"])
        recs.append((uid, 1000 + i * 37, rnd.choice(["iOS", "Android"]), rnd.choice(["web", "app"]),
                     rnd.choice([None, "w1", "w2", "w3"])))
    df = spark.createDataFrame(recs, "uid string, ts long, os string, ch string, search_item string").select(
        "uid", "ts", F.struct("os", "ch", F.lit("m").alias("md"), F.lit("b").alias("ba")).alias("deviceInfo"),
        "search_item")
    out = {(r["uid"], r["ts_ms"]): r for r in labels.running_profile(df, 1).collect()}
    seen: dict = {}
    for uid, ts, os_, ch, si in sorted(recs, key=lambda x: (x[0], x[1])):
        st = seen.setdefault(uid, {"pv": 0, "os": set(), "ch": set(), "si": set()})
        st["pv"] += 1
        st["os"].add(os_)
        st["ch"].add(ch)
        if si:
            st["si"].add(si)
        r = out[(uid, ts)]
        assert r["pv"] == st["pv"]
        assert r["os"] == ",".join(sorted(st["os"]))
        assert r["ch"] == ",".join(sorted(st["ch"]))
        assert r["search_item"] == ",".join(sorted(st["si"]))


def test_topic_frame_routes_by_column(spark):
    from tidemart.streaming.runners import topic_frame
    df = spark.createDataFrame([("t1", 1, None), ("t2", 2, "x")], "topic string, a int, b string")
    assert {tuple(r) for r in topic_frame(df, ["a"]).collect()} == {("t1", '{"a":1}', '{"a":1}'), ("t2", '{"a":2}', '{"a":2,"b":"x"}')}


def test_interval_join_refuses_right(spark):
    import pytest
    from tidemart.operators.joins import interval_join
    left = spark.createDataFrame([("a", 5)], "k string, t long")
    right = spark.createDataFrame([("a", 5)], "k2 string, t2 long")
    with pytest.raises(ValueError):
        interval_join(left, right, "k", "k2", "t", "t2", -2, 2, how="right")


def test_fix_is_new_keeps_records_without_mid(spark):
    from pyspark.sql import functions as F
    from tidemart.operators.dedup import fix_is_new
    df = spark.createDataFrame([("m", 1, 1, "1"), (None, 2, 2, "1"), (None, 3, 3, "0")], "mid string, ts long, o long, n string")
    out = fix_is_new(df, F.col("mid"), "ts", "o", F.col("n"), F.lit("d1"), F.lit("d0")).collect()
    assert sorted(r.ts for r in out) == [1, 2, 3]


def test_strictly_newer_with_long_offsets_and_null_keys(spark):
    from tidemart.operators.dedup import arrival_chunk, strictly_newer
    rows = [(k, ts, str(o).zfill(20)) for k in ("a", None) for ts, o in ((5, 1), (4, 1_000_001), (7, 2_000_001), (7, 2_000_002), (9, 3_000_000))]
    df = spark.createDataFrame(rows, "k string, ts long, seq string")
    assert df.select(arrival_chunk("seq")).distinct().count() == 4
    a = strictly_newer(df, "k", "ts", "seq", chunk=arrival_chunk("seq")).collect()
    b = strictly_newer(df, "k", "ts", "seq").collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str) and len(a) == 6


def test_running_profile_keeps_records_of_one_millisecond(spark):
    """Records of one uid at equal times each get a row, in arrival order, across and inside the time chunks; a third
    of all rows may share a uid."""
    h = 3_600_000
    recs = [("u", 5, 2, "b"), ("u", 5, 1, "a"), ("u", 5, 3, None), ("u", h + 1, 4, "a"), ("u", 3 * h, 5, "c,d"),
            ("v", 5, 6, "z")]
    df = spark.createDataFrame(recs, "uid string, ts long, offset long, search_item string").withColumn(
        "deviceInfo", F.struct(*[F.lit("x").alias(c) for c in ("os", "ch", "md", "ba")]))
    got = labels.running_profile_records(df, "1 hour")
    assert sorted((r.uid, r.ts_ms, r.pv, r.search_item, r.os) for r in got.collect()) == [
        ("u", 5, 1, "a", "x"), ("u", 5, 2, "a,b", "x"), ("u", 5, 3, "a,b", "x"), ("u", h + 1, 4, "a,b", "x"),
        ("u", 3 * h, 5, "a,b,c,d", "x"), ("v", 5, 1, "z", "x")]


def test_running_profile_hot_uid_is_split_by_time(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "-1").otherwise(F.col("id").cast("string")).alias("uid"),
        (F.col("id") * 60_000).alias("ts"), F.col("id").alias("offset"), F.lit("w").alias("search_item"),
        F.struct(*[F.lit("x").alias(c) for c in ("os", "ch", "md", "ba")]).alias("deviceInfo"))
    hot = labels.running_profile_records(df).where("uid = '-1'")
    assert sorted(r.pv for r in hot.collect()) == list(range(1, 101))


# ---------------------------------------------------------------- dictionary segmentation (U1), word list (S8), J12

def _longest_match(text, words):
    import re
    known = {w.lower() for w in words if len(w) > 1}
    longest = max(map(len, known), default=1)
    out = []
    for piece in re.findall(r"[一-鿿]+|[a-z]+|[0-9]+", text.lower()):
        if not "一" <= piece[0] <= "鿿":
            out.append(piece)
            continue
        at = 0
        while at < len(piece):
            n = max((k for k in range(2, longest + 1) if at + k <= len(piece) and piece[at:at + k] in known), default=1)
            out.append(piece[at:at + n])
            at += n
    return out


def test_dictionary_segmentation_matches_brute_force(spark):
    import random

    from tidemart.operators import text as tx
    r = random.Random(2)
    han = "小米手机京东自营移动联通电信"
    words = ["小米", "手机", "小米手", "京东自营", "自营", "移动", "联通", "电信", "移动联通", "米", "5G", "东自营移"] + ["".join(r.choices(han, k=r.randint(2, 4))) for _ in range(40)]
    texts = ["小米手机京东自营5G移动联通电信", "", None, "no han 12", "机" * 300] + ["".join(r.choices(han + " aB1,", k=r.randint(1, 40))) for _ in range(150)]
    texts += ["小米手机"] * 30
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], "id int, t string, run string, word int")
    got = {}
    for row in tx.explode_segments(df, "t", spark.createDataFrame([(w,) for w in words], "word string")).orderBy("id", "pos").collect():
        got.setdefault(row.id, []).append(row.keyword)
    assert got == {i: _longest_match(t, words) for i, t in enumerate(texts) if t and _longest_match(t, words)}
    empty = spark.createDataFrame([], "word string")
    assert [x.keyword for x in tx.explode_segments(df.where("id = 30"), "t", empty).orderBy("pos").collect()] == _longest_match(texts[30], [])
    assert tx.explode_segments(df.limit(0), "t", empty).count() == 0


def test_word_list_file_hits_misses_and_reload(spark, tmp_path):
    from tidemart.operators import text as tx
    path = f"{tmp_path}/words"
    spark.createDataFrame([("bad",), (" spaced",), ("",), ("bad",)], "value string").coalesce(1).write.text(path)
    said = spark.createDataFrame([("fine,bad",), ("bad,fine",), ("a, spaced",), ("a,spaced",), ("bad,,",), (None,), ("",)], "t string")

    def hits():
        return [r.is_violation for r in tx.flag_last_word(said.coalesce(1).withColumn("i", F.monotonically_increasing_id()), "t", tx.word_list(spark, path)).orderBy("i").collect()]
    assert hits() == [1, 0, 1, 0, 1, 0, 0]
    spark.createDataFrame([("spaced",)], "value string").coalesce(1).write.mode("append").text(path)
    assert hits() == [1, 0, 1, 1, 1, 0, 0]


def test_lookup_of_a_dimension_with_duplicate_keys(spark):
    """List scans take the first match, map loads the last; no row is multiplied."""
    from tidemart.operators import dims as D
    dim = spark.createDataFrame([("a", "one", 1), ("a", "two", 2), ("b", "three", 3), (None, "none", 4)], "k string, v string, loaded int")
    for keep, want in (("first", "one"), ("last", "two")):
        one = D.dedup_dim(dim, "k", keep, ["loaded"])
        assert sorted((r.k or "", r.v) for r in one.collect()) == [("", "none"), ("a", want), ("b", "three")]
        rows = spark.createDataFrame([("a",)] * 5 + [("z",), (None,)], "key string")
        out = D.enrich(rows, one, "key", "k", {"v": "v"}).collect()
        assert len(out) == 7 and sorted(r.v or "" for r in out) == ["", ""] + [want] * 5


def test_label_lookups_multiply_no_row(spark):
    from tidemart.plans import labels as lb
    from tidemart.queries import _dims, _topic, _tree
    from tidemart.operators import dims as D
    sf = "/root/testdata/sf0.001"
    d = _dims(spark, sf)
    wide, tree = D.sku_wide(d["sku"], d["spu"], d["tm"]), _tree(spark, sf)
    plain = lb.base4(spark, _topic(spark, sf), wide, tree)
    twice = lb.base4(spark, _topic(spark, sf), wide.union(wide.withColumn("tname", F.lit("\uffff later"))), tree.union(tree))
    assert plain.count() == twice.count() and twice.where(F.col("tname") == "\uffff later").count() == 0
