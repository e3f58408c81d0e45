"""What a query ships and writes: plan shapes and file sizes that keep its figures in step with the input."""

import glob
import gzip

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemart.operators import dims as D
from tidemart.streaming import runners as R

SF = "/root/testdata/sf0.001"


def _plan(spark, df) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().sparkPlan().toString() + "\n@@\n" + df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_topic_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "FILE_RECORDS", 100)
    df = spark.range(1000).select(F.concat(F.lit("record "), F.col("id").cast("string")).alias("value"))
    R.write_jsonl(df.coalesce(1), str(tmp_path / "t"))
    files = glob.glob(str(tmp_path / "t" / "part-*"))
    assert len(files) == 10 and all(f.endswith(".gz") for f in files)
    assert all(len(gzip.open(f).read().splitlines()) == 100 for f in files)
    assert spark.read.text(str(tmp_path / "t")).count() == 1000


ROUTED = [("t", "k", "r", "1", {"k": "a", "x": "1", "y": "2"}), ("t", "k", "u", "2", {"k": "a", "x": "", "y": "3"}),
          ("t", "k", "r", "1", {"k": "b", "x": "", "y": None}), ("t", "k", "r", "1", {"k": "c", "x": "1"}),
          ("t", "k", "d", "2", {"k": "c", "x": "1"}), ("t", "k", "c", "3", {"k": "c", "y": "9"}),
          ("t", "k", "r", "1", {"k": "d", "x": "1"}), ("t", "k", "d", "5", {"k": "d"}),
          ("u", "k", "r", "1", {"k": "a", "x": "7"}), ("t", "k", "r", "1", {"x": "5"}), ("t", "k", "r", "2", {"x": "6"})]


def _routed(spark):
    return spark.createDataFrame(ROUTED, "sink_table string, sink_row_key string, op string, seq string, "
                                         "data map<string,string>")


def test_dimension_merges_are_one_shuffle_of_the_records(spark):
    r = _routed(spark)
    for df in (D.upsert_merge(r, ["x", "y"]), D.upsert_md5(r, ["x", "y"])):
        plan = _plan(spark, df).split("@@")[1]
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        assert "SortAggregate" not in plan      # no sort of the whole input before the shuffle
    # the records of a row key cross once; the second shuffle is that of keys with several records
    plan = _plan(spark, D.upsert_merge_map(r)).split("@@")[1]
    assert "Join" not in plan


def test_dimension_merges_with_deletes_empty_cells_and_no_key(spark):
    r = _routed(spark)
    got = {(x.sink_table, x.row_key): x.data for x in D.upsert_merge_map(r).collect()}
    assert got == {("t", "a"): {"k": "a", "x": "1", "y": "3"}, ("t", "b"): {"k": "b"}, ("t", "c"): {"k": "c", "y": "9"},
                   ("u", "a"): {"k": "a", "x": "7"}, ("t", None): None}
    wide = {(x.sink_table, x.row_key): (x.x, x.y) for x in D.upsert_merge(r, ["x", "y"]).collect()}
    assert wide == {("t", "a"): ("1", "3"), ("t", "b"): (None, None), ("t", "c"): (None, "9"), ("u", "a"): ("7", None),
                    ("t", None): ("6", None)}


def _exchanges(spark, key):
    return _plan(spark, E.queries()[key](spark, SF)).split("@@")[1]


def test_line_versions_are_shuffled_once(spark):
    assert "ReusedExchange" in _exchanges(spark, "dwd_order_detail")


def test_retraction_reads_the_details_once(spark):
    plan = _exchanges(spark, "order_retraction")
    assert plan.count("FileScan parquet") == 4       # details, orders, and the two feeds of line versions


def test_base4_reads_details_and_orders_once(spark):
    plan = _exchanges(spark, "label_base4")
    assert sum("FileScan parquet [l_" in line or "FileScan parquet [o_" in line for line in plan.splitlines()) == 2


def test_orders_joined_last_are_the_same_details(spark):
    from tidemart.plans import dwd
    from tidemart.sources import fixtures as fx
    t = fx.topic_db(spark, SF)
    a, b = dwd.order_detail(t, keep_seq=True), dwd.order_detail(t, keep_seq=True, by_order=True)
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_retraction_keeps_rows_without_a_key_and_ties(spark):
    from tidemart.operators import dedup as dd
    df = spark.createDataFrame([("a", "1", "5.00"), ("a", "2", "6.00"), ("a", "2", "7.00"), (None, "1", "1.00"),
                                (None, "2", "2.00"), ("b", "1", None), ("b", "2", "3.00")], "id string, seq string, amt string")
    got = sorted((r.id or "", r.seq, r.amt or "", r._retract) for r in dd.retract_versions(df, "id", "seq", ["amt"]).collect())
    assert got == sorted([("a", "1", "5.00", False), ("a", "1", "-5.00", True), ("a", "2", "6.00", False), ("a", "2", "7.00", False),
                          ("", "1", "1.00", False), ("", "2", "2.00", False), ("b", "1", "", False), ("b", "1", "", True),
                          ("b", "2", "3.00", False)])


def test_folded_texts_leave_in_small_batches():
    import pyarrow as pa
    from tidemart.llm import exact_dedup as X
    n = 40
    texts = [b"%05d" % (i % 30) + b"x" * 200_000 for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts, pa.binary()),
                                        pa.array([len(t) for t in texts], pa.int64())], names=["id", "th", "text", "n_chars"])
    out = [b for b in X._fold([batch])]
    entries = [b for b in out if b.column(4).null_count == 0]
    assert max(b.nbytes for b in entries) < 3 << 20
    assert sum(b.num_rows for b in entries) == 30 and sum(sum(b.column(6).to_pylist()) for b in entries) == n
    assert sum(b.num_rows for b in out) == 30 + n


def test_page_log_is_made_and_parsed_behind_the_spread(spark):
    plan = E.queries()["label_base2"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    spread = [i for i, x in enumerate(plan) if "RepartitionByExpression" in x]
    assert spread
    for i in spread:
        assert not any(w in x for x in plan[i:i + 4] for w in ("parseJson", "JsonEvaluator", "from_json"))


def test_time_slot_works_the_hour_out_once(spark):
    from tidemart.functions import scalars as sc

    df = spark.range(1).select(sc.time_slot(F.col("id")).alias("s"), sc.time_slot(F.lit(None).cast("long")).alias("n"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("hour(") == 1
    assert tuple(df.first()) == ("凌晨", None)


def test_interval_join_copies_either_side(spark):
    import pytest

    from tidemart.operators.joins import interval_join

    left = spark.createDataFrame([("a", t) for t in (-7, 0, 5, 10, 11, 39)] + [(None, 3), ("b", None)], "k string, t long")
    right = spark.createDataFrame([("a", t) for t in (-20, -2, 3, 8, 10, 20, 40)] + [("b", 1)], "rk string, rt long")
    for lower, upper in ((-3, 5), (0, 0), (-10, -2)):
        one, two = (sorted(map(tuple, interval_join(left, right, "k", "rk", "t", "rt", lower, upper, copied=c).collect())) for c in ("right", "left"))
        assert one == two == sorted((k, t, rk, rt) for k, t in map(tuple, left.collect()) for rk, rt in map(tuple, right.collect())
                                    if k == rk and t is not None and t + lower <= rt <= t + upper)
    with pytest.raises(ValueError):
        interval_join(left, right, "k", "rk", "t", "rt", 0, 1, "left", copied="left")


def _odd_topic(spark):
    """Change records of all four tables: versions, an order twice, details without an id, an order, or either."""
    def rec(tbl, ts, **after):
        return ({"db": "shop", "table": tbl}, "r", ts, {k: v for k, v in after.items()}, None, f"{ts:04d}")
    rows = [rec("order_info", 1, id="o1", user_id="u1", province_id="p1"), rec("order_info", 2, id="o2", user_id="u2", province_id="p2"),
            rec("order_info", 3, id="o2", user_id="u3", province_id=None), rec("order_info", 4, id=None, user_id="u4", province_id="p4"),
            rec("order_info", 5, id="o5", user_id=None, province_id="p5")]
    details = [("a", "o1"), ("a", "o1"), ("a", "o2"), ("b", "o2"), ("b", "gone"), (None, "o1"), (None, "o2"), (None, "o2"), (None, None),
               ("c", None), ("", "o1"), ("d", "o5"), ("e", "gone")]
    rows += [rec("order_detail", 10 + i, id=d, order_id=o, sku_id=f"s{i}", sku_num="2", order_price="1.50", create_time="0",
                 split_total_amount=str(i)) for i, (d, o) in enumerate(details)]
    rows += [rec("order_detail_activity", 40, order_detail_id="a", activity_id="x"), rec("order_detail_activity", 41, order_detail_id="a", activity_id="y"),
             rec("order_detail_activity", 42, order_detail_id=None, activity_id="z"), rec("order_detail_coupon", 43, order_detail_id="b", coupon_id="k"),
             rec("order_detail_coupon", 44, order_detail_id="", coupon_id="m")]
    return spark.createDataFrame(rows, "source map<string,string>, op string, ts_ms long, after map<string,string>, "
                                       "before map<string,string>, seq string")


def test_details_shipped_once_are_the_same_details(spark):
    from tidemart.plans import dwd
    from tidemart.sources import fixtures as fx
    for t in (_odd_topic(spark), fx.topic_db(spark, SF)):
        a, b = dwd.order_detail(t, keep_seq=True), dwd.order_detail(t, keep_seq=True, by_detail=True)
        assert a.columns == b.columns and a.count() == b.count() > 0
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    # two versions of a under o1, one under o2 (two orders): each with two activities; b, d, the empty id and those without
    odd = dwd.order_detail(_odd_topic(spark), by_detail=True)
    assert odd.count() == 8 + 2 + 1 + 1 + 5 and odd.where("id IS NULL").count() == 5


def test_details_cross_one_shuffle(spark):
    # the dimensions of the sku windows lie by an id too
    for key, others in (("dwd_order_detail", 0), ("upsert_latest", 0), ("dws_sku_order", 4)):
        plan = _exchanges(spark, key)
        assert plan.count("Exchange hashpartitioning(id#") == 1 + others, key
        assert "Exchange hashpartitioning(order_id#" not in plan, key


def test_newer_rows_are_found_where_they_lie(spark):
    import random

    from tidemart.operators import dedup as dd
    rnd = random.Random(5)
    rows = [(rnd.choice("abc"), rnd.randrange(2), rnd.choice(["x", "y", "z", None]), rnd.choice([None, *range(9)]), f"{i:03d}", str(i))
            for i in range(400)]
    # the same, with the later arrivals of x in another group
    rows += [("d" if i < 3 else "e", 0, "w", t, f"{i:03d}", "w") for i, t in enumerate([None, 2, 1, 2, 3, 3, 4, None])]
    df = spark.createDataFrame(rows, "o string, b int, k string, ts int, seq string, payload string")
    want = dd.strictly_newer(df, "k", "ts", "seq")
    got = dd.strictly_newer_apart(df, "k", "ts", "seq", ["o", "b"])
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert sorted((r.seq, r.ts) for r in got.where("k = 'w'").collect()) == [("000", None), ("001", 2), ("004", 3), ("006", 4)]


def test_base4_details_and_orders_cross_one_shuffle(spark):
    plan = _exchanges(spark, "label_base4").splitlines()
    own = [i for i, x in enumerate(plan) if "Exchange hashpartitioning" in x and "Reused" not in x and "bucket" not in x
           and any(f"Exchange hashpartitioning({k}#" in x for k in ("detail_id", "order_id", "id"))]
    # what goes by detail id is the mark of a row: no name, amount or user with it
    marks = [x for x in plan if "Exchange hashpartitioning(detail_id#" in x]
    assert len(marks) == 1 and own
    assert sum("FileScan parquet [l_" in x or "FileScan parquet [o_" in x for x in plan) == 2
    assert any("ReusedExchange" in x and "consignee" in x and "total_amount" in x for x in plan)
    assert any("ReusedExchange" in x and "sku_name" in x and "order_price" in x for x in plan)


def test_dimension_images_are_made_once_a_reading(spark):
    for key in ("dim_upsert_md5", "dim_upsert_merge", "dim_build", "dim_route"):
        plan = _exchanges(spark, key).splitlines()
        assert not any("Filter" in x and "size(map" in x for x in plan), key
        assert sum("Exchange hashpartitioning(l_orderkey#" in x and "Reused" not in x for x in plan) == 1, key


def test_gate_on_odd_images(spark):
    from tidemart.operators import envelope as ev
    m = {"id": "1"}
    rows = [("shop", "r", None, m), ("shop", "u", m, m), ("shop", "d", m, {}), ("shop", "d", m, m), ("shop", "d", {}, m), ("shop", "d", None, m),
            ("shop", "r", m, {}), ("shop", "r", m, None), ("other", "r", None, m), ("shop", "x", None, m), ("shop", None, None, m), (None, "r", m, m)]
    env = spark.createDataFrame([(b, a, {"db": d} if d else None, op, str(i)) for i, (d, op, b, a) in enumerate(rows)],
                                "before map<string,string>, after map<string,string>, source map<string,string>, op string, seq string")
    for deletes, want in ((False, "01345"), (True, "0123")):
        got = ev.cdc_gate(env, "shop", accept_deletes=deletes)
        assert got.columns == env.columns
        got = sorted(got.collect(), key=lambda r: r.seq)
        assert "".join(r.seq for r in got) == want
        assert [(r.before, r.after) for r in got] == [rows[int(r.seq)][2:] for r in got]
