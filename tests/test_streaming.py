"""Batch == stream: the streaming bodies give the batch results whatever the
micro-batch boundaries (input split into several files, one per trigger)."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemart.operators import dedup as dd
from tidemart.operators import text as tx
from tidemart.plans import dwd, dws, labels
from tidemart.operators.logs import device_search_flatten, repair_is_new, split_logs
from tidemart.queries import _logs, _pages, _topic
from tidemart.session import scratch_path
from tidemart.sources import fixtures as fx
from tidemart.streaming import jobs as J
from tidemart.streaming import runners as R

SF = "/root/testdata/sf0.001"


def _chunks(df, ts, n, name, spark):
    """Write ``df`` as ``n`` JSON files in event-time order (arrival order)."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:6]}")
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = df.where((F.col(ts) >= lo + i * step) & (F.col(ts) < lo + (i + 1) * step))
        part.coalesce(1).write.mode("overwrite").json(os.path.join(path, f"c{i:02d}"))
    return path


def _stream(spark, path, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .json(path))


def _rows(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_first_of_day_stream(spark):
    cart = dwd.cart_add(_topic(spark, SF, "cart_info"))
    path = _chunks(cart, "ts_ms", 4, "cart", spark)
    s = _stream(spark, path, ",".join(f"{f.name} {f.dataType.simpleString()}" for f in cart.schema))
    day = F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd")
    cols = ["id", "user_id", "sku_id", "sku_num", "ts_ms"]
    got = R.run_available_now(J.first_of_day(s, "user_id", "ts_ms", ["ts_ms", "id"], cols), "fod")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = dd.first_of_day(cart, "user_id", day, ["ts_ms", "id"])
    assert _rows(got, cols) == _rows(want, cols)


def _versions(spark):
    env = fx.order_detail_env(spark, SF)
    a = F.col("after")
    return env.select(a["id"].alias("id"), a["create_time"].cast("long").alias("create_time"),
                      a["split_total_amount"].alias("amt"), "ts_ms", "seq")


def test_strictly_newer_and_retraction_stream(spark):
    v = _versions(spark)
    path = _chunks(v, "ts_ms", 3, "versions", spark)
    schema = "id string, create_time long, amt string, ts_ms long, seq string"
    got = R.run_available_now(J.strictly_newer(_stream(spark, path, schema), "id", "create_time", "seq",
                                               ["id", "create_time", "seq"]), "sn")
    want = dd.strictly_newer(v, "id", "create_time", "seq")
    assert _rows(got, ["id", "seq"]) == _rows(want, ["id", "seq"])
    cols = ["id", "amt", "seq"]
    got = R.run_available_now(J.retract_versions(_stream(spark, path, schema), "id", "seq", cols, "amt"), "rv")
    want = dd.retract_versions(v.select(*cols), "id", "seq", ["amt"]).withColumnRenamed("_retract", "is_retraction")
    assert _rows(got, cols + ["is_retraction"]) == _rows(want, cols + ["is_retraction"])


def test_latest_after_wait_stream(spark):
    v = _versions(spark).select("id", "amt", "ts_ms", "seq")
    sentinel = spark.createDataFrame([("~sentinel", "0", 4_000_000_000_000, "z")], v.schema)
    path = _chunks(v.unionByName(sentinel), "ts_ms", 3, "latest", spark)
    s = _stream(spark, path, "id string, amt string, ts_ms long, seq string")
    got = R.run_available_now(J.latest_after_wait(s, "id", "ts_ms", "seq", ["id", "amt", "ts_ms", "seq"]), "law")
    want = dd.dedup_latest(v, "id", "ts_ms", "seq")
    assert _rows(got, ["id", "seq"]) == _rows(want, ["id", "seq"])


def test_is_new_and_profile_stream(spark):
    logs, _ = __import__("tidemart.operators.logs", fromlist=["parse_logs"]).parse_logs(fx.page_log_topic(spark, SF))
    flat = logs.select("offset", F.col("common.mid").alias("mid"), "ts", F.col("common.is_new").alias("is_new"))
    path = _chunks(flat, "ts", 3, "isnew", spark)
    got = R.run_available_now(J.fix_is_new(_stream(spark, path, "offset long, mid string, ts long, is_new string"),
                                           ["offset", "mid", "ts"]), "fin")
    want = repair_is_new(logs).select("offset", F.col("common.mid").alias("mid"), "ts",
                                      F.col("common.is_new").alias("is_new"))
    assert _rows(got, ["offset", "is_new"]) == _rows(want, ["offset", "is_new"])

    rows = labels.device_rows(_pages(spark, SF), keep_offset=True).select(
        "uid", "ts", "offset", *[F.col(f"deviceInfo.{c}").alias(c) for c in ("os", "ch", "md", "ba")], "search_item")
    path = _chunks(rows, "ts", 3, "profile", spark)
    s = _stream(spark, path, "uid string, ts long, offset long, os string, ch string, md string, ba string, search_item string")
    got = R.run_available_now(J.running_profile(s), "rp")
    want = labels.running_profile_records(labels.device_rows(_pages(spark, SF), keep_offset=True))
    cols = ["uid", "ts_ms", "pv", "os", "ch", "md", "ba", "search_item"]
    assert _rows(got, cols) == _rows(want, cols)


def test_keyword_window_stream(spark):
    p = _pages(spark, SF)
    search = p.where((F.col("page.last_page_id") == "search") & (F.col("page.item_type") == "keyword")) \
        .select("offset", "ts", F.col("page.item").alias("fullword"))
    sentinel = spark.createDataFrame([(-1, 4_000_000_000_000, "zz")], search.schema)
    path = _chunks(search.unionByName(sentinel), "ts", 3, "kw", spark)
    got = R.run_available_now(J.keyword_counts(_stream(spark, path, "offset long, ts long, fullword string"),
                                               "1 hour"), "kw")
    want = dws.keyword(tx.explode_tokens(search, "fullword"), "1 hour").select(
        (F.unix_millis(F.to_timestamp("stt")).alias("wstart")), "keyword", "keyword_count")
    assert _rows(got) == _rows(want)


def test_upsert_table_stream(spark):
    v = _versions(spark).select("id", "amt", "ts_ms", "seq")
    path = _chunks(v, "ts_ms", 3, "ups", spark)
    table = R.UpsertTable(scratch_path(spark, f"upsert-{uuid.uuid4().hex[:6]}"), ["id"], "seq")
    q = table.start(_stream(spark, path, "id string, amt string, ts_ms long, seq string"),
                    scratch_path(spark, f"upsert-ck-{uuid.uuid4().hex[:6]}"))
    q.awaitTermination()
    got = table.read(spark)
    want = dd.upsert_latest(v, "id", "seq")
    assert _rows(got) == _rows(want.select(*got.columns))


def test_stream_join_bound_and_outer_nulls(spark):
    """Partners farther apart than the bound don't join; a left row without a partner gets nulls."""
    from tidemart.operators.envelope import envelope_to_json, parse_cdc
    from tidemart.streaming import joins as SJ

    def rec(tbl, ts, **after):
        return (None, {k: str(v) for k, v in after.items()}, {"db": "x", "table": tbl}, "r", t0 + ts)

    b, t0 = SJ.BOUND_MS, 1_700_000_000_000
    detail = dict(sku_id=1, sku_name="s", create_time=0, sku_num=1, order_price="2.00")
    rows = [rec("order_info", 0, id="o1", user_id="u", province_id="p"),
            rec("order_detail", b, id="d1", order_id="o1", **detail),                    # exactly at the bound: joins
            rec("order_detail", b + 1, id="d2", order_id="o1", **detail),                # one past it: doesn't
            rec("order_detail_activity", 2 * b, id="a1", order_detail_id="d1", activity_id="7", activity_rule_id="8"),
            rec("order_info", 10 * b, id="o3", user_id="u", province_id="p"),
            rec("order_detail", 10 * b, id="d3", order_id="o3", **detail),
            rec("order_detail_activity", 11 * b + 1, id="a3", order_detail_id="d3", activity_id="7"),  # past it: nulls
            rec("order_detail_coupon", 10 * b, id="c3", order_detail_id="d3", coupon_id="9")]
    schema = ("before map<string,string>, after map<string,string>, source map<string,string>, op string, "
              "ts_ms bigint")
    topic = spark.createDataFrame(rows, schema)
    phases = [topic.where(F.col("ts_ms") <= t0 + 2 * b), topic.where(F.col("ts_ms") > t0 + 2 * b),
              SJ.heartbeat(topic, t0 + 50 * b)]
    got = R.replay(spark, [envelope_to_json(p) for p in phases], lambda raw: SJ.order_detail(parse_cdc(raw)), "bound")
    assert sorted((r.id, r.activity_id, r.coupon_id) for r in got.collect()) == [("d1", "7", None), ("d3", None, "9")]


def test_stream_join_kinds(spark):
    from tidemart.streaming import joins as SJ
    with pytest.raises(ValueError):
        SJ.join_within(None, None, None, "a", "b", "right")


def test_first_of_day_out_of_order_days(spark):
    """Day 2, day 1, day 2 again over three micro-batches: one row a day, as in the batch body."""
    day = 86_400_000
    rows = spark.createDataFrame([("u", 2 * day + 5, "a"), ("u", day + 5, "b"), ("u", 2 * day + 9, "c")],
                                 "user_id string, ts_ms long, id string")
    lines = [rows.where(F.col("id") == i).select(F.to_json(F.struct("*")).alias("value")) for i in "abc"]
    cols = ["user_id", "ts_ms", "id"]
    got = R.replay(spark, lines, lambda raw: J.first_of_day(
        raw.select(F.from_json("value", "user_id string, ts_ms long, id string").alias("r")).select("r.*"),
        "user_id", "ts_ms", ["ts_ms", "id"], cols), "fod-order")
    assert sorted(r.id for r in got.collect()) == ["a", "b"]


# ---------------------------------------------------------------- settings, state lifetime (T6), processing time

DAY = 86_400_000


def _plain_conf(spark):
    """The session as a user finds it: default state store, a zone that isn't UTC."""
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")


@pytest.fixture
def plain(spark):
    before = {k: spark.conf.get(k) for k in R.STREAM_CONF}
    _plain_conf(spark)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _topic_of(spark, rows, schema):
    return spark.createDataFrame(rows, schema).select(F.to_json(F.struct("*")).alias("value"))


def _from_json(raw, schema):
    return raw.select(F.from_json("value", schema).alias("r")).select("r.*")


LOGIN = "uid string, ts long"


def _logins(rows):
    from tidemart.operators.logs import LOG_SCHEMA  # noqa: F401
    return [(f'{{"common":{{"mid":"{u}","uid":"{u}"}},"page":{{}},"ts":{t}}}',) for u, t in rows]


def test_streams_bring_their_own_settings(plain):
    """Event times around the zone's daylight-saving change, in a session without the RocksDB store and not at UTC."""
    from tidemart.operators import logs as lg
    from tidemart.streaming import dws as SD
    gap = 1_710_064_800_000  # 2024-03-10 10:00 UTC: 02:00 of the zone's missing hour
    rows = [("a", gap - 1), ("a", gap + 1), ("b", gap + 1), ("a", gap + DAY), ("b", gap + 9 * DAY)]
    phases = [plain.createDataFrame(_logins(p), "value string") for p in (rows[:3], rows[3:], [("~heartbeat", gap + 40 * DAY)])]
    raw = "offset long, value string"
    lines = [p.select(F.to_json(F.struct(F.lit(0).cast("long").alias("offset"), "value")).alias("value")) for p in phases]
    out = R.replay(plain, lines, lambda line: SD.user_login(lg.split_logs(lg.parse_logs(_from_json(line, raw))[0])["page"], "1 hour"), "dst")
    got = sorted((r.stt, r.back_ct, r.uu_ct) for r in out.collect())
    assert got == [("2024-03-10 09:00:00", 0, 1), ("2024-03-10 10:00:00", 0, 1), ("2024-03-11 10:00:00", 0, 1),
                   ("2024-03-19 10:00:00", 1, 1)]
    assert plain.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"


def _state_rows(progress):
    return sum(op["numRowsTotal"] for op in progress["stateOperators"])


def test_state_stays_flat_over_thirty_days(plain):
    """Every day brings new keys; idle ones leave by timer, so no state grows with the days."""
    schema = "key string, ts long, offset long, is_new string"
    start = 1_704_067_200_000
    days = [[(f"{d}-{i}", start + d * DAY + i * 1000, i, "1") for i in range(20)] for d in range(30)]
    forms = {
        "first": lambda ev: J.P.apply(ev, ["key"], J.P.FirstOfDay("ts", ["ts"], ["key", "ts"], timers=True), "key string, ts long", "EventTime", ""),
        "fixed": lambda ev: J.P.apply(ev, ["key"], J.P.FixIsNew(["key", "ts"], idle_ms=2 * DAY), "key string, ts long, is_new string", "EventTime", ""),
    }
    for name, form in forms.items():
        seen = []
        R.replay_path(plain, [_topic_of(plain, d, schema) for d in (sum(days[i:i + 6], []) for i in range(0, 30, 6))],
                      lambda raw: form(_from_json(raw, schema).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds")),
                      f"flat-{name}", watch=lambda p: seen.append(_state_rows(p)))
        assert max(seen[1:]) <= seen[1] and seen[-1] == seen[1], (name, seen)


def test_a_key_that_stays_active_keeps_its_state(plain):
    schema = "uid string, ts long"
    start = 1_704_067_200_000
    # logins 9 days apart, then one after 12: idle time starts anew with every record
    rows = [[("u", start + d * DAY)] for d in (0, 9, 18)] + [[("u", start + 30 * DAY)], [("~", start + 90 * DAY)]]
    out = R.replay(plain, [_topic_of(plain, r, schema) for r in rows],
                   lambda raw: J.P.apply(_from_json(raw, schema).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds"),
                                         ["uid"], J.P.ReturningUser(8, 15 * DAY), "uid string, ts long, et timestamp, back long", "EventTime", "et"), "active")
    assert sum(r.back for r in out.where("uid = 'u'").collect()) == 3


def test_processing_time_state_ends_by_ttl(plain):
    """A mid whose state's TTL has run out is met as a new one."""
    import time
    schema = "mid string, ts long, offset long, is_new string"
    start = 1_704_067_200_000
    phases = [[("m", start, 0, "1")], [("m", start + DAY, 1, "1")], [("m", start + 2 * DAY, 2, "1")]]
    for ttl, want in ((3_600_000, ["1", "0", "0"]), (3_000, ["1", "1", "1"])):
        out = R.replay(plain, [_topic_of(plain, p, schema) for p in phases],
                       lambda raw: J.fix_is_new(_from_json(raw, schema), ["mid", "ts", "offset"], ttl), "ttl", no_data_batches=False,
                       before=lambda i: time.sleep(4 if i and ttl == 3_000 else 0))
        assert [r.is_new for r in out.orderBy("offset").collect()] == want


# ---------------------------------------------------------------- trade windows (L11, L12: A4, A11, T10, W4)

VERSION = "id string, order_id string, province_id string, split_total_amount string, ts_ms long, seq string"


def test_province_orders_under_retraction(plain):
    from tidemart.streaming import dws as SD
    t = 1_704_067_200_000
    province = plain.createDataFrame([("1", "north")], "id string, name string")
    phases = [
        # two details of one order, one of another; detail d1 in two versions within a batch
        [("d1", "o1", "1", "10.00", t, "1"), ("d1", "o1", "1", "12.50", t + 1, "2"), ("d2", "o1", "1", "5.00", t + 2, "3"),
         ("d3", "o2", "2", None, t + 3, "4")],
        # the next batch takes back d2 in the same open window, and counts the order again in a later one
        [("d2", "o1", "1", "7.00", t + 9_000, "5"), ("d1", "o1", "1", "1.00", t + 11_000, "6")],
        # the window of d1's last version has closed: its retraction is late (Q8), so both amounts stay
        [("d9", "o9", "1", "100.00", t + 30_000, "7")],
        [("d1", "o1", "1", "2.00", t + 31_000, "8")],
        [("~", "~", "~", None, t + 900_000, "9")],
    ]
    out = R.replay(plain, [_topic_of(plain, p, VERSION) for p in phases],
                   lambda raw: SD.province_order(_from_json(raw, VERSION), province, "10 seconds", keep_ms=3_600_000), "province")
    got = sorted((r.stt[-8:], r.province_id, r.province_name, r.order_count, str(r.order_amount)) for r in out.where("province_id <> '~'").collect())
    assert got == [("00:00:00", "1", "north", 1, "7.00"),    # 10 - 10 + 12.5 + 5 - 5 + 7 - 12.5
                   ("00:00:00", "2", None, 1, "0.00"),
                   ("00:00:10", "1", "north", 1, "1.00"),
                   ("00:00:30", "1", "north", 2, "102.00")]


SKU = "id string, sku_id string, split_original_amount string, split_activity_amount string, split_coupon_amount string, split_total_amount string, ts_ms long, seq string"


def test_processing_time_timer_and_window(plain):
    """T10/W4 on the machine's clock: nothing leaves before 5 s, then the latest version does, once; its window comes out
    when that has ended."""
    import time
    from tidemart.streaming import dws as SD

    def row(i, sku, amount, ts, seq):
        return (i, sku, amount, "0", "0", amount, ts, seq)
    filler = [row("x", "other", "0", 9, "5")]
    phases = [[row("d1", "s", "1.00", 5, "1"), row("d2", "s", "10.00", 5, "2"), row("d1", "s", "2.00", 6, "3"), row("d1", "s", "0.50", 4, "4")],
              filler, filler]
    waits = [0, 6, 8]
    for form, want in ((lambda d: SD.waited_versions(d, 5000, processing=True).select("id", "split_total_amount"),
                        [("d1", "2.00"), ("d2", "10.00")]),
                       (lambda d: SD.waited_versions(d, 3_600_000, processing=True).select("id", "split_total_amount"), []),
                       (lambda d: SD.sku_order_by_clock(d, "2 seconds").select("sku_id", "order_amount"),
                        [("s", "12.0000")])):
        out = R.replay(plain, [_topic_of(plain, p, SKU) for p in phases], lambda raw: form(_from_json(raw, SKU)), "clock",
                       no_data_batches=False, before=lambda i: time.sleep(waits[i]))
        assert sorted((a, str(b)) for a, b in out.collect() if a not in ("x", "other")) == want


# ---------------------------------------------------------------- stream-static dictionary (J4), live config

def _change(tbl, op, seq, before=None, after=None, ts=0):
    return (before, after, {"db": "shop", "table": tbl}, op, ts, seq)


ENV = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms long, seq string"


def _envelopes(spark, rows):
    return spark.createDataFrame(rows, ENV).select(F.to_json(F.struct("*")).alias("value"))


def test_dictionary_changes_between_batches(plain):
    from tidemart.streaming import comments as SC
    base = scratch_path(plain, f"dic-{uuid.uuid4().hex[:6]}")
    dic = R.UpsertTable(f"{base}/dic", SC.DIC_KEYS, "seq", buckets=1)
    changes = [[_change("base_dic", "r", "1", after={"dic_code": "1201", "dic_name": "good"}), _change("base_dic", "r", "1", after={"dic_code": "1202", "dic_name": "fair"})],
               [_change("base_dic", "u", "2", after={"dic_code": "1201", "dic_name": "very good"}), _change("base_dic", "d", "3", before={"dic_code": "1202", "dic_name": "fair"}),
                _change("base_dic", "c", "4", after={"dic_code": "1203", "dic_name": "bad"})]]

    def merge(i):
        if 0 < i <= len(changes):
            SC.keep_dictionary(dic)(plain.createDataFrame(changes[i - 1], ENV), i)
    said = [[_change("comment_info", "r", f"{i}{code}", after={"id": f"{i}{code}", "appraise": code}) for code in ("1201", "1202", "1203")] for i in range(3)]
    pins = R.Pinned(dic, f"{base}/pins")
    sink = SC.comment_facts(pins)
    out = R.replay_path(plain, [_envelopes(plain, p) for p in said], lambda raw: _from_json(raw, ENV), "facts", sink, before=merge)
    rows = sorted((r.id, r.appraise_name, r.dic_version) for r in plain.read.parquet(out).collect())
    assert rows == [("11201", "good", 1), ("11202", "fair", 1), ("21201", "very good", 2), ("21203", "bad", 2)]
    # a retry of an old micro-batch sees the dictionary that the first attempt saw
    sink(out)(plain.createDataFrame(said[1], ENV), 1)
    assert sorted((r.id, r.appraise_name, r.dic_version) for r in plain.read.parquet(out).collect()) == rows


def test_config_changes_the_routing_between_batches(plain):
    from tidemart.streaming import dimbuild as SB
    base = scratch_path(plain, f"cfg-{uuid.uuid4().hex[:6]}")
    config, cells = R.UpsertTable(f"{base}/config", SB.CONFIG_KEYS, "seq", buckets=1), R.UpsertTable(f"{base}/cells", SB.CELL_KEYS, "seq")

    def cfg(tbl, cols, op, seq):
        return (tbl, f"dim_{tbl}", cols, "info", "id", op, seq)
    feed = ",".join(f"{c} string" for c in SB.CONFIG_COLUMNS)
    changes = [[cfg("a", "id,x", "r", "1"), cfg("b", "id,x", "r", "1"), cfg("c", "id,x", "r", "1")],
               [cfg("b", "id,y", "u", "2"), cfg("c", "id,x", "d", "2"), cfg("d", "id,x", "c", "2")],
               [cfg("c", "id,y", "c", "3")]]

    def put(tbl, key, n):
        return _change(tbl, "c", f"{n:04d}", after={"id": key, "x": f"x{n}", "y": f"y{n}"}, ts=n)
    data = [[put(t, "1", n) for n, t in enumerate("abcd")], [put(t, "2", n + 10) for n, t in enumerate("abcd")], [put(t, "3", n + 20) for n, t in enumerate("abcd")]]
    pins = R.Pinned(config, f"{base}/pins")
    seen = []

    def before(i):
        if i:
            seen.append(rows())
        SB.keep_config(config, f"{base}/ddl")(plain.createDataFrame(changes[i], feed), i)

    def rows():
        got = SB.dimension_rows(cells.read(plain), config.read(plain))
        return sorted((r.sink_table, r.row_key, tuple(sorted(r.data.items()))) for r in got.collect())
    R.replay_path(plain, [_envelopes(plain, p) for p in data], lambda raw: _from_json(raw, ENV), "cells", lambda _: SB.merge_into(cells, pins, "shop"), before=before)
    seen.append(rows())

    def row(tbl, key, col, n):
        return (f"dim_{tbl}", key, (("id", key), (col, f"{col}{n}")))
    assert seen[0] == [row("a", "1", "x", 0), row("b", "1", "x", 1), row("c", "1", "x", 2)]
    # b was dropped and created anew with another column, c dropped, d created
    assert seen[1] == [row("a", "1", "x", 0), row("a", "2", "x", 10), row("b", "2", "y", 11), row("d", "2", "x", 13)]
    # c comes back empty
    assert seen[2] == [row("a", "1", "x", 0), row("a", "2", "x", 10), row("a", "3", "x", 20), row("b", "2", "y", 11), row("b", "3", "y", 21),
                       row("c", "3", "y", 22), row("d", "2", "x", 13), row("d", "3", "x", 23)]
    ddl = plain.read.parquet(f"{base}/ddl")
    assert sorted((r.batch, r.seq, r.step, r.action, r.sink_table) for r in ddl.where("batch > 0").collect()) == [
        (1, "2", 0, "create", "dim_d"), (1, "2", 0, "drop", "dim_b"), (1, "2", 0, "drop", "dim_c"), (1, "2", 1, "create", "dim_b"), (2, "3", 0, "create", "dim_c")]
    # a retried batch gives the same table
    SB.merge_into(cells, pins, "shop")(plain.createDataFrame(data[2], ENV), 2)
    assert rows() == seen[2]


def test_dimension_rows_travel_whole_and_fold_in_any_order(spark):
    from tidemart.streaming import dimbuild as SB
    schema = "sink_table string, epoch long, sink_row_key string, op string, seq string, data map<string,string>"

    def rec(key, op, seq, **data):
        return ("t", 0, "id", op, seq, {**({"id": key} if key else {}), **data})
    recs = [rec("1", "r", "1", x="a", y="b"), rec("1", "u", "3", x="c", y=""), rec("2", "r", "1", x="a"), rec("2", "d", "4"),
            rec("2", "c", "6", y="z"), rec("3", "r", "2", x="a"), rec("3", "d", "5"), rec(None, "c", "1", x="n"), rec("4", "d", "1"),
            rec("5", "r", "1", x="a", y="b"), rec("5", "u", "3", x="c"), rec("5", "d", "2"), rec("1", "u", "4", y="e"), rec(None, "c", "2", y="m"),
            rec("6", "c", "9", x="", y="")]
    want = [(None, (("x", "n"), ("y", "m"))), ("1", (("id", "1"), ("x", "c"), ("y", "e"))), ("2", (("id", "2"), ("y", "z"))),
            ("5", (("id", "5"), ("x", "c"))), ("6", (("id", "6"),))]
    assert SB.cells(spark.createDataFrame(recs, schema)).count() == len(recs)
    config = spark.createDataFrame([("t", 0, "r")], "sink_table string, epoch long, op string")
    for order in (recs, recs[::-1], recs[1::2] + recs[::2]):
        table = R.UpsertTable(scratch_path(spark, f"fold-{uuid.uuid4().hex[:6]}"), SB.CELL_KEYS, "seq", buckets=2)
        for i in range(3):
            table.merge_batch(SB.cells(spark.createDataFrame(order[i * 5:i * 5 + 5], schema)), i, SB.fold)
        got = SB.dimension_rows(table.read(spark), config).collect()
        assert sorted(((r.row_key, tuple(sorted(r.data.items()))) for r in got), key=str) == sorted(want, key=str)


# ---------------------------------------------------------------- dedup streams (T13, T14), event-time policies

def test_exact_dedup_across_batches_and_its_state(plain):
    from tidemart.streaming import dedup as SX
    schema = "uid string, v string, ts long"
    t = 1_704_067_200_000
    phases = [[("a", "x", t), ("a", "x", t), ("a", "y", t)], [("a", "x", t), ("b", "x", t + 1000)], [("~", "~", t + DAY)]]
    seen = []
    out = R.replay(plain, [_topic_of(plain, p, schema) for p in phases],
                   lambda raw: SX.exact(_from_json(raw, schema), "ts", ["uid", "v", "ts"], "5 seconds"), "exact", watch=lambda p: seen.append(_state_rows(p)))
    assert sorted((r.uid, r.v) for r in out.where("uid <> '~'").collect()) == [("a", "x"), ("a", "y"), ("b", "x")]
    assert seen[-1] == 1


def test_bloom_dedup_keeps_its_rate(plain):
    """Twice as many keys as the filter was sized for: repeats always go, other rows at most at the given rate."""
    from tidemart.streaming import dedup as SX
    schema = "order_id long, ts_ms long, seq string"
    n, fpp = 4000, 0.02
    rows = [(i, 7 * i + 1, f"{i:06d}") for i in range(n)]
    phases = [rows[: n // 2] + rows[:50], rows[n // 2:] + rows[100:300], rows[::3]]
    cols = ["order_id", "ts_ms", "seq"]
    out = R.replay(plain, [_topic_of(plain, p, schema) for p in phases],
                   lambda raw: SX.bloom_first(_from_json(raw, schema), cols[:2], "seq", cols, n // 2, fpp, 3), "bloom")
    got = [r.order_id for r in out.collect()]
    assert len(got) == len(set(got))
    lost = n - len(got)
    assert 0 <= lost <= fpp * n, lost
    exact = R.replay(plain, [_topic_of(plain, p, schema) for p in phases],
                     lambda raw: SX.first_arrival(_from_json(raw, schema), cols[:2], "seq", "ts_ms", cols), "first")
    assert sorted(r.order_id for r in exact.collect()) == list(range(n))


def test_event_time_policies_on_both_sides_of_their_bounds(plain):
    """A record exactly the bound before the newest of earlier batches counts, one a millisecond earlier is late."""
    from tidemart.streaming import eventtime as E
    t = 1_704_067_200_000
    for policy, ms in ((E.ASCENDING, 0), (E.LABEL_SOURCE, 3_000), (E.JOINED, 5_000), (E.FIRST_PRESENT, 3_000)):
        key = "ts" if policy is E.FIRST_PRESENT else "ts_ms"

        def said(*times):
            return plain.createDataFrame([(f'{{"{key}":{x},"v":1}}',) for x in times], "value string")
        phases = [said(t), said(t - ms, t - ms - 1), said(t + 20_000)]
        out = R.replay(plain, phases, lambda raw: policy.apply(raw).groupBy(F.window("et", "1 millisecond")).count()
                       .select(F.unix_millis("window.start").alias("at"), "count"), "policy")
        assert t - ms in [r["at"] for r in out.collect()] or ms == 0
        assert t - ms - 1 not in [r["at"] for r in out.collect()]


def test_event_time_of_odd_records(plain):
    from tidemart.streaming import eventtime as E
    odd = ["no json", "{}", '{"ts_ms":"soon"}', '{"ts_ms":null,"ts":5}', '{"ts_ms":"7"}', '{"ts_ms":9}', None]
    df = plain.createDataFrame([(x,) for x in odd], "value string")
    got = [r[0] for r in df.select(F.unix_millis(E.LABEL_SOURCE.column())).collect()]
    assert got == [0, 0, 0, 0, 7, 9, 0]
    assert [r[0] for r in df.select(F.unix_millis(E.FIRST_PRESENT.column())).collect()] == [0, 0, 0, 5, 7, 9, 0]


def test_record_time_from_the_source(plain):
    """S3: the source's own time column is the event time, whatever the record says."""
    import time
    from tidemart.streaming import eventtime as E
    path = scratch_path(plain, f"stamped-{uuid.uuid4().hex[:6]}")
    start = time.time()
    plain.createDataFrame([('{"ts_ms":1}',)], "value string").write.text(path)
    out = R.run_available_now(E.RECORD_TIME.apply(R.stamped_file_topic(plain, path)).select(F.unix_millis("et").alias("at")), "stamped")
    assert abs(out.first()[0] / 1000 - start) < 120


def test_label_merge_within_a_day(plain):
    from tidemart.streaming import labels as SL
    h = 3_600_000
    t = 1_704_067_200_000
    b2, b4, b6 = "uid long, ts_ms long, pv long", "uid long, ts_ms long, detail_id string", "uid long, ts_ms long, gender string"
    rows = {"base2": ([(1, t, 1), (1, t + 30 * h, 2), (2, t, 3)], b2),
            "base4": ([(1, t + 24 * h, "in"), (1, t + 24 * h + 1, "out"), (2, t - h, "early")], b4),
            "base6": ([(1, t + 48 * h, "F"), (2, t + 23 * h, "M"), (2, t + 23 * h + 1, "M")], b6)}
    frames = {n: plain.createDataFrame(*x) for n, x in rows.items()}

    def phase(lo, hi):
        parts = [SL.records(df.where(f"ts_ms >= {lo} AND ts_ms < {hi}"), n) for n, df in frames.items()]
        return parts[0].union(parts[1]).union(parts[2])
    beat = [SL.records(SL.heartbeat(df, n, t + 900 * h), n) for n, df in frames.items()]
    seen = []
    out = R.replay(plain, [phase(0, t + 10 * h), phase(t + 10 * h, t + 800 * h), beat[0].union(beat[1]).union(beat[2])],
                   lambda raw: SL.merge(*[SL.branch(raw, n, df.schema) for n, df in frames.items()]), "merge", watch=lambda p: seen.append(_state_rows(p)))
    got = sorted((r.uid, r.pv, r.detail_id, r.gender, (r.base6_ts_ms - t) // h) for r in out.collect())
    want = sorted((u, pv, d, g, (t6 - t) // h) for u, t2, pv in rows["base2"][0] for u4, t4, d in rows["base4"][0] for u6, t6, g in rows["base6"][0]
                  if u == u4 == u6 and abs(t2 - t4) <= 24 * h and abs(t6 - t4) <= 24 * h)
    assert got == want and len(want) >= 3
    assert seen[-1] < seen[1]


# ---------------------------------------------------------------- settings of drained streams

def test_joins_keep_one_store_and_count_for_a_watcher_only(spark):
    from tidemart.streaming import joins as SJ
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before, counted = spark.conf.get(key, None), []

    def build(raw):
        counted.append(spark.conf.get(key))
        e = _from_json(raw, "k string, ms long")
        return SJ.interval_join(e.toDF("a", "a_ms"), e.toDF("b", "b_ms"), "a", "b", "a_ms", "b_ms", -10, 0)
    rows = spark.createDataFrame([("x", 100), ("x", 95), ("y", 100)], "k string, ms long")
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    out = R.replay_path(spark, [lines], build, "one-store")
    assert _rows(spark.read.parquet(out)) == [("x", 95, "x", 95), ("x", 100, "x", 95), ("x", 100, "x", 100), ("y", 100, "y", 100)]
    stores = os.listdir(os.path.join(os.path.dirname(out), "ckpt", "state", "0", "0"))
    assert not [s for s in stores if "keyToNumValues" in s or "keyWithIndexToValue" in s]
    R.replay_path(spark, [lines], build, "one-store", watch=lambda p: None)
    assert counted == ["false", "true"] and spark.conf.get(key, None) == before


# ---------------------------------------------------------------- many keys a call

EVENT = "mid string, ts long, offset long, is_new string"


def _timed(raw):
    return _from_json(raw, EVENT).withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "0 seconds")


def test_many_days_of_a_key_are_one_timer(plain):
    """Thirty days of one key in one micro-batch: one entry and one timer, not a timer a day."""
    rows = [("m", d * DAY, d, "1") for d in range(1, 31)]
    seen = []
    out = R.replay(plain, [_topic_of(plain, rows, EVENT)], lambda raw: J.P.apply(
        _timed(raw), ["mid"], J.P.FirstOfDay("ts", ["ts"], ["mid", "ts"], timers=True), "mid string, ts long", "EventTime", ""),
        "one-timer", no_data_batches=False, watch=lambda p: seen.append(_state_rows(p)))
    assert out.count() == 30 and seen[0] < 10, seen


def test_keys_of_one_group_stay_apart(plain, monkeypatch):
    """All keys, the missing one too, in one call and one state map: each has its own days, visit day and idle time."""
    monkeypatch.setattr(J.P, "GROUPS", 1)
    phases = [[("a", DAY + 5, 0, "1"), ("b", DAY + 7, 1, "0"), ("a", 2 * DAY, 2, "1"), (None, DAY + 9, 3, "1"), ("a", DAY + 6, 4, "1")],
              [("b", 2 * DAY + 1, 5, "1"), (None, 2 * DAY + 2, 6, "0"), ("a", 2 * DAY + 3, 7, "0"), ("c", 9 * DAY, 8, "1")],
              [("b", 12 * DAY, 9, "1"), ("c", 12 * DAY + 1, 10, "1")]]
    lines = [_topic_of(plain, p, EVENT) for p in phases]
    first = R.replay(plain, lines, lambda raw: J.P.apply(
        _timed(raw), ["mid"], J.P.FirstOfDay("ts", ["ts", "offset"], ["mid", "offset"], flag=True, timers=True),
        "mid string, offset long, first_flag long", "EventTime", ""), "group-first")
    assert sorted(r.offset for r in first.where("first_flag = 1").collect()) == [0, 1, 2, 3, 5, 6, 8, 9, 10]
    assert first.count() == 11
    fixed = R.replay(plain, lines, lambda raw: J.P.apply(
        _timed(raw), ["mid"], J.P.FixIsNew(["mid", "offset"], idle_ms=5 * DAY), "mid string, offset long, is_new string",
        "EventTime", ""), "group-fixed")
    # b's state is gone by day 12, c's is not
    assert {r.offset: r.is_new for r in fixed.collect()} == {0: "1", 1: "0", 2: "0", 3: "1", 4: "1", 5: "0", 6: "0", 7: "0",
                                                             8: "1", 9: "1", 10: "0"}
    back = R.replay(plain, lines, lambda raw: J.P.apply(
        _timed(raw.select("value")).withColumnRenamed("mid", "uid"), ["uid"], J.P.ReturningUser(3, 30 * DAY),
        "uid string, ts long, et timestamp, back long", "EventTime", "et"), "group-back")
    got = sorted((r.uid or "", r.ts // DAY, r.back) for r in back.collect())
    assert got == [("", 1, 0), ("", 2, 0), ("a", 1, 0), ("a", 2, 0), ("b", 1, 0), ("b", 2, 0), ("b", 12, 1), ("c", 9, 0), ("c", 12, 1)]


def _topic_of(spark, times):
    return spark.createDataFrame([(t, {"k": str(i)}, None) for i, t in enumerate(times)],
                                 "ts_ms long, after map<string,string>, before map<string,string>")


def test_a_long_topic_arrives_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(R, "ARRIVAL_RECORDS", 100)
    # most records lie early: halves of the time alone would be 990 and 10
    times = [*range(990), *range(100_000, 200_000, 10_000), None]
    topic = _topic_of(spark, times)
    parts, hi = R.arrivals(topic, "bounded")
    assert hi == 190_000 and topic.columns == parts[0].columns == ["ts_ms", "after", "before"]
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 1000 and max(sizes) <= 130
    ends = [p.agg(F.min("ts_ms"), F.max("ts_ms")).first() for p in parts]
    ends = [e for e in ends if e[0] is not None]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert sorted(r.after["k"] for p in parts for r in p.collect()) == sorted(str(i) for i in range(1000))


def test_arrivals_of_odd_topics(spark, monkeypatch):
    parts, hi = R.arrivals(_topic_of(spark, [5, 1, 9]), "halves")
    assert hi == 9 and [sorted(r.ts_ms for r in p.collect()) for p in parts] == [[1, 5], [9]]
    monkeypatch.setattr(R, "ARRIVAL_RECORDS", 2)
    assert sum(p.count() for p in R.arrivals(_topic_of(spark, [7] * 9), "one")[0]) == 9
    empty, hi = R.arrivals(_topic_of(spark, []), "empty")
    assert hi == 0 and sum(p.count() for p in empty) == 0


def test_a_stream_join_over_many_arrivals_holds_little(spark, monkeypatch):
    from tidemart.queries import REGISTRY, _dwd_stream, DETAIL_TABLES
    from tidemart.streaming import joins as SJ
    held = []
    plain = R.replay
    monkeypatch.setattr(R, "replay", lambda *a, **k: plain(*a, watch=lambda p: held.append(
        max(o["numRowsTotal"] for o in p["stateOperators"])), **k))
    monkeypatch.setattr(R, "ARRIVAL_RECORDS", 4000)
    monkeypatch.setattr(SJ, "BOUND_MS", 60_000)
    got = _dwd_stream(spark, SF, "dwd_order_detail", DETAIL_TABLES, lambda t: SJ.order_detail(t, bound_ms=60_000))
    want = REGISTRY["dwd_order_detail"](spark, SF)
    assert _text(got) == _text(want)
    # of some 12,000 records, at most a part's and those of a minute before it; at the end the heartbeats
    assert len(held) > 4 and max(held) < 2000 and held[-1] <= 4


def _text(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_label_topics_arrive_in_bounded_parts(spark, monkeypatch):
    from tidemart.queries import REGISTRY
    taken = []
    monkeypatch.setattr(R, "ARRIVAL_RECORDS", 1500)
    monkeypatch.setattr(R, "replay", lambda s, phases, *a: taken.extend(phases))
    REGISTRY["label_merge_stream"](spark, SF)
    sizes = [p.count() for p in taken]
    assert len(sizes) > 4 and max(sizes) < 2000 and sizes[-1] == 3
    assert all(p.columns == ["value"] for p in taken)


def test_a_batch_is_read_for_its_buckets_only_if_its_first_rows_leave_some_out(spark, monkeypatch):
    df = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("seq"), F.col("id").alias("v"))
    few = df.where("k in ('1', '2', '3')")
    plain, full = type(df).distinct, []
    monkeypatch.setattr(type(df), "distinct", lambda d: full.append("Limit" not in d._jdf.queryExecution().logical().toString()) or plain(d))
    table = R.UpsertTable(scratch_path(spark, f"probe-{uuid.uuid4().hex[:6]}"), ["k"], "seq", buckets=4)
    table.merge_batch(df, 0)
    assert full == [False]
    table.merge_batch(few.withColumn("seq", F.lit("2")).withColumn("v", -F.col("v")), 1)
    assert full[1:] == [False, True]
    table.merge_batch(few.where("k = '9'"), 2)
    assert table.version(spark) == 1 and sorted(r.v for r in table.read(spark).collect()) == sorted([0, -1, -2, -3, *range(4, 4000)])


def test_a_batch_is_parsed_and_shuffled_once(spark):
    from tidemart.operators import dims as D
    from tidemart.operators.envelope import cdc_gate
    from tidemart.queries import _records
    from tidemart.streaming import dimbuild as SB
    path = scratch_path(spark, f"lines-{uuid.uuid4().hex[:6]}")
    spark.createDataFrame([('{"source":{"db":"d"},"op":"r","after":{"k":"1"}}',), ("{",)], "value string").write.text(path)
    cfg = spark.createDataFrame([("a", "b", "c", "d", 1)], "source_table string, sink_table string, sink_columns string, sink_row_key string, epoch long")
    env = cdc_gate(_records(spark.read.text(path), "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms long, seq string"),
                   "d", accept_deletes=True)
    assert [r.after for r in env.collect()] == [{"k": "1"}]
    assert env._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = SB.fold(SB.cells(D.route(env, cfg, carry=["epoch"])))._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    own = [x for x in plan if "Exchange hashpartitioning(sink_table" in x]
    assert len(own) == 2 and sum("ReusedExchange" in x for x in own) == 1
