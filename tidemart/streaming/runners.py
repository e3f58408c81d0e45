"""Sources, sinks and runners for Structured Streaming.

Kafka is the production transport (no connector jar in the test image, so its
readers/writers are option-level only); file streams of JSON lines stand in
for topics in tests. Every stream writes through a checkpoint in the shared
folder named by ``spark.checkpoint.dir`` so a restarted query resumes exactly
where it stopped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import scratch_path


#: What every stream of this library runs under, whatever its session says: keyed state with several variables and
#: timers needs the RocksDB store, and times cross the state processors as wall clocks of the session's zone. A join keeps
#: its state in one store a partition (version 3), not in four.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.session.timeZone": "UTC",
}


@contextmanager
def stream_conf(spark: SparkSession, **more: str) -> Iterator[None]:
    """Build and start a stream inside: a query keeps the settings it was started with, the session gets its own back."""
    conf = {**STREAM_CONF, **more}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _drain_conf(no_data_batches: bool, counted: bool = False) -> dict[str, str]:
    """Settings of a stream that is drained. Rows in its state are ``counted`` only for one who looks: counting costs a
    look-up with every write to the state. A drained stream resumes from its last batch, so older versions of its state
    are not kept."""
    return {"spark.sql.streaming.noDataMicroBatches.enabled": str(no_data_batches).lower(),
            "spark.sql.streaming.minBatchesToRetain": "2",
            "spark.sql.streaming.stateStore.maintenanceInterval": "15s",
            "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": str(counted).lower()}


# ------------------------------------------------------------------ sources

def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 extra: dict | None = None) -> DataFrame:
    """Topic -> (value string, timestamp, partition, offset); earliest offsets."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
         .option("startingOffsets", starting))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")


def file_topic(spark: SparkSession, path: str, schema: str = "offset long, value string",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines folder as a topic stand-in (one record per line)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def stamped_file_topic(spark: SparkSession, path: str) -> DataFrame:
    """S3: a folder of lines as a topic, each with the ``timestamp`` at which its file was written."""
    return spark.readStream.text(path).select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


# ------------------------------------------------------------------ sinks (K1-K5)

def to_value(df: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """K1/K3/K4 serializer: row -> JSON ``value`` (nulls omitted), optional JSON ``key``."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key_cols:
        cols.insert(0, F.to_json(F.struct(*[F.col(c) for c in key_cols])).alias("key"))
    return df.select(*cols)


def topic_frame(df: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """K2 frame: (topic, [key,] value); every other column goes into ``value``, null ones are omitted."""
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != "topic"])).alias("value")
    key = [F.to_json(F.struct(*[F.col(c) for c in key_cols])).alias("key")] if key_cols else []
    return df.select("topic", *key, body)


def kafka_sink(df: DataFrame, servers: str, topic: str | None, checkpoint: str, key_cols: list[str] | None = None):
    """K1/K2/K4: stream -> topic; ``topic=None`` routes by a ``topic`` column (K2)."""
    out = topic_frame(df, key_cols) if topic is None else to_value(df, key_cols)
    w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("checkpointLocation", checkpoint))
    if topic is not None:
        w = w.option("topic", topic)
    with stream_conf(df.sparkSession):
        return w.start()


#: Records in one file of a topic folder. Compressed files can't be split, so that this bounds what one task reads.
FILE_RECORDS = 250_000


def topic_files(df: DataFrame):
    """Writer of a topic's folder: text compresses to a tenth or less, in files that can be read side by side."""
    return df.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)


def write_jsonl(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """K1/K2 file stand-in (batch): one record per line, optionally one folder
    per topic. A frame of just ``value`` (already serialised) is written as is."""
    w = topic_files(df).mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    if [c for c in df.columns if c != partition_by] == ["value"]:
        w.text(path)
    else:
        w.json(path)


def run_available_now(stream: DataFrame, name: str, fmt: str = "parquet", mode: str = "append",
                      no_data_batches: bool = True) -> DataFrame:
    """Drain a stream once (trigger availableNow) into ``fmt`` files in the shared
    folder and return them as a batch DataFrame. A stream with processing-time state ends only without
    ``no_data_batches``."""
    spark = stream.sparkSession
    base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    with stream_conf(spark, **_drain_conf(no_data_batches)):
        q = (stream.writeStream.format(fmt).outputMode(mode).option("path", os.path.join(base, "out"))
             .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.format(fmt).load(os.path.join(base, "out"))


#: Records of one arrival of a replayed topic. What a stream holds before its watermark moves is an arrival's records and
#: those within its bounds, however long the topic is.
ARRIVAL_RECORDS = 3_000_000
#: Steps of the quantiles at which a topic is cut.
CUTS = 1000


def _place(ts: Column, cuts: list[int], first: int = 0) -> Column:
    """Number of the ``cuts`` (ascending) below ``ts``, by halving."""
    if not cuts:
        return F.lit(first)
    m = len(cuts) // 2
    return F.when(ts <= cuts[m], _place(ts, cuts[:m], first)).otherwise(_place(ts, cuts[m + 1:], first + m + 1))


def arrivals(topic: DataFrame, name: str, ts: str = "ts_ms") -> tuple[list[DataFrame], int]:
    """A topic as it arrives: its two halves by record time, each in as many parts, by record time too, as keep a part
    near ``ARRIVAL_RECORDS``; and its last record time. The topic is derived once and lies in the shared folder by part.
    Records without a time don't arrive."""
    spark = topic.sparkSession
    at = F.col(ts)
    steps = ",".join(f"{i / CUTS}D" for i in range(1, CUTS))
    lo, hi, n, marks = topic.agg(F.min(at), F.max(at), F.count(at), F.expr(f"percentile_approx({ts}, array({steps}))")).first()
    lo, hi = lo or 0, hi or 0
    parts = min(-(-n // ARRIVAL_RECORDS), CUTS)
    cuts = sorted({(lo + hi) // 2, *(marks[i * CUTS // parts - 1] for i in range(1, parts))})
    path = scratch_path(spark, f"{name}-parts-{uuid.uuid4().hex[:8]}")
    (topic.where(at.isNotNull()).withColumn("_part", _place(at, cuts))
     .write.partitionBy("_part").parquet(path))
    whole = spark.read.schema(StructType([*topic.schema.fields, StructField("_part", IntegerType())])).parquet(path)
    return [whole.where(F.col("_part") == i).drop("_part") for i in range(len(cuts) + 1)], hi


def replay_path(spark: SparkSession, phases: list[DataFrame], build: Callable[[DataFrame], DataFrame], name: str,
                sink: Callable[[str], Callable[[DataFrame, int], None]] | None = None,
                no_data_batches: bool = True, before: Callable[[int], None] | None = None,
                watch: Callable[[dict], None] | None = None) -> str:
    """Drain a topic that arrives in ``phases`` (frames of one text column ``value``): each is appended to the
    topic's folder by as many tasks as it has, then the query resumes from its checkpoint and takes it as one
    micro-batch. State and watermarks live across the restarts. Rows go to Parquet, or to the foreachBatch body that
    ``sink`` makes for the output folder, which is returned. Without ``no_data_batches`` a watermark or a
    processing-time timer acts on the next phase only, and a query in processing time ends with its data. ``before``
    is called ahead of each phase with its number, ``watch`` gets the last progress of each."""
    base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    topic, out = os.path.join(base, "topic"), os.path.join(base, "out")
    more = _drain_conf(no_data_batches, counted=watch is not None)
    for i, part in enumerate(phases):
        if before:
            before(i)
        topic_files(part).text(os.path.join(topic, f"p{i:03d}"))
        with stream_conf(spark, **more):
            w = (build(spark.readStream.text(os.path.join(topic, "*"))).writeStream.outputMode("append")
                 .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True))
            w = w.foreachBatch(sink(out)) if sink else w.format("parquet").option("path", out)
            q = w.start()
        q.awaitTermination()
        if watch:
            watch(q.lastProgress)
    return out


def replay(spark: SparkSession, phases: list[DataFrame], build: Callable[[DataFrame], DataFrame], name: str,
           **how) -> DataFrame:
    """``replay_path`` into Parquet; the stream's rows as a batch frame."""
    return spark.read.parquet(replay_path(spark, phases, build, name, **how))


def complete_versions(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the folders v<n> below ``base`` whose write has ended."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    done = []
    for st in fs.listStatus(fs_path(base)) if fs.exists(fs_path(base)) else []:
        n = st.getPath().getName()
        if n.startswith("v") and fs.exists(fs_path(st.getPath(), "_SUCCESS")):
            done.append(int(n[1:]))
    return done


class UpsertTable:
    """K4/K6 stream sink without a lake-table library: rows lie in hash buckets of their keys; a micro-batch merges
    (last row per key by ``seq``) and rewrites only the buckets it touches, into ``data/v<batch_id>``, and then
    writes ``manifest/v<batch_id>``, which names the version of every bucket. A retried batch rewrites the same
    version, so the sink is idempotent; readers take the highest manifest with a _SUCCESS marker. Versions that no
    manifest names any more are left to the folder's owner to remove."""

    #: Rows looked at for each bucket before a batch is read for those it touches.
    PROBE = 64

    def __init__(self, path: str, keys: list[str], seq: str, buckets: int = 16):
        self.path, self.keys, self.seq, self.buckets = path, keys, seq, buckets

    def _manifest(self, spark: SparkSession, below: int | None = None) -> dict[int, int]:
        """Bucket -> version of the last complete batch (before ``below``); at most ``buckets`` rows."""
        done = [v for v in complete_versions(spark, os.path.join(self.path, "manifest")) if below is None or v < below]
        if not done:
            return {}
        rows = spark.read.parquet(os.path.join(self.path, "manifest", f"v{max(done)}")).collect()
        return {r.bucket: r.version for r in rows}

    def _rows(self, spark: SparkSession, manifest: dict[int, int]) -> DataFrame | None:
        paths = [os.path.join(self.path, "data", f"v{v}", f"bucket={b}") for b, v in sorted(manifest.items())]
        return spark.read.parquet(*paths) if paths else None

    def version(self, spark: SparkSession) -> int | None:
        """The last complete batch."""
        return max(complete_versions(spark, os.path.join(self.path, "manifest")), default=None)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The rows as of a version, the last one by default; none before the first."""
        return self._rows(spark, self._manifest(spark, None if version is None else version + 1))

    def merge_batch(self, batch: DataFrame, batch_id: int, fold: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """``fold`` makes one row of the rows of a key, old and new, where that isn't the last one. Rows are shuffled
        once, the old ones of the touched buckets with the batch's. That is not held; it is read a second time, for the
        buckets it touches, only where its first rows leave some out."""
        from ..operators.dedup import latest_per_key
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        of = batch.select(bucket.alias("bucket"))
        touched = [r[0] for r in of.limit(self.buckets * self.PROBE).distinct().collect()]
        if 0 < len(touched) < self.buckets:
            touched = [r[0] for r in of.distinct().collect()]
        if not touched:
            return
        manifest = self._manifest(spark, batch_id)
        old = self._rows(spark, {b: manifest[b] for b in touched if b in manifest})
        rows = batch if old is None else old.select(*batch.columns).unionByName(batch)
        cur = fold(rows) if fold else latest_per_key(rows, self.keys, [self.seq])
        (cur.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket")
         .parquet(os.path.join(self.path, "data", f"v{batch_id}")))
        manifest.update(dict.fromkeys(touched, batch_id))
        (spark.createDataFrame(sorted(manifest.items()), "bucket int, version long").coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(self.path, "manifest", f"v{batch_id}")))

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True):
        w = stream.writeStream.foreachBatch(self.merge_batch).option("checkpointLocation", checkpoint)
        if available_now:
            w = w.trigger(availableNow=True)
        with stream_conf(stream.sparkSession):
            return w.start()


class Pinned:
    """The static side of a stream-static join (J4, J13): an ``UpsertTable`` that another stream keeps, read anew for
    every micro-batch. The version that a batch saw first is noted below ``path``, so that a retry of the batch sees the
    same one, whatever has been merged since."""

    def __init__(self, table: UpsertTable, path: str):
        self.table, self.path = table, path

    def version(self, spark: SparkSession, batch_id: int) -> int:
        """-1 where the table had no version yet."""
        at = os.path.join(self.path, f"v{batch_id}")
        if batch_id not in complete_versions(spark, self.path):
            now = self.table.version(spark)
            (spark.createDataFrame([(-1 if now is None else now,)], "version long").coalesce(1)
             .write.mode("overwrite").parquet(at))
        return spark.read.parquet(at).first()[0]

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        version = self.version(spark, batch_id)
        return None if version < 0 else self.table.read(spark, version)


def olap_sink(stream: DataFrame, url: str, table: str, checkpoint: str, properties: dict | None = None,
              processing_time: str = "10 seconds"):
    """K5: windowed results appended to an OLAP table per micro-batch over JDBC, at least once: a replayed batch is
    inserted again. Every row carries its ``batch_id``, so that the table drops the copies, by a merging key over
    (window, dimensions) or by deleting the batch's rows before a restart."""
    props = dict(properties or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").jdbc(url, table, properties=props)

    with stream_conf(stream.sparkSession):
        return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                .trigger(processingTime=processing_time).start())
