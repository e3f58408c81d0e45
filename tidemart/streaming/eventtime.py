"""Event-time policies of the sources (S3, T1-T4): which time a record has, and how far records may be out of order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EventTime:
    """The event time ``et`` of a topic's records and its watermark.

    ``path``: JSON paths into ``value``; the first that is there and is a number of millis counts (T2, T4). Without any
    of them, and for a record that is no JSON, the time is 1970 (0 millis), as in the reference: such a record is late
    everywhere but at the start. ``metadata`` names the source's own time column instead (S3). For a window a record is
    late when it lies more than ``delay_ms`` before the newest one seen in earlier micro-batches; a keyed processor drops
    one that lies exactly so far back, too."""

    path: tuple[str, ...] = ()
    metadata: str | None = None
    delay_ms: int = 0

    def column(self, value: str = "value") -> Column:
        if self.metadata:
            return F.col(self.metadata)
        found = [F.get_json_object(F.col(value), p).try_cast("bigint") for p in self.path]
        return F.timestamp_millis(F.coalesce(*found, F.lit(0).cast("bigint")))

    def apply(self, raw: DataFrame, value: str = "value", et: str = "et") -> DataFrame:
        return raw.withColumn(et, self.column(value)).withWatermark(et, f"{self.delay_ms} milliseconds")


#: Ascending times.
ASCENDING = EventTime(("$.ts_ms",))
#: The label sources, 3 s.
LABEL_SOURCE = EventTime(("$.ts_ms",), delay_ms=3_000)
#: A stream that two others were joined into, 5 s.
JOINED = EventTime(("$.ts_ms",), delay_ms=5_000)
#: The keyword job takes the time that the broker gave a record, 3 s.
RECORD_TIME = EventTime(metadata="timestamp", delay_ms=3_000)
#: T4: first of ts_ms, ts.
FIRST_PRESENT = EventTime(("$.ts_ms", "$.ts"), delay_ms=3_000)
