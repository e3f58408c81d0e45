"""Tumbling event-time windows over epoch-millis columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ms_to_date_str, ms_to_datetime_str, ms_to_wall

_UNITS = {"ms": 1, "millisecond": 1, "second": 1000, "sec": 1000, "s": 1000, "minute": 60_000, "min": 60_000,
          "hour": 3_600_000, "h": 3_600_000, "day": 86_400_000, "d": 86_400_000}


def width_ms(width) -> int:
    """'10 seconds' / '2 minutes' / 600000 -> millis."""
    if isinstance(width, int):
        return width
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", width)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad window width {width!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def window_start(ts_ms, width) -> Column:
    """Epoch-aligned tumbling window start in millis (same alignment as ``window()``)."""
    w = width_ms(width)
    t = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    return t - F.pmod(t, F.lit(w))


def label_columns(width, tz: str = "UTC", start: str = "wstart") -> list[Column]:
    """Stt / edt ('yyyy-MM-dd HH:mm:ss') and cur_date of a window start."""
    w = width_ms(width)
    s = F.col(start)
    return [ms_to_datetime_str(s, tz).alias("stt"), ms_to_datetime_str(s + w, tz).alias("edt"),
            ms_to_date_str(s, tz).alias("cur_date")]


def stream_window(df: DataFrame, ts_ms: str, width, tz: str = "UTC") -> Column:
    """Streaming form: Spark's ``window()`` on the wall-clock time column."""
    return F.window(ms_to_wall(F.col(ts_ms), tz), f"{width_ms(width)} milliseconds")
