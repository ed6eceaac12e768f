"""Date/time rules (DT-1..6, FIL-8) as column expressions.

Run times enter as parameters; nothing here calls ``now()``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedkiln.functions.variant import string_to_ts

EPOCH = "1970-01-01 00:00:00"


def parse_iso(s: Column) -> Column:
    """DT-1: ISO-8601 with ``Z``/``+00:00``/``+0000`` or naive (= UTC)."""
    return string_to_ts(s)


def iso_utc(ts: Column) -> Column:
    """ISO text with microseconds and ``Z`` (for envelopes)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def time_range_reason(ts: Column, lower: str, upper: str, field: str) -> Column:
    """FIL-8: ``before:<field>`` below ``lower``, ``after:<field>`` above
    ``upper`` (the run time), NULL inside; both bounds inclusive."""
    t = ts.cast("timestamp")
    return (F.when(t < F.lit(lower).cast("timestamp"), F.lit(f"before:{field}"))
            .when(t > F.lit(upper).cast("timestamp"), F.lit(f"after:{field}")))
