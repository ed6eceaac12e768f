"""Counter rules (CLN-12..15, CLN-17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the largest value an INT column holds.
INT_MAX = 2147483647


def negative_to_null(c: Column) -> Column:
    """CLN-13: counts must be >= 0; a negative count becomes NULL."""
    return F.when(c >= 0, c)


def cap_int(c: Column) -> Column:
    """CLN-14: cap at INT max (``least`` skips NULLs, so NULL is kept explicitly)."""
    return F.when(c.isNotNull(), F.least(c, F.lit(INT_MAX).cast("bigint")))


def was_capped(c: Column) -> Column:
    return F.coalesce(c > F.lit(INT_MAX), F.lit(False))


def missing_to_zero(c: Column) -> Column:
    """CLN-15."""
    return F.coalesce(c, F.lit(0).cast("bigint"))


def id_string(c: Column) -> Column:
    """CLN-12: identifiers are always strings."""
    return c.cast("string")


def clean_counter(c: Column) -> Column:
    """CLN-13 then CLN-14 (missing stays 0 from the mapper)."""
    return cap_int(negative_to_null(c))
