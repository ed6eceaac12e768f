"""Quality flags with time-bounded windows (WIN-2, WIN-3, JS-6..8, JOIN-9).

A time-range window partitioned only by its key would put a hot key (a viral
post, a bot) into one task. ``range_count`` splits every key by event-time
bucket and copies each row into the few neighbouring buckets whose frames can
reach it, so a partition is ``(key, bucket)`` and the frame is still exact.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkiln.functions import text as TX

# Flag windows and thresholds.
SPAM_WINDOW_SECONDS = 24 * 3600
BOT_WINDOW_SECONDS = 3600
BOT_THRESHOLD = 50
_MICROS = 1_000_000


def epoch_micros(ts: Column) -> Column:
    """Event time as microseconds; TIMESTAMP_NTZ is read as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def range_count(df: DataFrame, keys: list[str], ts: str, preceding_s: int, following_s: int,
                bucket_s: int | None = None, out: str = "range_count") -> DataFrame:
    """Add ``out`` = number of rows with the same ``keys`` whose time lies in
    ``[ts - preceding_s, ts + following_s]`` (both ends inclusive, the row
    itself included)."""
    w = int(bucket_s or max(preceding_s, following_s, 1))
    back, ahead = math.ceil(following_s / w), math.ceil(preceding_s / w)
    t = epoch_micros(F.col(ts))
    base = df.withColumn("_t", t).withColumn("_b", F.floor(F.col("_t") / F.lit(w * _MICROS)).cast("long"))
    # a row in bucket c is visible from home buckets c-back .. c+ahead
    shifts = F.sequence(F.lit(-back), F.lit(ahead))
    spread = base.withColumn("_d", F.explode(shifts)).withColumn("_home", F.col("_b") + F.col("_d"))
    win = (Window.partitionBy(*keys, "_home").orderBy("_t")
           .rangeBetween(-preceding_s * _MICROS, following_s * _MICROS))
    counted = spread.withColumn(out, F.count(F.lit(1)).over(win))
    return counted.filter(F.col("_d") == 0).drop("_t", "_b", "_d", "_home")


def has_neighbour(df: DataFrame, keys: list[str], ts: str, window_s: int, out: str) -> DataFrame:
    """``out`` = another row with the same ``keys`` lies within +-``window_s``
    (inclusive) of this row's time.

    Exact from per-(key, bucket) aggregates with bucket width ``window_s``: a
    row that shares its bucket has a neighbour closer than ``window_s``; a row
    alone in its bucket only needs the previous bucket's latest time and the
    next bucket's earliest time. The aggregates are partial (a hot key is
    pre-combined per task); rows are shuffled once, for the join back, which
    AQE splits when a (key, bucket) is hot.
    """
    w = window_s * _MICROS
    base = df.withColumn("_t", epoch_micros(F.col(ts))).withColumn("_b", F.floor(F.col("_t") / F.lit(w)).cast("long"))
    agg = base.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_lo"),
                                        F.max("_t").alias("_hi"))
    prev = agg.select(*keys, (F.col("_b") + 1).alias("_b"), F.col("_hi").alias("_prev_hi"))
    nxt = agg.select(*keys, (F.col("_b") - 1).alias("_b"), F.col("_lo").alias("_next_lo"))
    info = (agg.select(*keys, "_b", "_n").join(prev, [*keys, "_b"], "left").join(nxt, [*keys, "_b"], "left"))
    j = base.join(info, [*keys, "_b"], "left")
    flag = ((F.col("_n") > 1) | (F.col("_prev_hi") >= F.col("_t") - F.lit(w)) |
            (F.col("_next_lo") <= F.col("_t") + F.lit(w)))
    return j.withColumn(out, F.coalesce(flag, F.lit(False))).drop("_t", "_b", "_n", "_prev_hi", "_next_lo")


def spam_suspected(df: DataFrame, post: str, text: str, ts: str,
                   window_s: int = SPAM_WINDOW_SECONDS, out: str = "spam_suspected") -> DataFrame:
    """WIN-2: another row with the same post and the same cleaned text within
    +-``window_s`` (inclusive). Rows without text are never flagged and are
    kept out of the windows."""
    with_text = df.filter(F.col(text).isNotNull())
    no_text = df.filter(F.col(text).isNull())
    flagged = has_neighbour(with_text, [post, text], ts, window_s, out)
    return flagged.unionByName(no_text.withColumn(out, F.lit(False)))


def trailing_count(df: DataFrame, keys: list[str], ts: str, window_s: int = BOT_WINDOW_SECONDS,
                   out: str = "trailing_count") -> DataFrame:
    """Rows of the same key in ``[ts - window_s, ts]``, whatever the key holds.

    Rows of one key and time are counted first. The rows up to a time are then the
    sum of three running counts, over the days of the key, the seconds of the
    day and the microseconds of the second, none of which can hold more than
    its calendar has; the trailing count is the difference of two such sums.
    """
    t, width = "_t", window_s * _MICROS
    base = df.withColumn(t, epoch_micros(F.col(ts)))
    per = base.groupBy(*keys, t).agg(F.count(F.lit(1)).alias("_n"))
    points = per.select(*keys, F.col(t).alias("_at"), "_n", F.col(t).alias("_of"), F.lit(1).alias("_sign")).unionByName(
        per.select(*keys, (F.col(t) - (width + 1)).alias("_at"), F.lit(0).cast("long").alias("_n"), F.col(t).alias("_of"), F.lit(-1).alias("_sign")))
    points = (points.withColumn("_second", F.floor(F.col("_at") / _MICROS).cast("long"))
              .withColumn("_day", F.floor(F.col("_second") / 86400).cast("long")))
    in_second = F.sum("_n").over(Window.partitionBy(*keys, "_second").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0))
    seconds = points.groupBy(*keys, "_day", "_second").agg(F.sum("_n").alias("_n")).select(
        *keys, "_day", "_second", "_n",
        F.sum("_n").over(Window.partitionBy(*keys, "_day").orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)).alias("_before_second"))
    days = seconds.groupBy(*keys, "_day").agg(F.sum("_n").alias("_n")).select(
        *keys, "_day", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)).alias("_before_day"))
    joined = _left_join(points.withColumn("_in_second", in_second), seconds.drop("_n"), [*keys, "_day", "_second"])
    joined = _left_join(joined, days, [*keys, "_day"])
    up_to = F.col("_in_second") + F.coalesce("_before_second", F.lit(0)) + F.coalesce("_before_day", F.lit(0))
    counts = joined.groupBy(*keys, "_of").agg(F.sum(up_to * F.col("_sign")).alias(out)).withColumnRenamed("_of", t)
    return _left_join(base, counts, [*keys, t]).drop(t)


def _left_join(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Left join on ``cols``, where NULL equals NULL."""
    named = right.select(*[F.col(c).alias(f"_j_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_j_{c}")) for c in cols])
    return left.join(named, on, "left").drop(*[f"_j_{c}" for c in cols])


def bot_suspected(df: DataFrame, keys: list[str], ts: str, window_s: int = BOT_WINDOW_SECONDS,
                  threshold: int = BOT_THRESHOLD, out: str = "bot_suspected") -> DataFrame:
    """WIN-3: every row of a key whose trailing ``window_s`` count ever exceeds
    ``threshold``. The per-key maximum is a partial aggregate; joining it back
    is a key join that AQE splits when one key is hot."""
    counted = trailing_count(df, keys, ts, window_s, out="trailing_count")
    peak = counted.groupBy(*keys).agg(F.max("trailing_count").alias("_peak"))
    return (counted.join(peak, keys, "inner")
            .withColumn(out, F.col("_peak") > F.lit(threshold)).drop("_peak"))


def modal_value(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Most frequent ``value`` per group; ties go to the smallest value."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*group).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def foreign_language(df: DataFrame, page_dim: DataFrame, page: str, lang: str, page_lang: str,
                     out: str = "foreign_language") -> DataFrame:
    """JS-8 + JOIN-9: detected language differs from the page's language.

    The page dimension is one row per page; AQE broadcasts it when its runtime
    size is under the broadcast threshold and shuffles otherwise.
    """
    j = df.join(page_dim.select(page, page_lang), page, "left")
    return j.withColumn(out, F.coalesce(F.col(lang) != F.col(page_lang), F.lit(False)))


def text_flags(cleaned: Column) -> dict[str, Column]:
    """JS-7 row-local flags."""
    return {
        "too_short": TX.too_short(cleaned),
        "url_only": TX.url_only(cleaned),
        "high_emoji_ratio": TX.high_emoji_ratio(cleaned),
    }
