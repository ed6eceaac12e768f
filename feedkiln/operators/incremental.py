"""Incremental state and change detection (JOIN-1, JOIN-2, JOIN-4, FIL-2..6,
SET-1, SET-4, STR-1, STR-2, STR-4, STR-6).

State is a table keyed ``(page_id, post_id)`` holding the last seen counters.
A run joins the fresh snapshot to it once (both sides shuffled on the key, or
the smaller one broadcast by AQE), emits new and changed rows, and commits the
next state version only after every output is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkiln import schemas
from feedkiln.functions import variant as V

# Overlap buffer and the counters compared for change detection.
OVERLAP_BUFFER_MINUTES = 10
STATE_COUNTERS = ("comment_count", *schemas.REACTION_COLUMNS)
EPOCH = "1970-01-01 00:00:00"


def buffered_since(last_loaded_at: Column, minutes: int = OVERLAP_BUFFER_MINUTES) -> Column:
    """FIL-3: ``last - minutes``; NULL stays NULL (first run)."""
    return last_loaded_at - F.make_dt_interval(mins=F.lit(minutes))


def since_filter(df: DataFrame, ts: str, since: Column | str | None) -> DataFrame:
    """FIL-2: keep ``coalesce(ts, epoch) >= since`` (inclusive); NULL ``since`` keeps all."""
    if since is None:
        return df
    s = F.lit(since).cast("timestamp") if isinstance(since, str) else since
    return df.filter(s.isNull() | at_or_after(df, ts, s))


def at_or_after(df: DataFrame, ts: str, bound: Column) -> Column:
    """``coalesce(ts, epoch) >= bound`` as a comparison of the bare column, which
    reaches the scan; the epoch matters only for a bound that is not after it."""
    kind = df.schema[ts].dataType.simpleString()
    kind, t = (kind, F.col(ts)) if kind.startswith("timestamp") else ("timestamp", F.col(ts).cast("timestamp"))
    return (t >= bound.cast(kind)) | (t.isNull() & (bound <= F.lit(EPOCH).cast("timestamp")))


def active_window(df: DataFrame, ts: str, run_ts: str, days: int | None) -> DataFrame:
    """FIL-4 / STR-4 (batch): ``ts >= run_ts - days``; unset keeps all; an
    unparseable time counts as the epoch and drops out."""
    if days is None:
        return df
    return df.filter(at_or_after(df, ts, F.lit(run_ts).cast("timestamp") - F.make_dt_interval(days=F.lit(days))))


def page_subset(df: DataFrame, page_col: str, pages: list[str]) -> DataFrame:
    """FIL-6: rows of the listed pages, a literal ``isin`` (bounded by what the
    user listed). A list without any page is an error."""
    wanted = [page.strip() for page in pages if page.strip()]
    if not wanted:
        raise ValueError("page id list is empty")
    return df.filter(F.col(page_col).isin(wanted))


def split_new_known(snapshot: DataFrame, state: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """JOIN-2: (rows not in state, rows in state)."""
    k = state.select(*keys)
    return snapshot.join(k, keys, "left_anti"), snapshot.join(k, keys, "left_semi")


def counters_differ(counters: list[str], left: str = "_old_", right: str = "") -> Column:
    """Any counter differs, a missing counter read as 0 (JOIN-1)."""
    diffs = [~(F.coalesce(F.col(f"{left}{c}"), F.lit(0)) == F.coalesce(F.col(f"{right}{c}"), F.lit(0)))
             for c in counters]
    return reduce(lambda a, b: a | b, diffs)


def changed_rows(snapshot: DataFrame, state: DataFrame, keys: list[str],
                 counters: list[str] = list(STATE_COUNTERS)) -> DataFrame:
    """JOIN-1: snapshot rows of known keys whose counters changed."""
    old = state.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in counters])
    j = snapshot.join(old, keys, "inner")
    return j.filter(counters_differ(counters)).drop(*[f"_old_{c}" for c in counters])


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """SET-4: ``status`` new / changed / unchanged / removed per key.

    A 64-bit row hash decides quickly; equal hashes are confirmed column by
    column, so a hash collision cannot hide a change.
    """
    h = lambda: F.xxhash64(*[F.col(c) for c in compare])
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in compare], h().alias("_oh"), F.lit(True).alias("_in_old"))
    n = new.select(*keys, *compare, h().alias("_nh"), F.lit(True).alias("_in_new"))
    j = o.join(n, keys, "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"_o_{c}").eqNullSafe(F.col(c)) for c in compare])
    status = (F.when(F.col("_in_old").isNull(), F.lit("new"))
              .when(F.col("_in_new").isNull(), F.lit("removed"))
              .when((F.col("_oh") == F.col("_nh")) & same, F.lit("unchanged"))
              .otherwise(F.lit("changed")))
    return j.select(*keys, *compare, status.alias("status"))


def first_seen_ids(records: DataFrame, id_col: str, order_cols: list[str],
                   exclude: DataFrame | None = None) -> DataFrame:
    """SET-1 + JOIN-4: distinct ids with their first occurrence (by
    ``order_cols``), minus an exclude set. The minimum is a partial aggregate."""
    first = records.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min(F.struct(*order_cols)).alias("_first"))
    if exclude is not None:
        first = first.join(exclude.select(id_col), id_col, "left_anti")
    return first.select(id_col, *[F.col(f"_first.{c}").alias(f"first_{c}") for c in order_cols])


def refresh_posts(snapshot: DataFrame, state: DataFrame, last_loaded_at: Column, run_ts: str, window_days: int | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """JOB-2's two tracks: (``fresh``, ``known``). ``fresh`` are the posts at or
    after the buffered bound, whether the state knows them or not; ``known`` are
    the posts of the state inside the active window, and none on a first run
    (``last_loaded_at`` NULL), when every post is fresh."""
    fresh = since_filter(snapshot, "created_time", buffered_since(last_loaded_at))
    return fresh, active_window(state, "created_time", run_ts, window_days).filter(last_loaded_at.isNotNull())


def comment_bounds(fresh: DataFrame, known: DataFrame, last_loaded_at: Column, post: str = "post_id") -> DataFrame:
    """One row per post whose comments are read again: ``since`` is NULL (all of
    them) for a fresh post and ten minutes before the last load for a known one;
    a post that is both is fresh."""
    rows = fresh.select(post, F.lit(True).alias("_all")).unionByName(known.select(post, F.lit(False).alias("_all")))
    return rows.groupBy(post).agg(F.max("_all").alias("_all")).select(
        post, F.when(~F.col("_all"), buffered_since(last_loaded_at)).alias("since"))


def comments_to_refresh(comments: DataFrame, bounds: DataFrame, post: str = "post_id", ts: str = "created_time") -> DataFrame:
    """FIL-2 per post: the comments at or after their post's bound (inclusive; a
    time that can't be read counts as the epoch), with that bound as ``since``.
    Posts without a bound are left alone, also if they have new comments. AQE
    sends the bounds to the comments' tasks while they are small, and splits a
    post that has gathered most comments otherwise."""
    lower = bounds.select(F.col(post).alias("_post"), "since")
    return (comments.join(lower, F.col(post) == F.col("_post")).drop("_post")
            .filter(F.col("since").isNull() | at_or_after(comments, ts, F.col("since"))))


def state_from_snapshot(snapshot: DataFrame) -> DataFrame:
    """Rows of the state table from canonical posts."""
    return snapshot.select(*schemas.columns(schemas.STATE))


def next_state(state: DataFrame, new_posts: DataFrame, changed: DataFrame,
               run_ts: str, window_days: int | None) -> DataFrame:
    """SET-2 + STR-2: previous state overlaid with new and changed posts, pruned
    to the active window (on event time)."""
    from feedkiln.operators.dedup import overlay

    upd = state_from_snapshot(new_posts).unionByName(state_from_snapshot(changed))
    nxt = overlay(state, upd, ["page_id", "post_id"])
    return active_window(nxt, "created_time", run_ts, window_days)


def migrate_state_json(raw: DataFrame, col: str = "state_json") -> DataFrame:
    """JS-3 / STR-6: a JSON checkpoint ``{last_loaded_at, known_posts:{page:{post: value}}}``
    to state rows. A legacy value is a plain created-time string and becomes
    an entry with zero counters."""
    v = F.try_parse_json(F.col(col))
    pages = F.try_variant_get(v, "$.known_posts", "map<string, map<string, variant>>")
    by_page = raw.select(F.try_variant_get(v, "$.last_loaded_at", "string").alias("last_loaded_at"),
                         F.explode(pages).alias("page_id", "_posts"))
    rows = by_page.select("last_loaded_at", "page_id", F.explode("_posts").alias("post_id", "_v"))
    sc = V.Scope()
    legacy = sc.kind("_v", "$") == "STRING"
    created = F.when(legacy, sc.get("_v", "$", "string")).otherwise(sc.get("_v", "$.created_time", "string"))
    cnt = lambda c: F.when(legacy, F.lit(0).cast("bigint")).otherwise(
        F.coalesce(V.long_field(sc, "_v", f"$.{c}", c)[0], F.lit(0).cast("bigint")))
    counters = [cnt(c).alias(c) for c in STATE_COUNTERS]  # registers helpers before apply
    return sc.apply(rows).select(V.string_to_ts(F.col("last_loaded_at")).alias("last_loaded_at"),
                                 "page_id", "post_id", V.string_to_ts(created).alias("created_time"),
                                 *counters)


def post_ids_since(envelopes: DataFrame, since: str, exclude: DataFrame | None = None) -> DataFrame:
    """SET-1 + FIL-5 + JOIN-4 + SRT-1: distinct post ids from landed post
    envelopes whose ``meta.run_timestamp`` (naive = UTC, missing -> file
    skipped) is at or after ``since``, minus ``exclude``, with the position of
    the first occurrence in path order (``first_path``, ``first_pos``)."""
    run = V.string_to_ts(F.try_variant_get(F.col("meta"), "$.run_timestamp", "string"))
    files = envelopes.filter(F.col("file_error").isNull() & run.isNotNull() &
                             (run >= F.lit(since).cast("timestamp")))
    recs = files.select("path", F.posexplode("records").alias("pos", "record"))
    ids = recs.select(F.try_variant_get("record", "$.id", "string").alias("post_id"), "path", "pos")
    ids = ids.filter(F.col("post_id").isNotNull() & (F.length("post_id") > 0))
    return first_seen_ids(ids, "post_id", ["path", "pos"], exclude)


def exclude_moderated(df: DataFrame, status: str = "moderation_status",
                      excluded: tuple = ("rejected", "heldForReview")) -> DataFrame:
    """FIL-11: drop rows held or rejected by moderation (NULL status stays)."""
    return df.filter(F.col(status).isNull() | ~F.col(status).isin(*excluded))


def needs_reprocess(df: DataFrame, current_version: str, version: str = "cleaning_version") -> DataFrame:
    """FIL-13: rows cleaned by an older (or no) rule version."""
    return df.filter(F.col(version).isNull() | (F.col(version) != F.lit(current_version)))
