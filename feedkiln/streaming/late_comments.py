"""Comments that come before their posts (STR-5, JOIN-5): a stream-stream outer join.

Both sides have a watermark. A comment waits in the state store for a post of its
id whose time lies between ``before`` ahead of it and ``after`` behind it; once the
watermark has passed the end of that span, the comment is given out without a
post and belongs in the dead letter. Posts are kept as long as a comment may
still come for them. State is bounded by the two spans and the watermark's
delay, not by the length of the feed, and lies in the store by post id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkiln import schemas
from feedkiln.plans import jobs
from feedkiln.streaming import file_stream


def with_posts(comments: DataFrame, posts: DataFrame, before: str = "30 days", after: str = "7 days", delay: str = "10 minutes",
               post: str = "post_id", ts: str = "created_time") -> DataFrame:
    """The comments (all columns) with ``post_time``, NULL for those whose post did
    not come. Works on two streams and, with the same result, on two tables.
    ``delay`` is how far a row may lag behind the newest one of its side; later
    rows are lost, so it must span what the feed shuffles. Repeated posts repeat
    their comments: pass posts that are unique by id."""
    c, p = comments, posts.select(F.col(post).alias("_post"), F.col(ts).alias("post_time"))
    if comments.isStreaming:
        c, p = c.withWatermark(ts, delay), p.withWatermark("post_time", delay)
    near = F.expr(f"post_time >= {ts} - interval {before} and post_time <= {ts} + interval {after}")
    return c.join(p, (F.col(post) == F.col("_post")) & near, "left_outer").drop("_post")


def orphan_sink(wh: jobs.Warehouse, run_ts: str, platform: str = "facebook"):
    """Sink of ``with_posts`` over canonical comments: those with a post are merged
    into the comments, the others go to the dead letter. A replayed micro-batch
    writes the same rows again."""
    columns = schemas.columns(schemas.COMMENTS)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            wh.comments().upsert(rows.filter("post_time is not null").select(*columns), newest=["ingested_at", "raw_blob_path"])
            lost = rows.filter("post_time is null").select(*columns)
            wh.append_run("rejected_records", jobs.orphan_rows(lost, platform, run_ts), f"late-{batch_id}")
        finally:
            rows.unpersist()
    return sink


def load_late(spark: SparkSession, comments: DataFrame, posts: DataFrame, wh: jobs.Warehouse, run_ts: str, **spans: str) -> None:
    """One scheduled load of both streams; waiting comments stay in the state of
    the checkpoint for the next one."""
    file_stream.run_available_now(with_posts(comments, posts, **spans), orphan_sink(wh, run_ts), "late", spark, checkpoint=f"{wh.root}/late_history")
