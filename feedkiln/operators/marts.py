"""Model layers and marts (SNK-7, JOIN-8, AGG-13, SET-3, PRJ-16..19).

Staging and mart layers are pass-through views: Catalyst collapses them into
the scan, so a layer costs nothing until it is materialised on purpose.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedkiln import schemas


def register_layers(spark: SparkSession, sources: dict[str, DataFrame],
                    layers: dict[str, str]) -> None:
    """SNK-7: ``sources`` become temp views; every ``layers`` entry is
    ``view name -> SQL`` registered in the given (dependency) order."""
    for name, df in sources.items():
        df.createOrReplaceTempView(name)
    for name, sql in layers.items():
        spark.sql(sql).createOrReplaceTempView(name)


# The shipped layer graph (2 sources -> 2 staging -> 2 marts).
DEFAULT_LAYERS = {
    "stg_posts": "select * from raw_posts",
    "stg_comments": "select * from raw_comments",
    "fct_posts": "select * from stg_posts",
    "fct_comments": "select * from stg_comments",
}


def thread_order(df: DataFrame, post_col: str, time_col: str, id_col: str, out: str = "thread_pos") -> DataFrame:
    """SRT-2: place (gapless from 0) of every comment of a post in time order,
    comments and replies of all levels together; ties by id, nulls first.

    The rows are range-partitioned by (post, time, id), so the comments of a hot post lie
    in many partitions, and are numbered within (post, partition). Only a post that
    goes on from an earlier partition has a start to add: one row per partition."""
    keys = [post_col, time_col, id_col]
    part, at = "_thread_part", "_thread_at"
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the partition of a row is written down: a repeated stage could cut the ranges elsewhere
    rows = df.repartitionByRange(n, *keys).withColumn(part, F.spark_partition_id()).checkpoint()
    before = (rows.groupBy(post_col, part).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn(at, F.sum("_n").over(Window.partitionBy(post_col).orderBy(part)) - F.col("_n"))
              .filter(F.col(at) > 0).select(F.col(post_col).alias("_thread_post"), F.col(part).alias("_thread_of"), at))
    inside = F.row_number().over(Window.partitionBy(post_col, part).orderBy(time_col, id_col)) - 1
    numbered = rows.withColumn(out, inside)
    return (numbered.join(F.broadcast(before), F.col(post_col).eqNullSafe(F.col("_thread_post")) & (F.col(part) == F.col("_thread_of")), "left")
            .select(*df.columns, (F.col(out) + F.coalesce(F.col(at), F.lit(0))).cast("bigint").alias(out)))


def reply_depth(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """JOIN-8: root and depth of every node of a reply forest by pointer
    jumping. Each round joins the unresolved nodes to their ancestors once and
    doubles the jump, so depth D takes about log2(D) rounds; resolved nodes
    leave the join's left side, and lineage is cut with a reliable checkpoint. A
    parent that is not in the table makes the node a root (``dangling`` true).
    The rounds end when none resolves a node: what is left hangs on a cycle and
    keeps ``root_id``/``depth`` NULL.

    The join key is the ancestor, which a viral thread shares among many rows;
    AQE splits that skewed partition.
    """
    nodes = df.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"))
    known = nodes.select(F.col("id").alias("parent"), F.lit(True).alias("_known"))
    start = nodes.join(known, "parent", "left").select(
        "id", F.when(F.col("_known"), F.col("parent")).alias("anc"),
        (F.col("parent").isNotNull() & F.col("_known").isNull()).alias("dangling")).checkpoint()
    found = _jump(start.withColumn("dist", F.when(F.col("anc").isNotNull(), 1).cast("long")))
    return found.select(F.col("id").alias(id_col), F.col("root").alias("root_id"), "depth", "dangling")


def _jump(start: DataFrame) -> DataFrame:
    """``id, root, depth, dangling`` from ``id, anc, dist, dangling``: the ancestor that
    a node hangs on ``dist`` levels below (none: a root)."""
    done = start.filter("anc is null").select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth"), "dangling")
    left = start.filter("anc is not null").select("id", "anc", "dist", "dangling")
    while True:
        up = (left.select(F.col("id").alias("anc"), F.col("anc").alias("_a"), F.col("dist").alias("_d"), F.lit(None).cast(done.schema["root"].dataType).alias("_r"))
              .unionByName(done.select(F.col("id").alias("anc"), F.lit(None).cast(left.schema["anc"].dataType).alias("_a"),
                                       F.col("depth").alias("_d"), F.col("root").alias("_r"))))
        step = left.join(up, "anc").select("id", F.col("_a").alias("anc"), (F.col("dist") + F.col("_d")).alias("dist"),
                                           F.col("_r").alias("root"), "dangling").checkpoint()
        new = step.filter("root is not null")
        if new.isEmpty():
            break
        done = done.unionByName(new.select("id", "root", F.col("dist").alias("depth"), "dangling"))
        left = step.filter("root is null").select("id", "anc", "dist", "dangling")
    lost = left.select("id", F.lit(None).cast(done.schema["root"].dataType).alias("root"), F.lit(None).cast("long").alias("depth"), "dangling")
    return done.unionByName(lost)


def extend_replies(stored: DataFrame, arrivals: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """JOIN-8 by increments: the rows (``id, parent, root_id, depth, dangling``) that
    new nodes add to a stored forest of the same columns or change in it.

    A new node takes its root and depth from its stored parent. A stored root whose
    missing parent has come now is hung below it, and its whole tree moves with it.
    Only new nodes and such roots are resolved by pointer jumping; the stored table is
    joined for their parents and for the trees that move. Nodes that are stored
    already are passed over. Equals ``reply_depth`` over everything."""
    old = stored.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"), F.col("root_id").alias("root"), "depth", "dangling")
    new = (arrivals.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent")).dropDuplicates(["id"])
           .join(old.select("id"), "id", "left_anti").checkpoint())
    hung = old.filter("dangling").join(new.select(F.col("id").alias("parent")), "parent", "left_semi").select("id", "parent")
    graph = new.select("id", "parent", F.lit(False).alias("was_root")).unionByName(hung.select("id", "parent", F.lit(True))
                                                                                  .toDF("id", "parent", "was_root")).checkpoint()
    inside = graph.select(F.col("id").alias("parent"), F.lit(True).alias("_inside"))
    outside = old.select(F.col("id").alias("parent"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.lit(True).alias("_stored"))
    moving = graph.filter("was_root").select(F.col("id").alias("_root"), F.lit(True).alias("_moving"))
    told = graph.join(inside, "parent", "left").join(outside, "parent", "left").join(moving, "_root", "left")
    # a parent is new, or stored below a root that moves, or stored below one that stays
    anc = F.when(F.col("_inside"), F.col("parent")).when(F.col("_moving"), F.col("_root"))
    dist = F.when(F.col("_inside"), F.lit(1)).when(F.col("_moving"), F.col("_depth") + 1).cast("long")
    fixed = F.col("_inside").isNull() & F.col("_moving").isNull() & F.col("_stored").isNotNull()
    start = told.select("id", "parent", "was_root", anc.alias("anc"), dist.alias("dist"),
                        (F.col("parent").isNotNull() & F.col("_inside").isNull() & F.col("_stored").isNull()).alias("dangling"), fixed.alias("fixed"),
                        F.when(fixed, F.col("_root")).alias("base"), F.when(fixed, F.col("_depth") + 1).cast("long").alias("offset")).checkpoint()
    base = start.select(F.col("id").alias("root"), "fixed", "base", "offset")
    found = _jump(start.select("id", "anc", "dist", "dangling")).join(base, "root", "left")
    placed = found.select("id", F.when(F.col("fixed"), F.col("base")).otherwise(F.col("root")).alias("root"),
                          F.when(F.col("fixed"), F.col("offset") + F.col("depth")).otherwise(F.col("depth")).alias("depth"), "dangling")
    rows = placed.join(start.select("id", "parent", "was_root"), "id").checkpoint()
    to = rows.filter("was_root").select(F.col("id").alias("_from"), F.col("root").alias("_to"), F.col("depth").alias("_by"))
    moved = old.join(to, F.col("root") == F.col("_from")).select(
        "id", "parent", F.col("_to").alias("root"), (F.col("depth") + F.col("_by")).alias("depth"),
        (F.col("dangling") & (F.col("id") != F.col("_from"))).alias("dangling"))
    out = rows.filter(~F.col("was_root")).select("id", "parent", "root", "depth", "dangling").unionByName(moved)
    return out.select(F.col("id").alias(id_col), F.col("parent").alias(parent_col), F.col("root").alias("root_id"), "depth", "dangling")


def engagement_daily(df: DataFrame, ts: str, group: list[str], value: str | None = None) -> DataFrame:
    """AGG-13: rows (and a value sum) per day and group."""
    day = F.to_date(F.col(ts)).alias("day")
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if value:
        aggs.append(F.round(F.sum(value), 2).alias("value_sum"))
    return df.groupBy(day, *group).agg(*aggs)


def unify_platforms(parts: list[DataFrame]) -> DataFrame:
    """SET-3: one table, one ``platform`` column; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def map_video_comment(rec: Column, path: Column) -> list[Column]:
    """PRJ-16: a video-platform comment record to the canonical comment columns."""
    g = lambda p, t="string": F.try_variant_get(rec, p, t)
    native = g("$.id")
    parent = g("$.parentId")
    return [F.concat(F.lit("youtube_"), native).alias("comment_id"), F.lit("youtube").alias("platform"),
            native.alias("native_comment_id"), F.concat(F.lit("youtube_"), g("$.videoId")).alias("post_id"),
            F.when(parent.isNotNull(), F.concat(F.lit("youtube_"), parent)).alias("parent_comment_id"),
            g("$.channelId").alias("page_id"), F.coalesce(g("$.textOriginal"), g("$.textDisplay")).alias("message"),
            F.try_to_timestamp(g("$.publishedAt")).alias("created_time"),
            g("$.authorChannelId.value").alias("author_id"), g("$.authorDisplayName").alias("author_name"),
            F.coalesce(g("$.likeCount", "bigint"), F.lit(0).cast("bigint")).alias("reaction_like"),
            *[F.lit(0).cast("bigint").alias(c) for c in schemas.REACTION_COLUMNS[1:]],
            F.coalesce(g("$.totalReplyCount", "bigint"), F.lit(0).cast("bigint")).alias("reply_count"),
            parent.isNotNull().alias("is_reply"), path.alias("raw_blob_path"),
            g("$.moderationStatus").alias("moderation_status")]


def map_microblog_post(rec: Column, path: Column) -> list[Column]:
    """PRJ-17: a microblog post record (``full_text`` preferred, favourites as likes)."""
    g = lambda p, t="string": F.try_variant_get(rec, p, t)
    native = F.coalesce(g("$.id_str"), g("$.id", "bigint").cast("string"))
    return [F.concat(F.lit("twitter_"), native).alias("post_id"), F.lit("twitter").alias("platform"),
            native.alias("native_post_id"), g("$.user.id_str").alias("page_id"),
            F.coalesce(g("$.full_text"), g("$.text")).alias("message"),
            # the weekday says nothing that the date does not, and the parser refuses it
            F.try_to_timestamp(F.regexp_replace(g("$.created_at"), "^[A-Za-z]{3} ", ""), F.lit("MMM dd HH:mm:ss Z yyyy")).alias("created_time"),
            F.coalesce(g("$.retweet_count", "bigint"), F.lit(0).cast("bigint")).alias("share_count"),
            F.coalesce(g("$.favorite_count", "bigint"), F.lit(0).cast("bigint")).alias("reaction_like"),
            *[F.lit(0).cast("bigint").alias(c) for c in schemas.REACTION_COLUMNS[1:]],
            path.alias("raw_blob_path")]


def granular_reactions(records: DataFrame, id_col: str, rec: str = "record") -> DataFrame:
    """PRJ-19: one row per (content, user, type) from a ``reactions.data`` array;
    records without it yield nothing."""
    arr = F.try_variant_get(F.col(rec), "$.reactions.data", "array<variant>")
    r = records.select(id_col, F.explode(arr).alias("_r"))
    return r.select(id_col, F.try_variant_get("_r", "$.id", "string").alias("user_id"),
                    F.lower(F.try_variant_get("_r", "$.type", "string")).alias("reaction_type"))


def page_dimension(posts: DataFrame, platform: str = "platform", page: str = "page_id",
                   ts: str = "ingested_at") -> DataFrame:
    """PRJ-18: one row per page with first and last ingestion time."""
    return posts.groupBy(platform, page).agg(
        F.min(ts).alias("first_ingested_at"), F.max(ts).alias("last_ingested_at")).withColumn(
        "source_id", F.concat_ws("_", F.col(platform), F.col(page)))


def merge_page_dimension(old: DataFrame, new: DataFrame) -> DataFrame:
    """PRJ-18 merge: first = least, last = greatest."""
    j = old.alias("o").join(new.alias("n"), "source_id", "full_outer")
    pick = lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c)
    return j.select("source_id", pick("platform"), pick("page_id"),
                    F.least("o.first_ingested_at", "n.first_ingested_at").alias("first_ingested_at"),
                    F.greatest("o.last_ingested_at", "n.last_ingested_at").alias("last_ingested_at"))
