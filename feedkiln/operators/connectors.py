"""Other platforms' records as entities (PRJ-16, PRJ-17, UDF-2).

A connector is an ``Entity``: a mapper to the canonical columns of posts or comments
and the first failing rule. Its rows take the same way as any others: validation,
dead letter, dedup, upsert. ``register`` adds one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedkiln import schemas
from feedkiln.functions import variant as V
from feedkiln.operators import canonical

# Time stamps of microblog posts, without the weekday.
MICROBLOG_TIME = "MMM dd HH:mm:ss Z yyyy"


def _zero(names: tuple[str, ...]) -> list[Column]:
    return [F.lit(0).cast("bigint").alias(c) for c in names]


def map_video_comment(sc: V.Scope, rec: str, meta: str, path: Column, platform: str = "youtube",
                      run_ts: str | None = None) -> tuple[list[Column], Column]:
    """PRJ-16: a video platform's comment (likes are its only reactions)."""
    plat = F.lit(platform)
    native, r_id = canonical._pk(sc, rec)
    text, r_text = V.string_field(sc, rec, "$.textOriginal", "textOriginal")
    shown, r_shown = V.string_field(sc, rec, "$.textDisplay", "textDisplay")
    message = F.coalesce(text, shown)
    video, r_video = V.string_field(sc, rec, "$.videoId", "videoId", required=True)
    parent, r_parent = V.string_field(sc, rec, "$.parentId", "parentId")
    created, r_created = V.timestamp_field(sc, rec, "$.publishedAt", "publishedAt")
    ingested, r_ingested = V.timestamp_field(sc, meta, "$.run_timestamp", "run_timestamp")
    author, r_author = V.string_field(sc, rec, "$.authorChannelId.value", "authorChannelId")
    name, r_name = V.string_field(sc, rec, "$.authorDisplayName", "authorDisplayName")
    likes, r_likes = V.long_field(sc, rec, "$.likeCount", "likeCount")
    replies, r_replies = V.long_field(sc, rec, "$.totalReplyCount", "totalReplyCount")
    channel, r_channel = V.string_field(sc, rec, "$.channelId", "channelId")
    status, r_status = V.string_field(sc, rec, "$.moderationStatus", "moderationStatus")
    parent_key = canonical._surrogate(plat, parent)
    cols = [canonical._surrogate(plat, native).alias("comment_id"), plat.alias("platform"), native.alias("native_comment_id"),
            canonical._surrogate(plat, video).alias("post_id"), parent_key.alias("parent_comment_id"), F.coalesce(channel, F.lit("unknown")).alias("page_id"),
            message.alias("message"), created.alias("created_time"), author.alias("author_id"), name.alias("author_name"),
            likes.alias("reaction_like"), *_zero(schemas.REACTION_COLUMNS[1:]), replies.alias("reply_count"), parent_key.isNotNull().alias("is_reply"),
            path.alias("raw_blob_path"), ingested.alias("ingested_at"), likes.alias("reaction_total"), status.alias("moderation_status")]
    reason = V.first_reason(*canonical._record_reasons(sc, rec), r_id, r_text, r_shown, F.when(message.isNull(), F.lit("missing:text")), r_video, r_parent,
                            r_created, canonical._time_range(created, run_ts, "publishedAt"), r_author, r_name, r_likes, r_replies, r_channel, r_status, r_ingested)
    return cols, reason


def map_microblog_post(sc: V.Scope, rec: str, meta: str, path: Column, platform: str = "twitter",
                       run_ts: str | None = None) -> tuple[list[Column], Column]:
    """PRJ-17: a microblog post (whole text preferred, favourites are likes)."""
    plat = F.lit(platform)
    native, r_id = canonical._pk(sc, rec, "id_str")
    full, r_full = V.string_field(sc, rec, "$.full_text", "full_text")
    short, r_short = V.string_field(sc, rec, "$.text", "text")
    user, r_user = V.string_field(sc, rec, "$.user.id_str", "user.id_str")
    stamp, r_stamp = V.string_field(sc, rec, "$.created_at", "created_at", required=True)
    # the weekday says nothing that the date does not, and the parser refuses it
    created = sc.derive(("microblog_time", rec), F.coalesce(
        F.try_to_timestamp(F.regexp_replace(stamp, "^[A-Za-z]{3} ", ""), F.lit(MICROBLOG_TIME)), V.string_to_ts(stamp)))
    ingested, r_ingested = V.timestamp_field(sc, meta, "$.run_timestamp", "run_timestamp")
    shares, r_shares = V.long_field(sc, rec, "$.retweet_count", "retweet_count")
    likes, r_likes = V.long_field(sc, rec, "$.favorite_count", "favorite_count")
    replies, r_replies = V.long_field(sc, rec, "$.reply_count", "reply_count")
    media = sc.get(rec, "$.entities.media", "array<variant>")
    media_type, r_media = V.string_field(sc, rec, "$.entities.media[0].type", "media.type")
    none = F.lit(None).cast("string")
    cols = [canonical._surrogate(plat, native).alias("post_id"), plat.alias("platform"), native.alias("native_post_id"), F.coalesce(user, F.lit("unknown")).alias("page_id"),
            F.coalesce(full, short).alias("message"), none.alias("story"), created.alias("created_time"), shares.alias("share_count"), replies.alias("comment_count"),
            likes.alias("reaction_like"), *_zero(schemas.REACTION_COLUMNS[1:]), (F.coalesce(F.size(media), F.lit(0)) > 0).alias("has_attachment"),
            media_type.alias("attachment_type"), path.alias("raw_blob_path"), ingested.alias("ingested_at"), likes.alias("reaction_total")]
    reason = V.first_reason(*canonical._record_reasons(sc, rec), r_id, r_full, r_short, r_user, r_stamp, F.when(created.isNull(), F.lit("bad_timestamp:created_at")),
                            canonical._time_range(created, run_ts, "created_at"), r_shares, r_likes, r_replies, r_media, r_ingested)
    return cols, reason


def register(entity: canonical.Entity) -> None:
    """UDF-2: make an entity known to ``canonical.entity`` and the jobs."""
    if entity.name in canonical.ENTITIES and canonical.ENTITIES[entity.name] != entity:
        raise ValueError(f"entity {entity.name!r} is registered already")
    canonical.ENTITIES[entity.name] = entity


register(canonical.Entity("video_comments", "comment_id", schemas.COMMENTS, map_video_comment))
register(canonical.Entity("microblog_posts", "post_id", schemas.POSTS, map_microblog_post))
