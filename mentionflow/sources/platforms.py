"""Field mappings of the further platforms to the shared post record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionflow.sources.posts import as_posts

# The address of a video comment.
VIDEO_URL = "https://youtube.com/watch?v="
COMMENT_PARAMETER = "&lcdv="


def _whole(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def caption_posts(items: DataFrame, extra=()) -> DataFrame:
    """Captions and comments of the photo platform."""
    return as_posts(
        items, extra, source=F.lit("instagram"), source_type=F.lit("social"), post_id=F.col("id"),
        text=F.col("body"), author=F.coalesce("username", F.lit("")), url=F.col("permalink"),
        created_at=F.coalesce("ts", F.lit("")),
        raw=F.to_json(F.struct("type", "media_id", _whole("like_count"))),
    )


def short_video_posts(items: DataFrame, extra=()) -> DataFrame:
    """Descriptions and comments of the short-video platform."""
    return as_posts(
        items, extra, source=F.lit("tiktok"), source_type=F.lit("social"), post_id=F.col("id"),
        text=F.col("body"), author=F.coalesce("username", F.lit("")), created_at=F.coalesce("ts", F.lit("")),
        raw=F.to_json(F.struct("type", "video_id", _whole("play_count"), _whole("like_count"))),
    )


def video_comment_posts(items: DataFrame, extra=()) -> DataFrame:
    """Comments of the video platform; the address is built from video and comment."""
    return as_posts(
        items, extra, source=F.lit("youtube"), source_type=F.lit("social"), post_id=F.col("id"),
        text=F.col("body"), author=F.coalesce("display_name", F.lit("")), created_at=F.coalesce("ts", F.lit("")),
        url=F.concat(F.lit(VIDEO_URL), F.col("video_id"), F.lit(COMMENT_PARAMETER), F.col("id")),
        raw=F.to_json(F.struct("video_id", "video_title", _whole("like_count"), _whole("reply_count"))),
    )


def review_posts(items: DataFrame, extra=()) -> DataFrame:
    """Product reviews; the shop is the source, and reviews count as web content."""
    return as_posts(
        items, extra, source=F.col("shop"), source_type=F.lit("web"), post_id=F.col("id"), text=F.col("body"),
        author=F.coalesce("username", F.lit("")), url=F.col("product_url"), created_at=F.coalesce("date", F.lit("")),
        raw=F.to_json(F.struct("star_rating", "product_name", "verified_purchase")),
    )
