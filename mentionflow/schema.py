"""Column layouts. Every read passes one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCE_TYPES = ("social", "web")

#: Columns that identify a post; the stored table holds each pair once.
POST_KEY = ("source", "post_id")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


#: The one record all sources produce. `raw` is JSON text, the times are text as the source gave them.
POST = T.StructType(
    _strings(
        "source", "source_type", "keyword", "post_id", "text", "url",
        "author", "created_at", "lang", "raw", "scraped_at",
    )
)

#: Columns a stored post must have.
REQUIRED = ("source", "source_type", "keyword", "post_id", "text", "scraped_at")

#: A post in the table: typed times, a derived id, and the sentiment an outside stage fills in.
#: `scraped_date` is the directory column that lets a time range skip files.
STORED_POST = T.StructType(
    _strings("id", "source_type", "keyword", "post_id", "text", "url", "author", "lang")
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("raw", T.StringType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("sentiment_score", T.DecimalType(5, 4)),
        T.StructField("analyzed_at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("scraped_date", T.DateType()),
    ]
)

#: Directory columns of the stored table, outermost first.
STORED_PARTITIONS = ("source", "scraped_date")

SCORE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("sentiment_score", T.DecimalType(5, 4)),
        T.StructField("analyzed_at", T.TimestampType()),
    ]
)

#: One landed page. A null `html` means the fetch failed.
PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

#: One rendered search-result page.
CARD_PAGE = T.StructType(
    [
        T.StructField("keyword", T.StringType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("html", T.StringType()),
    ]
)

#: One landed social item; everything after `created_at` may be missing.
SOCIAL_ITEM = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("screen_name", T.StringType())])),
        T.StructField("retweet_count", T.LongType()),
        T.StructField("favorite_count", T.LongType()),
        T.StructField("reply_count", T.LongType()),
    ]
)

#: Landed items of the further platforms.
CAPTION_ITEM = T.StructType(
    _strings("id", "body", "username", "permalink", "ts", "type", "media_id")
    + [T.StructField("like_count", T.LongType())]
)
VIDEO_ITEM = T.StructType(
    _strings("id", "body", "username", "url", "ts", "type", "video_id")
    + [T.StructField("play_count", T.LongType()), T.StructField("like_count", T.LongType())]
)
VIDEO_COMMENT = T.StructType(
    _strings("id", "body", "display_name", "video_id", "video_title", "ts")
    + [T.StructField("like_count", T.LongType()), T.StructField("reply_count", T.LongType())]
)
REVIEW_ITEM = T.StructType(
    _strings("id", "shop", "body", "username", "product_url", "date")
    + [
        T.StructField("star_rating", T.IntegerType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("verified_purchase", T.BooleanType()),
    ]
)
