"""The given tables as landed inputs of the engine, and the same mappings as SQL text for the checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.functions.text import WHITESPACE, trimmed
from mentionflow.sources.posts import as_posts
from mentionflow.sources.rules import Rule

# Fixed values of the checks: keywords and the language the social search is restricted to.
KEYWORDS = ("that", "with", "und", "que", "les")
PAGE_KEYWORDS = ("the", "and", "de", "la")
SEARCH_LANG = "en"
SEARCH_LIMIT = 50

#: One rule per top domain of the landed pages; the three item selectors are three ways to name a menu link.
LINK_RULES = (
    Rule("com_pages", "https://example.com/", "nav li a", "::text", "::attr(href)"),
    Rule("net_pages", "https://example.net/", "a[href*='/']", "::text", "::attr(href)"),
    Rule("org_pages", "https://example.org/", "nav ul li a[href]", "::text", "::attr(href)"),
)
TITLE_RULES = tuple(
    Rule(f"{top}_titles", f"https://example.{top}/", "article", "h1::text", "::attr(href)")
    for top in ("com", "net", "org")
)
AD_RULES = tuple(
    Rule(f"{top}_ads", f"https://example.{top}/", "div.ad", "::text", "::attr(href)") for top in ("com", "net", "org")
)


#: Layouts of the given tables, so that no read starts a job to find them out.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def minutes_after_start(number: Column) -> Column:
    """2024-01-01 plus a number of minutes, split into days and minutes so that large numbers fit."""
    days, minutes = F.floor(number / 1440).cast("int"), F.pmod(number, F.lit(1440)).cast("int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(days, F.lit(0), minutes)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as web items."""
    return document_items(table(spark, sf_dir, "documents"))


def phrases(spark: SparkSession, sf_dir: str) -> list[str]:
    """A long keyword list: the words of the benchmark items and their pairs in order. A keyword list is configuration
    and lives on the driver, however it came to be."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"))
    pairs = F.transform("words", lambda word, at: F.concat_ws(" ", word, F.get("words", at + 1)))
    found = table(spark, sf_dir, "benchmark").select(words.alias("words")).select(F.explode(F.array_union("words", pairs)).alias("phrase"))
    return [row["phrase"] for row in found.distinct().orderBy("phrase").collect()]


#: The same list as SQL: `phrases`, a column `phrase` and its place.
SQL_PHRASES = """items AS (SELECT regexp_extract_all(lower(text), '([a-z]{3,})', 1) AS words FROM benchmark),
pairs AS (SELECT words, unnest(range(1, len(words) + 1)) AS at_word FROM items),
phrases AS (SELECT phrase, row_number() OVER (ORDER BY phrase) - 1 AS ord FROM (
  SELECT words[at_word] AS phrase FROM pairs UNION SELECT concat_ws(' ', words[at_word], words[at_word + 1]) FROM pairs))"""


def document_items(rows: DataFrame) -> DataFrame:
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/read/"), F.col("doc_id").cast("string"))
    return rows.select(
        "doc_id",
        "source",
        F.lit("web").alias("source_type"),
        F.col("doc_id").cast("string").alias("post_id"),
        trimmed(F.col("text")).alias("text"),
        "lang",
        url.alias("url"),
        minutes_after_start(F.col("doc_id")).alias("scraped_at"),
    ).filter(F.col("text") != "")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as results of the sentiment stage."""
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    score = F.lit(0.25) + F.col("quality") * 0.5 + (1 - F.col("toxic")) * 0.25
    return table(spark, sf_dir, "labels").select(
        "doc_id", label.alias("sentiment_label"), score.cast("decimal(5,4)").alias("sentiment_score")
    )


def scored(posts: DataFrame, sentiment: DataFrame) -> DataFrame:
    return posts.join(sentiment, "doc_id", "left")


def props_number() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def social_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed social items found under their type as keyword."""
    return table(spark, sf_dir, "events").select(*social_columns(), F.col("event_type").alias("keyword"))


def social_columns() -> list[Column]:
    """The landed social layout taken from event columns; two counters are missing on purpose."""
    return [
        F.col("event_id").alias("id"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("text"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("created_at"),
        F.lit(None).cast("string").alias("lang"),
        F.struct(F.concat(F.lit("user"), F.col("user_id")).alias("screen_name")).alias("user"),
        F.lit(None).cast("bigint").alias("retweet_count"),
        props_number().alias("favorite_count"),
        F.lit(None).cast("bigint").alias("reply_count"),
    ]


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as search-result pages of three cards: one without text, the event, one without a usable link.

    The number in `props` decides which form the event's card has, unusable ones among them. A page comes from one
    row, so no event is grouped with others and the pages are as evenly spread as the events.
    """
    number, event = props_number(), F.col("event_id").cast("string")
    handle = F.concat(F.lit("/user"), F.col("user_id"))
    status = F.concat(handle, F.lit("/status/"), event)
    href = (
        F.when(number < 10, F.concat(handle, F.lit("/status/draft")))
        .when(number < 15, F.concat(status, F.lit("/status/1")))
        .when(number < 30, F.concat(status, F.lit("/photo/1")))
        .when(number < 60, F.concat(status, F.lit("?s=20&amp;t=a")))
        .when(number < 80, F.concat(F.lit("https://x.com"), status))
        .otherwise(status)
    )
    words = F.when(number < 5, F.lit(" <br>\n ")).otherwise(
        F.concat(
            F.lit("<span> "), F.col("event_type"), F.lit("</span>\n<b>&lt;"), number.cast("string"),
            F.lit("&gt;</b> <img src=i.png> by "), F.substring(handle, 2, 100),
        )
    )
    card = F.concat(
        F.lit('<article role="x" data-testid="tweet"><a href="/">home</a><a href="'), handle,
        F.lit('">who</a><div data-testid="tweetText">'), words, F.lit('</div><a href="'), href,
        F.lit('"><time datetime="'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z">then</time></a></article>'),
    )
    before = '<html><body><section><article data-testid="tweet"><a href="/ad/status/1">ad</a></article>'
    after = '<article data-testid="tweet"><div data-testid="tweetText">more</div><a href="/more">x</a></article></section>'
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("keyword"),
        F.col("event_id").alias("page_no"),
        F.concat(F.lit(before), card, F.lit(after)).alias("html"),
    )


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir, "user").select(
        "id", F.col("text").alias("body"), F.concat(F.lit("user"), F.col("conv_id")).alias("username"),
        F.concat(F.lit("https://photos.example.org/"), F.col("id")).alias("permalink"), "ts",
        F.when(F.col("turn") == 0, "caption").otherwise("comment").alias("type"),
        F.col("conv_id").cast("string").alias("media_id"), F.col("turn").alias("like_count"),
    )


def short_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir, "system").select(
        "id", F.col("text").alias("body"), F.concat(F.lit("maker"), F.col("conv_id")).alias("username"),
        F.concat(F.lit("https://clips.example.org/"), F.col("id")).alias("url"), "ts",
        F.lit("description").alias("type"), F.col("conv_id").cast("string").alias("video_id"),
        (F.col("turn") + 100).alias("play_count"), F.lit(None).cast("bigint").alias("like_count"),
    )


def video_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir, "assistant").select(
        "id", F.col("text").alias("body"), F.concat(F.lit("viewer"), F.col("turn")).alias("display_name"),
        F.col("conv_id").cast("string").alias("video_id"),
        F.concat(F.lit("video "), F.col("conv_id")).alias("video_title"), "ts",
        F.col("turn").alias("like_count"), F.lit(None).cast("bigint").alias("reply_count"),
    )


def _turns(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    return (
        table(spark, sf_dir, "conversations")
        .filter(F.col("role") == role)
        .withColumn("id", F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
        .withColumn("ts", F.lit("2024-02-01T00:00:00Z"))
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as product reviews; the labels decide stars, shop and purchase."""
    labels = table(spark, sf_dir, "labels")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return texts.join(labels, "doc_id").select(
        F.concat(F.lit("r"), F.col("doc_id")).alias("id"),
        F.when(F.col("quality") == 1, "tokopedia").otherwise("shopee").alias("shop"),
        F.col("text").alias("body"),
        F.lit("guest").alias("username"),
        F.concat(F.lit("https://shop.example.org/"), F.col("source")).alias("product_url"),
        F.lit("2024-03-01").alias("date"),
        (1 + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))).cast("int").alias("star_rating"),
        F.col("source").alias("product_name"),
        (F.col("toxic") == 0).alias("verified_purchase"),
    )


def document_posts(items: DataFrame, extra=()) -> DataFrame:
    """Matched documents as post records in the landed text form."""
    stamp = F.concat(F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    raw = F.to_json(F.struct(F.col("url").alias("source_url")))
    return as_posts(items, extra, scraped_at=stamp, raw=raw)


# ---- the same mappings for the SQL side ----

_SPACES = WHITESPACE.replace("'", "''")

SQL_DOCS = f"""docs AS (
  SELECT doc_id, source, 'web' AS source_type, CAST(doc_id AS VARCHAR) AS post_id,
         trim(text, '{_SPACES}') AS text, lang,
         'https://' || source || '.example.org/read/' || doc_id AS url,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS scraped_at
  FROM documents WHERE trim(text, '{_SPACES}') <> '')"""

SQL_SCORES = """scores AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END
           AS sentiment_label,
         CAST(0.25 + 0.5 * quality + 0.25 * (1 - toxic) AS DECIMAL(5,4)) AS sentiment_score
  FROM labels)"""

SQL_KEYWORDS = "kw(keyword_ord, keyword) AS (VALUES {})".format(
    ", ".join(f"({at}, '{word}')" for at, word in enumerate(KEYWORDS))
)

SQL_FIRST = f"""{SQL_DOCS}, {SQL_KEYWORDS}, hits AS (
  SELECT d.doc_id, min(k.keyword_ord) AS keyword_ord
  FROM docs d JOIN kw k ON contains(lower(d.text), k.keyword) GROUP BY d.doc_id),
first_match AS (
  SELECT d.*, h.keyword_ord, k.keyword FROM docs d JOIN hits h USING (doc_id) JOIN kw k USING (keyword_ord))"""

SQL_SCORED = f"""{SQL_FIRST}, {SQL_SCORES}, posts AS (
  SELECT f.*, s.sentiment_label, s.sentiment_score FROM first_match f LEFT JOIN scores s USING (doc_id))"""

SQL_ID = "sha256(source || chr(1) || post_id)"


def sql_unescaped(expression: str) -> str:
    """Character references decoded, the ampersand last."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©")):
        expression = f"replace({expression}, '{entity}', '{char}')"
    return f"regexp_replace({expression}, '&amp;?', '&', 'g')"
