"""Landed items to the shared post record, one function per kind of source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionflow.functions import text as tx
from mentionflow.functions.links import resolve_link
from mentionflow.functions.times import iso_text, parsed_time
from mentionflow.operators.dedup import cap_per_keyword, first_wins
from mentionflow.operators.extract import all_values, extract_items, first_value
from mentionflow.operators.filters import keep_where
from mentionflow.operators.health import Meter
from mentionflow.operators.match import clean_keywords, match_all, match_first, with_first_keyword
from mentionflow.schema import POST
from mentionflow.sources.rules import Rule, checked_rules, pages_by_rule

#: Columns that give a post its place in the run: keyword and rank for searches, page and item for pages.
ARRIVAL = ("arrival_major", "arrival_minor")
#: Order that decides which copy of a post is the first one; the columns after the arrival only break ties.
ARRIVAL_ORDER = (*ARRIVAL, "created_at", "text", "keyword", "url")

#: Language of an item that does not name one.
ITEM_LANG = "id"

# Selectors of a rendered search-result card.
CARD_SELECTOR = 'article[data-testid="tweet"]'
CARD_FIELDS = {
    "text_selector": '[data-testid="tweetText"] ::text',
    "status_selector": 'a[href*="/status/"]::attr(href)',
    "link_selector": "a[href]::attr(href)",
    "time_selector": "time[datetime]::attr(datetime)",
}


def as_posts(items: DataFrame, extra: Sequence[str] = (), **values: Column) -> DataFrame:
    """Select the post record. Columns not given are taken from the items or get the record's default."""
    defaults = {
        "author": F.lit(""),
        "created_at": F.lit(""),
        "lang": F.lit(ITEM_LANG),
        "raw": F.lit("{}"),
        "scraped_at": iso_text(F.current_timestamp()),
    }
    columns = []
    for name in POST.names:
        if name in values:
            column = values[name]
        elif name in items.columns:
            column = F.coalesce(F.col(name), defaults[name]) if name in defaults else F.col(name)
        else:
            column = defaults.get(name, F.lit(None))
        columns.append(column.cast("string").alias(name))
    return items.select(*columns, *extra)


def arrival(major: Column, minor: Column) -> list[Column]:
    return [major.cast("bigint").alias(ARRIVAL[0]), minor.cast("bigint").alias(ARRIVAL[1])]


def social_record(items: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Items of the social search as posts; `keyword` is the one they were found under."""
    post_id = F.col("id").cast("string")
    counts = F.to_json(
        F.struct(
            F.coalesce("retweet_count", F.lit(0).cast("bigint")).alias("retweet_count"),
            F.coalesce("favorite_count", F.lit(0).cast("bigint")).alias("like_count"),
            F.coalesce("reply_count", F.lit(0).cast("bigint")).alias("reply_count"),
        )
    )
    return as_posts(
        items,
        extra,
        source=F.lit("x"),
        source_type=F.lit("social"),
        post_id=post_id,
        url=tx.social_url(post_id),
        author=F.coalesce("user.screen_name", F.lit("")),
        raw=counts,
    )


def search_social(
    items: DataFrame, keywords: Sequence[str], lang: str, max_per_keyword: int, newest: Sequence[Column]
) -> DataFrame:
    """Keyword search over landed social items: language, all keywords, newest first, at most N per keyword.

    The language test goes to the scan; an item without a language has the record's default. Landed copies of an item
    count once. `item_ord` is the position within the keyword; caps come before dedup across keywords, so a post cut
    under one keyword can still arrive under a later one.
    """
    spoken = F.col("lang") == lang
    if lang == ITEM_LANG:
        spoken = spoken | F.col("lang").isNull()
    found = match_all(items.filter(spoken), "text", keywords)
    found = first_wins(found, newest, ("keyword_ord", "keyword", "id"))
    return cap_per_keyword(found, max_per_keyword, newest, ("keyword_ord", "keyword"), salt_by="id", rank="item_ord")


def social_posts(items: DataFrame, keywords: Sequence[str], lang: str, max_per_keyword: int) -> DataFrame:
    """Landed social items to posts with their arrival columns."""
    newest = [parsed_time(F.col("created_at")).desc_nulls_last(), F.col("id")]
    found = search_social(items, keywords, lang, max_per_keyword, newest)
    return social_record(found, extra=arrival(F.col("keyword_ord"), F.col("item_ord")))


def web_items(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Items of landed pages by rule: `source`, `url`, `page_id`, `item_ord`, `title`, `link`, `error`."""
    ruled = pages_by_rule(pages, checked_rules(rules))
    found = extract_items(
        ruled.select("page_id", "url", "source", "html", "post_selector", "title_selector", "link_selector"),
        "post_selector",
        ["title_selector", "link_selector"],
    )
    return found.select(
        "page_id", "url", "source", "item_ord",
        tx.trimmed(first_value(0)).alias("title"),
        resolve_link(F.col("url"), first_value(1)).alias("link"),
        "error",
    )


def titled(items: DataFrame) -> DataFrame:
    """Items with a title; the marker rows of empty or unreadable pages go as well."""
    return keep_where(items, F.col("item_ord").isNotNull() & (F.col("title") != ""))


def web_record(items: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Matched web items as posts; an item without a link is known by the start of its title."""
    return as_posts(
        items,
        extra,
        source_type=F.lit("web"),
        post_id=tx.or_else(F.col("link"), tx.title_key(F.col("title"))),
        text=F.col("title"),
        url=F.col("link"),
        raw=F.to_json(F.struct(F.col("url").alias("source_url"))),
    )


def web_posts(pages: DataFrame, rules: Sequence[Rule], keywords: Sequence[str]) -> DataFrame:
    """Pages to matched posts with their arrival columns."""
    matched = match_first(titled(web_items(pages, rules)), "title", keywords)
    return web_record(matched, extra=arrival(F.col("page_id"), F.col("item_ord")))


def web_rows(pages: DataFrame, rules: Sequence[Rule], keywords: Sequence[str], meter: Meter) -> DataFrame:
    """Pages to matched posts in one pass, and a row with its `problem` for each page that could not be read.

    The meter counts, by source, pages, unreadable ones, titled items and matched ones.
    """
    items = web_items(pages, rules)
    first, titled_item = F.coalesce("item_ord", F.lit(0)) == 0, F.col("item_ord").isNotNull() & (F.col("title") != "")
    tests = {"pages": first, "failed": F.col("error").isNotNull(), "found": titled_item, "matched": titled_item & F.col("keyword").isNotNull()}
    seen = with_first_keyword(items, "title", keywords)
    seen = meter.watch(seen, {f"{name}:{rule.name}": test & (F.col("source") == rule.name) for rule in rules for name, test in tests.items()})
    kept = keep_where(seen, tests["matched"] | tests["failed"])
    failed = F.col("error").isNotNull()
    kept = kept.withColumns({
        "title": F.when(~failed, F.col("title")),
        "link": F.when(failed, F.col("url")).otherwise(F.col("link")),
        "problem": F.concat(F.lit("page not read: "), F.col("error")),
    })
    return web_record(kept, extra=[*arrival(F.col("page_id"), F.coalesce("item_ord", F.lit(0))), F.col("problem")])


def card_items(pages: DataFrame) -> DataFrame:
    """Cards of rendered result pages, before any test: text, links, author, time."""
    selectors = {"post_selector": CARD_SELECTOR, **CARD_FIELDS}
    for name, selector in selectors.items():
        pages = pages.withColumn(name, F.lit(selector))
    found = extract_items(pages, "post_selector", list(CARD_FIELDS))
    kept = [name for name in found.columns if name != "values"]
    status = tx.status_link(all_values(1))
    return found.select(
        *kept,
        tx.joined_text(all_values(0)).alias("text"),
        status.alias("_status"),
        tx.author_handle(all_values(2)).alias("author"),
        first_value(3).alias("created_at"),
    )


def valid_cards(cards: DataFrame) -> DataFrame:
    """Cards with text and a link to a numbered status."""
    return keep_where(cards, F.col("item_ord").isNotNull() & (F.col("text") != "") & F.col("_status").isNotNull())


def card_posts(pages: DataFrame, keywords: Sequence[str], lang: str, max_per_keyword: int) -> DataFrame:
    """Rendered result pages (`keyword`, `page_no`, `html`) to posts.

    The cap counts valid cards only. A card that later pages show again counts on its first page.
    """
    words = clean_keywords(keywords)
    order = F.array_position(F.array(*[F.lit(word) for word in words]), F.col("keyword")) - 1
    searched = pages.filter(F.col("keyword").isin(words))
    cards = valid_cards(card_items(searched)).withColumn("keyword_ord", order)
    seen = Window.partitionBy("keyword_ord", "keyword", tx.status_id(F.col("_status"))).orderBy("page_no")
    cards = cards.withColumn("_page", F.rank().over(seen)).filter("_page = 1").drop("_page")
    capped = cap_per_keyword(
        cards.drop("error"), max_per_keyword, ["page_no", "item_ord"], ("keyword_ord", "keyword"),
        salt_by="_status", rank="card_no",
    )
    return as_posts(
        capped,
        extra=arrival(F.col("keyword_ord"), F.col("card_no")),
        source=F.lit("x"),
        source_type=F.lit("social"),
        post_id=tx.status_id(F.col("_status")),
        url=tx.on_social_host(F.col("_status")),
        lang=F.lit(lang),
        raw=F.lit("{}"),
    )

