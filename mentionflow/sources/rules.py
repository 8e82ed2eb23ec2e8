"""The registry of web sources and the join of pages to their rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.functions.links import host_of, host_suffixes
from mentionflow.operators.selectors import parse_selector
from mentionflow.session import local_rows


@dataclass(frozen=True)
class Rule:
    """Where a source lives and which parts of its pages make an item."""

    name: str
    url: str
    post_selector: str
    title_selector: str
    link_selector: str


#: Sources that are not pages; a rule of such a name would give one source two types.
SOCIAL_SOURCES = frozenset({"x", "instagram", "tiktok", "youtube"})

# The sources monitored by default.
DEFAULT_RULES = (
    Rule(
        name="detik_news",
        url="https://news.detik.com/",
        post_selector="article.list-content__item",
        title_selector="h3.media__title a::text",
        link_selector="h3.media__title a::attr(href)",
    ),
    Rule(
        name="kompas_news",
        url="https://www.kompas.com/",
        post_selector="a[href*='/read/']",
        title_selector="::text",
        link_selector="::attr(href)",
    ),
    Rule(
        name="liputan6_news",
        url="https://www.liputan6.com/",
        post_selector="a[href*='/read/']",
        title_selector="::text",
        link_selector="::attr(href)",
    ),
    Rule(
        name="antara_news",
        url="https://www.antaranews.com/",
        post_selector="h3 a[href*='/berita/']",
        title_selector="::text",
        link_selector="::attr(href)",
    ),
    Rule(
        name="suara_news",
        url="https://www.suara.com/",
        post_selector="a[href*='/read/']",
        title_selector="::attr(title)",
        link_selector="::attr(href)",
    ),
)


def checked_rules(rules: Sequence[Rule]) -> list[Rule]:
    """The rules, after every selector has been parsed once: a bad one is reported before the job starts."""
    for rule in rules:
        for selector in (rule.post_selector, rule.title_selector, rule.link_selector):
            parse_selector(selector)
    names = [rule.name for rule in rules]
    if len(set(names)) != len(names) or not all(names) or set(names) & SOCIAL_SOURCES:
        raise ValueError("rule names must be given, unique, and none of " + ", ".join(sorted(SOCIAL_SOURCES)))
    return list(rules)


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules with the host their pages come from (a leading `www.` does not count)."""
    ddl = "name string,url string,post_selector string,title_selector string,link_selector string"
    rows = local_rows(spark, [asdict(rule) for rule in rules], ddl)
    return rows.withColumn("site", F.regexp_replace(host_of(F.col("url")), r"^www\.", ""))


def pages_by_rule(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Pages joined to every rule whose host is the page's host or a parent domain of it.

    The rules come from a list in driver memory, which bounds the broadcast side. Parent domains are exploded next
    to a projected host, so this is an equality hash join inside the scan stage: no shuffle, and page bodies are
    only passed on for pages that have a rule.
    """
    table = rule_table(pages.sparkSession, rules).select(
        F.col("name").alias("source"), "site", "post_selector", "title_selector", "link_selector"
    )
    sites = pages.withColumn("site", F.explode(host_suffixes(host_of(F.col("url")))))
    return sites.join(F.broadcast(table), "site")
