"""URL rules and a list of URLs, tested by a blocked Bloom filter before an exact join.

The rules are few and become one expression: a rule fits its host and all subdomains when the path starts with the
rule's path, and the longest wins. URLs that no rule judges are looked up in a list of canonical URLs. The filter is a
table of blocks of 256 bits, each built by OR-ing the bits of the URLs that hash to the block; the list's count sets the
number of blocks, so that a block holds about `PER_BLOCK` URLs. Up to `BROADCAST_BLOCKS` blocks (some 10 MB) the filter
is broadcast; beyond, its blocks are joined by their number. Possible hits alone go to the exact hash join, which removes
false positives.

Results: a null URL or one without `://` has empty host and path, fits no rule and is allowed; a null, empty or repeated
entry of the list changes nothing; repeated pages are judged one by one; empty tables give no rows, an empty list blocks
nothing; other columns are carried, `host`, `path`, `rule` and `verdict` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.llm.text import ascii_lower, carried, packed, whole
from mentionflow.session import staged

#: URLs a block of 256 bits is to hold, and the most blocks that are broadcast: enough for five million URLs.
PER_BLOCK, BROADCAST_BLOCKS = 20, 1 << 18
_WORDS, _BITS = 4, 8

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Words in a host by which the registered query lists URLs, for want of a table of listed URLs.
LISTED_WORDS = ("casino", "pills", "bets")


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(whole(url), r"://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(whole(url), r"://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """What different spellings of an address share: no scheme, query, fragment, leading `www.` or closing `/`."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""))


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def _first_fit(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value) -> Column:
    """The value of the longest rule that fits, else null."""
    longest_first = sorted(rules, key=lambda rule: (-len(rule[1]), -len(rule[2]), rule))
    return F.coalesce(*[F.when(_fits(host, path, rule[1], rule[2]), F.lit(value(rule))) for rule in longest_first], F.lit(None).cast("string"))


def filter_blocks(count: int) -> int:
    """The number of blocks for a list of that many URLs: a power of two."""
    return 1 << max(0, (count // PER_BLOCK).bit_length())


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _mask(url: Column, word: int) -> Column:
    """The bits of a URL in one 64-bit word of its block: `_BITS` bits spread over the block by a second hash."""
    spread = F.xxhash64(F.lit(1), url)  # another seed than the block's
    mask = F.lit(0).cast("long")
    for at in range(_BITS):
        bit = F.shiftrightunsigned(spread, 8 * at).bitwiseAND(F.lit(255))
        own = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
        mask = mask.bitwiseOR(F.when(F.floor(bit / 64) == word, own).otherwise(F.lit(0).cast("long")))
    return mask


def bloom_blocks(urls: DataFrame, blocks: int) -> DataFrame:
    """The filter of a column `listed_url`: at most `blocks` rows of block number and four words."""
    masked = urls.select(_block(F.col("listed_url"), blocks).alias("block"), *[_mask(F.col("listed_url"), at).alias(f"m{at}") for at in range(_WORDS)])
    return masked.groupBy("block").agg(*[F.bit_or(f"m{at}").alias(f"w{at}") for at in range(_WORDS)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Pages with `host`, `path`, `rule` and `verdict`. `listed` has canonical URLs in `listed_url`."""
    exact, _ = staged(listed.select("listed_url").filter(F.length("listed_url") > 0).distinct(), "listed-urls")
    blocks = filter_blocks(exact.count())
    parts = pages.select(packed(pages), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    parts = parts.withColumn("address", canonical(host, path))
    parts = parts.withColumns({"block": _block(F.col("address"), blocks)} | {f"q{at}": _mask(F.col("address"), at) for at in range(_WORDS)})
    bits, _ = staged(bloom_blocks(exact, blocks), "url-filter")
    probed = parts.join(F.broadcast(bits) if blocks <= BROADCAST_BLOCKS else bits, "block", "left")
    possible = F.lit(True)
    for at in range(_WORDS):
        possible = possible & (F.col(f"w{at}").bitwiseAND(F.col(f"q{at}")) == F.col(f"q{at}"))
    probed = probed.select("row", "host", "path", "address", F.coalesce(possible, F.lit(False)).alias("possible"))
    hits = probed.filter("possible").join(exact.withColumn("listed", F.lit(True)), F.col("address") == F.col("listed_url"), "left")
    misses = probed.filter(~F.col("possible")).withColumn("listed", F.lit(None).cast("boolean"))
    judged = hits.select("row", "host", "path", "listed").unionByName(misses.select("row", "host", "path", "listed"))
    rule = _first_fit(host, path, rules, lambda one: one[1] + one[2])
    verdict = _first_fit(host, path, rules, lambda one: one[0])
    other = F.when(F.coalesce(F.col("listed"), F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    kept = carried(pages, without=("host", "path", "rule", "verdict"))
    return judged.select(*kept, "host", "path", rule.alias("rule"), F.coalesce(verdict, other).alias("verdict"))


def listed_urls(pages: DataFrame) -> DataFrame:
    """The canonical URLs of all pages whose host has a listed word."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    marked = F.lit(False)
    for word in LISTED_WORDS:
        marked = marked | host.contains(word)
    return pages.filter(marked).select(canonical(host, path).alias("listed_url"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every URL of `pages`."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, listed_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), named AS (
    SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') AS address FROM parts
), listed AS (
    SELECT DISTINCT address FROM named
    WHERE address <> '' AND (host LIKE '%casino%' OR host LIKE '%pills%' OR host LIKE '%bets%')
), rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fitting AS (
    SELECT named.*, rule_host || rule_path AS rule, rule_verdict,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS place
    FROM named LEFT JOIN rules
      ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN address IN (SELECT address FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM fitting WHERE place = 1
"""
