"""Registered queries over the given tables, each with the SQL that checks it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentionflow.functions import metadata
from mentionflow.functions import text as tx
from mentionflow.functions.links import host_of, resolve_link
from mentionflow.functions.times import from_utc_wall_time, parsed_time, utc_day, utc_wall_time
from mentionflow.functions.trigrams import search_containing, search_similar
from mentionflow.operators.dedup import first_wins, run_counters
from mentionflow.operators.extract import source_health
from mentionflow.operators.health import COUNTS, breaker_states
from mentionflow.operators.match import match_all, match_first, with_first_keyword
from mentionflow.operators.reports import (
    apply_scores,
    by_keyword_and_time,
    by_source,
    daily_buckets,
    latest_unanalyzed,
    pending_analysis,
    rating_against_label,
    sentiment_summary,
    source_yield,
    with_metadata,
    with_star_rating,
)
from mentionflow.operators.validity import with_problems
from mentionflow.plans import adapters as ad
from mentionflow.plans.config import RunConfig, resolve_config
from mentionflow.plans.run import BUILDERS, RunReport, health_path, read_health, run
from mentionflow.session import landed_files, new_path, path_exists, spread_scan, staged
from mentionflow.sinks.fanout import Sinks
from mentionflow.sinks.jsonl import read_jsonl, write_jsonl
from mentionflow.sinks.summary import add_scores, count_inserted, read_summary
from mentionflow.sinks.table import fresh_rows, insert_posts, read_posts, read_scores, read_table, to_stored, write_scores
from mentionflow.sources import platforms
from mentionflow.sources.landed import stream_landed
from mentionflow.sources.posts import (
    ARRIVAL_ORDER,
    arrival,
    card_items,
    card_posts,
    search_social,
    social_record,
    titled,
    valid_cards,
    web_items,
    web_posts,
)
from mentionflow.sources.rules import Rule, pages_by_rule
from mentionflow.streaming.first import first_across_batches, rocksdb_state, unscored_after
from mentionflow.streaming.ingest import drop_seen, start_ingest, unscored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        key = name or build.__name__
        QUERIES[key] = build
        if sql:
            CHECKS[key] = sql
        return build

    return register


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_first(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched documents with the sentiment they have, in the columns of the stored table."""
    posts = ad.scored(_matched(spark, sf_dir), ad.scores(spark, sf_dir))
    return posts.withColumn("id", tx.record_id(F.col("source"), F.col("post_id")))


_tables: dict[tuple[str, str], str] = {}


def _stored_path(spark: SparkSession, sf_dir: str) -> str:
    """Matched documents inserted into a table and scored; written once per session and shared by its queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables or not path_exists(spark, _tables[key]):
        path = new_path(spark, "table")
        insert_posts(ad.document_posts(_matched(spark, sf_dir)), path)  # read once, as the table is new
        write_scores(_score_rows(spark, sf_dir, "timestamp"), path)
        _tables[key] = path
    return _tables[key]


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_posts(spark, _stored_path(spark, sf_dir))


def _utc(rows: DataFrame) -> DataFrame:
    return rows.withColumn("scraped_at", utc_wall_time(F.col("scraped_at")))


def _summary_row(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for engines that divide decimals differently."""
    return df.withColumn("positive_pct", F.col("positive_pct").cast("double")).withColumn(
        "avg_score", F.round(F.col("avg_score").cast("double"), 6)
    )


_SUMMARY_SQL = """
SELECT keyword, source, count(*) AS total,
       count(*) FILTER (WHERE sentiment_label = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral,
       count(*) FILTER (WHERE sentiment_label = 'negative') AS negative,
       ((2000 * count(*) FILTER (WHERE sentiment_label = 'positive') + count(*)) // (2 * count(*))) / 10.0
         AS positive_pct,
       round(avg(CAST(sentiment_score AS DOUBLE)), 6) AS avg_score, max(scraped_at) AS last_scraped
FROM posts WHERE sentiment_label IS NOT NULL GROUP BY keyword, source ORDER BY keyword, source"""


# ---- reporting ----


@query(f"WITH {ad.SQL_SCORED} {_SUMMARY_SQL}".replace("/ 10.0", "/ CAST(10 AS DOUBLE)"), name="sentiment_summary")
def sentiment_summary_report(spark, sf_dir):
    return _summary_row(sentiment_summary(_posts(spark, sf_dir)))


@query(f"""WITH {ad.SQL_SCORED} SELECT {ad.SQL_ID} AS id, source, source_type, keyword, post_id, text, lang, scraped_at
FROM posts WHERE sentiment_label IS NULL ORDER BY scraped_at, id""", name="pending_analysis")
def pending_analysis_queue(spark, sf_dir):
    path = _stored_path(spark, sf_dir)
    return _utc(pending_analysis(read_table(spark, path), scores=read_scores(spark, path)))


@query(f"""WITH {ad.SQL_SCORED} SELECT {ad.SQL_ID} AS id, source, source_type, keyword, post_id, text, lang, scraped_at
FROM posts WHERE sentiment_label IS NULL ORDER BY scraped_at DESC, id LIMIT 100""")
def latest_unanalyzed_top(spark, sf_dir):
    return _utc(latest_unanalyzed(_stored(spark, sf_dir), 100))


@query(f"""WITH {ad.SQL_FIRST} SELECT post_id, source, keyword, scraped_at FROM first_match
WHERE keyword = 'que' AND scraped_at BETWEEN TIMESTAMP '2024-01-01 03:00:00' AND TIMESTAMP '2024-01-06 12:00:00'
ORDER BY scraped_at DESC, post_id""")
def keyword_time_range(spark, sf_dir):
    start, end = (from_utc_wall_time(F.lit(text).cast("timestamp_ntz")) for text in ("2024-01-01 03:00:00", "2024-01-06 12:00:00"))
    rows = by_keyword_and_time(_stored(spark, sf_dir), "que", start, end)
    return _utc(rows.select("post_id", "source", "keyword", "scraped_at"))


@query(f"""WITH {ad.SQL_FIRST} SELECT post_id, source, keyword, scraped_at FROM first_match WHERE source = 'src1'
ORDER BY scraped_at DESC, post_id""")
def source_latest(spark, sf_dir):
    return _utc(by_source(_stored(spark, sf_dir), "src1").select("post_id", "source", "keyword", "scraped_at"))


@query(f"""WITH {ad.SQL_DOCS}, {ad.SQL_KEYWORDS}, items AS (
  SELECT d.source, d.doc_id, count(k.keyword) AS hits FROM docs d
  LEFT JOIN kw k ON contains(lower(d.text), k.keyword) GROUP BY ALL),
listed AS (SELECT 'src' || n AS source FROM range(21) t(n))
SELECT l.source, count(i.doc_id) AS found, count(i.doc_id) FILTER (WHERE hits > 0) AS matched,
       count(i.doc_id) FILTER (WHERE hits > 0) = 0 AS no_match
FROM listed l LEFT JOIN items i USING (source) GROUP BY l.source""", name="source_yield")
def source_yield_report(spark, sf_dir):
    items = with_first_keyword(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    return source_yield(items, [f"src{number}" for number in range(21)])


@query("""SELECT 'x' AS source, strftime(ts, '%Y%m%d') AS day, count(*) AS posts FROM events GROUP BY ALL""")
def daily_bucket(spark, sf_dir):
    events = ad.table(spark, sf_dir, "events")
    return daily_buckets(events.select(F.lit("x").alias("source"), from_utc_wall_time(F.col("ts")).alias("scraped_at")))


# ---- matching, duplicates, caps ----


@query(f"""WITH {ad.SQL_FIRST} SELECT source, source_type, keyword, keyword_ord, post_id, url,
substring(text, 1, 60) AS title_key, text FROM first_match""")
def keyword_first_match(spark, sf_dir):
    return _matched(spark, sf_dir).select(
        "source", "source_type", "keyword", "keyword_ord", "post_id", "url",
        tx.title_key(F.col("text")).alias("title_key"), "text",
    )


@query(f"""WITH {ad.SQL_DOCS}, {ad.SQL_KEYWORDS}
SELECT d.source, d.post_id, k.keyword_ord, k.keyword FROM docs d JOIN kw k ON contains(lower(d.text), k.keyword)""")
def keyword_all_match(spark, sf_dir):
    found = match_all(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    return found.select("source", "post_id", "keyword_ord", "keyword")


@query(f"""WITH {ad.SQL_DOCS}, {ad.SQL_KEYWORDS}, pairs AS (
  SELECT d.source, d.post_id, k.keyword_ord, k.keyword FROM docs d JOIN kw k ON contains(lower(d.text), k.keyword))
SELECT source, post_id, keyword_ord, keyword FROM pairs
QUALIFY row_number() OVER (PARTITION BY source, post_id ORDER BY keyword_ord) = 1""")
def keyword_all_match_dedup(spark, sf_dir):
    found = match_all(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    return first_wins(found.select("source", "post_id", "keyword_ord", "keyword"), ["keyword_ord"])


@query(f"""WITH {ad.SQL_DOCS}, {ad.SQL_PHRASES}
SELECT d.source, d.post_id, count(*) AS hits, min(ord) AS first_ord, max(ord) AS last_ord, CAST(sum(ord) AS BIGINT) AS ords
FROM docs d JOIN phrases ON contains(lower(d.text), phrase) GROUP BY d.source, d.post_id""")
def keyword_long_list(spark, sf_dir):
    """All keywords of a list of thousands, by an automaton."""
    found = match_all(ad.documents(spark, sf_dir), "text", ad.phrases(spark, sf_dir))
    ord = F.col("keyword_ord").cast("long")
    return found.groupBy("source", "post_id").agg(
        F.count("*").alias("hits"), F.min(ord).alias("first_ord"), F.max(ord).alias("last_ord"), F.sum(ord).alias("ords")
    )


@query(f"""WITH {ad.SQL_DOCS}, {ad.SQL_PHRASES}
SELECT d.source, d.post_id, min(ord) AS keyword_ord, min_by(phrase, ord) AS keyword
FROM docs d JOIN phrases ON contains(lower(d.text), phrase) GROUP BY d.source, d.post_id""")
def keyword_long_list_first(spark, sf_dir):
    found = match_first(ad.documents(spark, sf_dir), "text", ad.phrases(spark, sf_dir))
    return found.select("source", "post_id", F.col("keyword_ord").cast("long").alias("keyword_ord"), "keyword")


def _search_sql(limit: int) -> str:
    return f"""WITH {ad.SQL_DOCS}, {ad.SQL_KEYWORDS}, pairs AS (
  SELECT d.post_id, d.source, d.scraped_at, k.keyword_ord, k.keyword
  FROM docs d JOIN kw k ON contains(lower(d.text), k.keyword) WHERE d.lang = '{ad.SEARCH_LANG}')
SELECT keyword, post_id, source, scraped_at,
       row_number() OVER (PARTITION BY keyword ORDER BY scraped_at DESC, post_id) AS position FROM pairs
QUALIFY position <= {limit}"""


def _search(spark, sf_dir, limit: int) -> DataFrame:
    items = ad.documents(spark, sf_dir).withColumn("id", F.col("post_id"))
    newest = [F.col("scraped_at").desc(), F.col("post_id")]
    found = search_social(items, ad.KEYWORDS, ad.SEARCH_LANG, limit, newest)
    return found.select("keyword", "post_id", "source", "scraped_at", F.col("item_ord").alias("position"))


@query(_search_sql(ad.SEARCH_LIMIT))
def search_latest_per_keyword(spark, sf_dir):
    return _search(spark, sf_dir, ad.SEARCH_LIMIT)


@query(_search_sql(100000))
def search_large_cap(spark, sf_dir):
    """The same search with a cap that cuts nothing."""
    return _search(spark, sf_dir, 100000)


@query(f"""WITH {ad.SQL_DOCS}, {ad.SQL_KEYWORDS}, pairs AS (
  SELECT d.source, d.post_id FROM docs d JOIN kw k ON contains(lower(d.text), k.keyword)),
web AS (SELECT count(*) AS rows_in, count(DISTINCT (source, post_id)) AS kept FROM pairs),
social AS (SELECT count(*) AS rows_in, count(DISTINCT event_id) AS kept FROM events)
SELECT social.kept AS social, web.kept AS web,
       CAST(social.rows_in - social.kept + web.rows_in - web.kept AS BIGINT) AS duplicates FROM social, web""")
def run_stats(spark, sf_dir):
    found = match_all(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    columns = ["source", "source_type", "post_id"]
    return run_counters(found.select(columns).unionByName(social_record(ad.social_items(spark, sf_dir)).select(columns)))


# ---- inserts and sentiment write-back ----


@query(f"""WITH {ad.SQL_SCORED}
SELECT source, post_id, keyword, CASE WHEN sentiment_label IS NULL THEN 'new' ELSE 'stored' END AS origin
FROM posts""")
def idempotent_insert(spark, sf_dir):
    posts = _posts(spark, sf_dir)
    stored = posts.filter(F.col("sentiment_label").isNotNull())
    stored = stored.select("source", "post_id", "keyword", F.lit("stored").alias("origin"))
    found = match_all(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    incoming = first_wins(found.select("source", "post_id", "keyword", "keyword_ord"), ["keyword_ord"])
    incoming, _ = staged(incoming.drop("keyword_ord").withColumn("origin", F.lit("new")), "incoming")
    return stored.unionByName(fresh_rows(incoming, stored))


def _arrived(spark, sf_dir) -> DataFrame:
    """Documents under every keyword they have, as posts with arrival columns."""
    found = match_all(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    return ad.document_posts(found, extra=arrival(F.col("keyword_ord"), F.lit(0)))


def _once(posts: DataFrame) -> DataFrame:
    return first_wins(posts, ARRIVAL_ORDER)


@query(f"""WITH {ad.SQL_FIRST} SELECT {ad.SQL_ID} AS id, source, source_type, keyword, post_id, text, url, '' AS author,
lang, CAST(NULL AS TIMESTAMP) AS created_at, '{{"source_url":"' || url || '"}}' AS raw, scraped_at,
CAST(scraped_at AS DATE) AS scraped_date FROM first_match""")
def table_insert_rerun(spark, sf_dir):
    """One language is stored first, then all documents come twice; every key must be there once."""
    path = new_path(spark, "table")
    batch, _ = staged(_once(_arrived(spark, sf_dir)), "incoming")
    insert_posts(batch.filter(F.col("lang") == "en"), path)
    insert_posts(batch, path)
    insert_posts(batch, path)
    rows = read_posts(spark, path).drop("sentiment_label", "sentiment_score", "analyzed_at")
    return rows.withColumn("scraped_at", utc_wall_time(F.col("scraped_at"))).withColumn(
        "created_at", utc_wall_time(F.col("created_at"))
    )


_SCORE_TIME = "2024-06-01 00:00:00"


@query(f"""WITH {ad.SQL_SCORED} SELECT {ad.SQL_ID} AS id, source, post_id, sentiment_label,
CAST(sentiment_score AS DOUBLE) AS sentiment_score,
CASE WHEN sentiment_label IS NOT NULL THEN TIMESTAMP '{_SCORE_TIME}' END AS analyzed_at FROM posts""")
def sentiment_writeback(spark, sf_dir):
    posts = _matched(spark, sf_dir).select(
        tx.record_id(F.col("source"), F.col("post_id")).alias("id"), "source", "post_id",
        F.lit(None).cast("string").alias("sentiment_label"),
        F.lit(None).cast("decimal(5,4)").alias("sentiment_score"),
        F.lit(None).cast("timestamp_ntz").alias("analyzed_at"),
    )
    filled = apply_scores(posts, _score_rows(spark, sf_dir, "timestamp_ntz"))
    return filled.withColumn("sentiment_score", F.col("sentiment_score").cast("double"))


def _score_rows(spark, sf_dir, time_type: str) -> DataFrame:
    """Results of the sentiment stage under the ids of the stored posts."""
    sources = ad.table(spark, sf_dir, "documents").select("doc_id", "source")
    return ad.scores(spark, sf_dir).join(sources, "doc_id").select(
        tx.record_id(F.col("source"), F.col("doc_id").cast("string")).alias("id"),
        "sentiment_label", "sentiment_score", F.lit(_SCORE_TIME).cast(time_type).alias("analyzed_at"),
    )


@query(f"WITH {ad.SQL_SCORED} {_SUMMARY_SQL}".replace("/ 10.0", "/ CAST(10 AS DOUBLE)"))
def table_writeback_summary(spark, sf_dir):
    """The summary after posts were inserted into a table and scores written back to it."""
    path = new_path(spark, "table")
    batch, _ = staged(_once(_arrived(spark, sf_dir)), "incoming")
    insert_posts(batch, path)
    write_scores(_score_rows(spark, sf_dir, "timestamp"), path)
    summary = _summary_row(sentiment_summary(read_posts(spark, path)))
    return summary.withColumn("last_scraped", utc_wall_time(F.col("last_scraped")))


@query(f"""WITH {ad.SQL_DOCS}, faulty AS (
  SELECT post_id, CASE WHEN lang = 'es' THEN 'forum' ELSE source_type END AS source_type,
         CASE WHEN length(text) < 200 THEN NULL ELSE text END AS text,
         CASE WHEN lang = 'de' THEN NULL ELSE lang END AS keyword FROM docs)
SELECT post_id, concat_ws(', ', CASE WHEN keyword IS NULL THEN 'keyword is null' END,
         CASE WHEN text IS NULL THEN 'text is null' END,
         CASE WHEN source_type NOT IN ('social', 'web') THEN 'source_type is not social or web' END) AS reason,
       keyword IS NOT NULL AND text IS NOT NULL AND source_type IN ('social', 'web') AS is_valid FROM faulty""")
def row_validity(spark, sf_dir):
    """Documents with faults put in by language and length, and what is found wrong with each."""
    faulty = ad.documents(spark, sf_dir).select(
        "source", "post_id", "scraped_at",
        F.when(F.col("lang") == "es", "forum").otherwise(F.col("source_type")).alias("source_type"),
        F.when(F.length("text") >= 200, F.col("text")).alias("text"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("keyword"),
    )
    checked = with_problems(faulty)
    return checked.select(
        "post_id", F.array_join("reason", ", ").alias("reason"), (F.size("reason") == 0).alias("is_valid")
    )


# ---- text and metadata search ----


def _similar_sql(table: str, columns: str, text: str, phrase: str, threshold: float) -> str:
    def pieces(value: str) -> str:
        return (
            f"list_distinct(flatten(list_transform(list_distinct(list_filter(regexp_split_to_array(lower({value}), "
            "'[^\\p{L}\\p{N}]+'), lambda w: w <> '')), lambda w: list_transform(range(1, length(w) + 2), "
            "lambda i: substr('  ' || w || ' ', i, 3)))))"
        )

    return f"""WITH sets AS (SELECT {columns}, {pieces(text)} AS a, {pieces(f"'{phrase}'")} AS b FROM {table}),
sized AS (SELECT *, len(list_intersect(a, b)) AS shared FROM sets),
graded AS (SELECT {columns}, CAST(shared AS DOUBLE) / (len(a) + len(b) - shared) AS s FROM sized)
SELECT {columns}, round(s, 6) AS similarity FROM graded WHERE s >= {threshold}"""


@query(_similar_sql("part", "p_partkey, p_name", "p_name", "small ring", 0.3))
def fuzzy_text_search(spark, sf_dir):
    found = search_similar(ad.table(spark, sf_dir, "part"), "p_name", "small ring", 0.3)
    return found.select("p_partkey", "p_name", F.round("similarity", 6).alias("similarity"))


_PHRASE = "the intention that was under the thundering of another and not with her"


@query(_similar_sql("documents", "doc_id, source", "text", _PHRASE, 0.2))
def fuzzy_document_search(spark, sf_dir):
    """The same search over whole documents."""
    found = search_similar(spread_scan(ad.table(spark, sf_dir, "documents")), "text", _PHRASE, 0.2)
    return found.select("doc_id", "source", F.round("similarity", 6).alias("similarity"))


@query("SELECT doc_id, source FROM documents WHERE text ILIKE '%the%'")
def ilike_search(spark, sf_dir):
    return search_containing(ad.table(spark, sf_dir, "documents"), "text", "the").select("doc_id", "source")


@query("""SELECT event_id FROM events WHERE 1800000000000000000 + event_id // 2 = 1800000000000000021""")
def json_large_ids(spark, sf_dir):
    """Containment of ids beyond what a double tells apart."""
    large = (F.lit(1800000000000000000) + F.floor(F.col("event_id") / 2)).cast("string")
    raw = F.concat(F.lit('{"it\'s \\"id\\"":'), large, F.lit("}"))
    events = ad.table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return with_metadata(events, {"it's \"id\"": 1800000000000000021}).select("event_id")


@query("""SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, props->>'k' IS NOT NULL AS has_k,
props->>'j' IS NOT NULL AS has_j FROM events WHERE CAST(props->>'k' AS BIGINT) = 69""")
def json_metadata_filter(spark, sf_dir):
    events = ad.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("raw"))
    return with_metadata(events, {"k": 69}).select(
        "event_id", metadata.value(F.col("raw"), "k", "bigint").alias("k"),
        metadata.has_key(F.col("raw"), "k").alias("has_k"), metadata.has_key(F.col("raw"), "j").alias("has_j"),
    )


# ---- normalisation ----


@query("""SELECT 'x' AS source, 'social' AS source_type, event_type AS keyword, CAST(event_id AS VARCHAR) AS post_id,
event_type || ' ' || props AS text, 'https://x.com/i/web/status/' || event_id AS url, 'user' || user_id AS author,
strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS created_at, 'id' AS lang,
'{"retweet_count":0,"like_count":' || (props->>'k') || ',"reply_count":0}' AS raw FROM events""")
def social_normalise(spark, sf_dir):
    return social_record(ad.social_items(spark, sf_dir)).drop("scraped_at")


_STAMPED = """SELECT event_id, CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z'
  WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' WHEN 'signup' THEN 'social'
  WHEN 'error' THEN '' ELSE 'not a time' END AS form, ts FROM events"""


@query(f"""WITH stamped AS ({_STAMPED}) SELECT event_id,
CASE WHEN form IN ('', 'not a time') THEN NULL ELSE date_trunc('second', ts) END AS created_at,
CASE WHEN form IN ('', 'not a time') THEN NULL ELSE strftime(ts, '%Y%m%d') END AS day FROM stamped""")
def timestamp_normalise(spark, sf_dir):
    """Event times written in each text form a source uses, and read back."""
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    weekday = F.element_at(
        F.array(*[F.lit(name) for name in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")]), F.dayofweek("ts")
    )
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(second, F.lit(".000Z")))
        .when(kind == "click", F.concat(second, F.lit("+00:00")))
        .when(kind == "signup", F.concat_ws(" ", weekday, F.date_format("ts", "MMM dd HH:mm:ss '+0000' yyyy")))
        .when(kind == "error", "")
        .otherwise("not a time")
    )
    parsed = ad.table(spark, sf_dir, "events").select("event_id", parsed_time(text).alias("created_at"))
    return parsed.select(
        "event_id", utc_wall_time(F.col("created_at")).alias("created_at"), utc_day(F.col("created_at")).alias("day")
    )


_TURN = "conv_id || '-' || turn"


RUN_KEYWORDS = ("the", "and", "view", "error")
_RUN_WORDS = ", ".join(f"({at}, '{word}')" for at, word in enumerate(RUN_KEYWORDS))


@query(f"""WITH words(keyword_ord, keyword) AS (VALUES {_RUN_WORDS}), items AS (
  SELECT 'instagram' AS source, 'social' AS source_type, {_TURN} AS post_id, text, 'user' || conv_id AS author,
    'https://photos.example.org/' || {_TURN} AS url, '2024-02-01T00:00:00Z' AS created_at,
    '{{"type":"' || CASE WHEN turn = 0 THEN 'caption' ELSE 'comment' END || '","media_id":"' || conv_id
      || '","like_count":' || turn || '}}' AS raw, text AS about, NULL AS product FROM conversations WHERE role = 'user'
  UNION ALL SELECT 'tiktok', 'social', {_TURN}, text, 'maker' || conv_id, 'https://clips.example.org/' || {_TURN},
    '2024-02-01T00:00:00Z', '{{"type":"description","video_id":"' || conv_id || '","play_count":' || (turn + 100)
      || ',"like_count":0}}', text, NULL FROM conversations WHERE role = 'system'
  UNION ALL SELECT 'youtube', 'social', {_TURN}, text, 'viewer' || turn,
    'https://youtube.com/watch?v=' || conv_id || '&lcdv=' || {_TURN}, '2024-02-01T00:00:00Z',
    '{{"video_id":"' || conv_id || '","video_title":"video ' || conv_id || '","like_count":' || turn
      || ',"reply_count":0}}', 'video ' || conv_id || ' ' || text, NULL FROM conversations WHERE role = 'assistant'
  UNION ALL SELECT CASE WHEN quality = 1 THEN 'tokopedia' ELSE 'shopee' END, 'web', 'r' || doc_id, text, 'guest',
    'https://shop.example.org/' || source, '2024-03-01',
    '{{"star_rating":' || (1 + 2 * quality + 2 * (1 - toxic)) || ',"product_name":"' || source
      || '","verified_purchase":' || CASE WHEN toxic = 0 THEN 'true' ELSE 'false' END || '}}',
    source || ' ' || text, source FROM documents JOIN labels USING (doc_id)),
first AS (SELECT source, post_id, min(keyword_ord) AS keyword_ord FROM items
  JOIN words ON contains(lower(about), keyword) GROUP BY ALL)
SELECT source, source_type, coalesce(keyword, product) AS keyword, post_id, text, author, url, created_at, raw
FROM items LEFT JOIN first USING (source, post_id) LEFT JOIN words USING (keyword_ord)
WHERE keyword IS NOT NULL OR product IS NOT NULL""")
def planned_union(spark, sf_dir):
    """The further platforms as a run builds them, with the keyword each post was found under."""
    config = RunConfig(keywords=RUN_KEYWORDS)
    landed = {"instagram": ad.captions, "tiktok": ad.short_videos, "youtube": ad.video_comments, "ecommerce": ad.reviews}
    parts = [BUILDERS[family](read(spark, sf_dir), config) for family, read in landed.items()]
    return reduce(DataFrame.unionByName, parts).select(
        "source", "source_type", "keyword", "post_id", "text", "author", "url", "created_at", "raw"
    )


@query("""SELECT CASE WHEN quality = 1 THEN 'tokopedia' ELSE 'shopee' END AS source, 'r' || doc_id AS post_id
FROM labels JOIN documents USING (doc_id) WHERE 1 + 2 * quality + 2 * (1 - toxic) BETWEEN 4 AND 5""")
def star_rating_filter(spark, sf_dir):
    return with_star_rating(platforms.review_posts(ad.reviews(spark, sf_dir)), 4).select("source", "post_id")


@query(f"""WITH {ad.SQL_SCORES} SELECT 1 + 2 * quality + 2 * (1 - toxic) AS star_rating, sentiment_label,
count(*) AS posts FROM labels JOIN scores USING (doc_id) JOIN documents USING (doc_id) GROUP BY ALL""")
def rating_crosscheck(spark, sf_dir):
    posts = platforms.review_posts(ad.reviews(spark, sf_dir))
    sentiment = ad.scores(spark, sf_dir).select(
        F.concat(F.lit("r"), F.col("doc_id")).alias("post_id"), "sentiment_label"
    )
    return rating_against_label(posts.select("post_id", "raw").join(sentiment, "post_id"))


# ---- extraction ----

_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
_ORIGIN = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_TOP = "regexp_extract(url, '^https?://[^/?#]+\\.(com|net|org)', 1)"

_LINKS_SQL = f"""anchors AS (
  SELECT page_id, url, {_TOP} || '_pages' AS source, {_ORIGIN} AS origin,
         regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS found FROM pages),
listed AS (SELECT page_id, url, source, origin, unnest(found) AS anchor, generate_subscripts(found, 1) - 1 AS item_ord
           FROM anchors),
links AS (SELECT page_id, url, source, CAST(item_ord AS INTEGER) AS item_ord,
  trim({ad.sql_unescaped("regexp_extract(anchor, '>([^<]*)<', 1)")}) AS title,
  origin || {ad.sql_unescaped("regexp_extract(anchor, 'href=.([^<>]*).>', 1)")} AS link FROM listed)"""


@query(f"WITH {_LINKS_SQL} SELECT page_id, source, item_ord, title, link FROM links WHERE title <> ''")
def extract_links(spark, sf_dir):
    items = web_items(spread_scan(ad.landed_pages(spark, sf_dir)), ad.LINK_RULES)
    return titled(items).select("page_id", "source", "item_ord", "title", "link")


_WORDS_SQL = "words(keyword_ord, keyword) AS (VALUES {})".format(
    ", ".join(f"({at}, '{word}')" for at, word in enumerate(ad.PAGE_KEYWORDS))
)


@query(f"""WITH {_LINKS_SQL}, {_WORDS_SQL}, hits AS (
  SELECT l.page_id, l.item_ord, min(w.keyword_ord) AS keyword_ord FROM links l
  JOIN words w ON contains(lower(l.title), w.keyword) WHERE l.title <> '' GROUP BY ALL),
matched AS (SELECT l.*, w.keyword FROM links l JOIN hits h USING (page_id, item_ord) JOIN words w USING (keyword_ord))
SELECT source, 'web' AS source_type, keyword, link AS post_id, title AS text, link AS url,
       '{{"source_url":"' || url || '"}}' AS raw FROM matched
QUALIFY row_number() OVER (PARTITION BY source, link ORDER BY page_id, item_ord) = 1""")
def web_page_posts(spark, sf_dir):
    """The whole web path: pages, rules, items, keywords, post records, first copy of each."""
    posts = web_posts(spread_scan(ad.landed_pages(spark, sf_dir)), ad.LINK_RULES, ad.PAGE_KEYWORDS)
    return _once(posts).select("source", "source_type", "keyword", "post_id", "text", "url", "raw")


def _text_items_sql(suffix: str, pattern: str) -> str:
    return f"""WITH blocks AS (SELECT page_id, {_TOP} || '_{suffix}' AS source,
  regexp_extract_all(html, '{pattern}', 1) AS found FROM pages),
listed AS (SELECT page_id, source, unnest(found) AS body, generate_subscripts(found, 1) - 1 AS item_ord FROM blocks),
decoded AS (SELECT page_id, source, CAST(item_ord AS INTEGER) AS item_ord, trim({ad.sql_unescaped('body')}) AS title
            FROM listed)
SELECT page_id, source, item_ord, title, substring(title, 1, 60) AS post_id FROM decoded WHERE title <> ''"""


def _text_items(spark, sf_dir, rules) -> DataFrame:
    items = titled(web_items(spread_scan(ad.landed_pages(spark, sf_dir)), rules))
    post_id = tx.or_else(F.col("link"), tx.title_key(F.col("title")))
    return items.select("page_id", "source", "item_ord", "title", post_id.alias("post_id"))


@query(_text_items_sql("titles", "<article><h1>([^<]*)</h1>"))
def extract_titles(spark, sf_dir):
    """Headlines: items without a link, known by the start of their title."""
    return _text_items(spark, sf_dir, ad.TITLE_RULES)


@query(_text_items_sql("ads", '<div class="ad">([^<]*)</div>'))
def extract_blocks(spark, sf_dir):
    return _text_items(spark, sf_dir, ad.AD_RULES)


@query(f"""SELECT page_id, {_TOP} || '_pages' AS source, {_HOST} AS host, {_ORIGIN} || '/read/1?a=2' AS next
FROM pages""", name="pages_by_rule")
def rules_of_pages(spark, sf_dir):
    pages = ad.landed_pages(spark, sf_dir).select("page_id", "url")
    return pages_by_rule(pages, ad.LINK_RULES).select(
        "page_id", "source", host_of(F.col("url")).alias("host"),
        resolve_link(F.col("url"), F.lit("/x/./y/../../read/1?a=2")).alias("next"),
    )


@query(f"""WITH health AS (SELECT {_TOP} || '_pages' AS source, count(*) AS pages,
  count(*) FILTER (WHERE url LIKE '%utm_source%') AS failed FROM pages GROUP BY ALL)
SELECT source, pages, failed, failed / CAST(pages AS DOUBLE) AS error_rate,
  failed / CAST(pages AS DOUBLE) > 0.17 AS is_open FROM health""")
def extract_error_rate(spark, sf_dir):
    """Pages whose address carries a campaign tag count as failed fetches; error rate and breaker per source."""
    pages = ad.landed_pages(spark, sf_dir)
    landed = pages.withColumn("html", F.when(~F.col("url").contains("utm_source"), F.col("html")))
    return source_health(web_items(spread_scan(landed), ad.LINK_RULES), 0.17)


_CARD_ROWS = """cards AS (SELECT event_id, event_type AS keyword, CAST(props->>'k' AS BIGINT) AS k, 'user' || user_id AS author,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS created_at FROM events),
valid AS (SELECT keyword, CAST(event_id AS VARCHAR) AS post_id, event_id,
  keyword || ' <' || k || '> by ' || author AS text, author, created_at,
  'https://x.com/' || author || '/status/' || event_id
    || CASE WHEN k < 30 THEN '/photo/1' WHEN k < 60 THEN '?s=20&t=a' ELSE '' END AS url
  FROM cards WHERE k >= 15)"""


@query(f"WITH {_CARD_ROWS} SELECT keyword, post_id, text, author, created_at, url FROM valid")
def extract_cards(spark, sf_dir):
    """All valid cards of the rendered pages."""
    cards = valid_cards(card_items(spread_scan(ad.card_pages(spark, sf_dir))))
    return cards.select(
        "keyword", tx.status_id(F.col("_status")).alias("post_id"), "text", "author", "created_at",
        tx.on_social_host(F.col("_status")).alias("url"),
    )


@query(f"""WITH {_CARD_ROWS} SELECT 'x' AS source, 'social' AS source_type, keyword, post_id, text, url, author, created_at,
'en' AS lang, '{{}}' AS raw FROM valid WHERE keyword IN ('signup', 'error', 'view')
QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY event_id) <= 50""")
def search_cards(spark, sf_dir):
    """Search over rendered pages: the cap counts valid cards only."""
    posts = card_posts(spread_scan(ad.card_pages(spark, sf_dir)), ["signup", "error", "view"], "en", ad.SEARCH_LIMIT)
    return _once(posts).drop("scraped_at", "arrival_major", "arrival_minor")


# ---- sinks and streams ----


@query(f"""WITH {ad.SQL_FIRST} SELECT source, source_type, keyword, post_id, text, url, '' AS author, '' AS created_at,
lang, '{{"source_url":"' || url || '"}}' AS raw, strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS scraped_at,
source AS for_source, '20240601' AS day, 'b1' AS batch FROM first_match""")
def jsonl_roundtrip(spark, sf_dir):
    out = new_path(spark, "jsonl")
    for _ in range(2):  # the second write stands for a replay of the batch
        write_jsonl(ad.document_posts(_matched(spark, sf_dir)), out, "b1", "20240601")
    return read_jsonl(spark, out)


@query("""SELECT sink, 'x' AS source, CAST(event_id AS VARCHAR) AS post_id, event_type AS keyword,
'https://x.com/i/web/status/' || event_id AS url, date_trunc('second', ts) AS created_at
FROM events, (VALUES ('jsonl'), ('table')) sinks(sink)""")
def stream_ingest_dedup(spark, sf_dir):
    """Every event is landed twice over several files and micro-batches, and the landing is read by a second stream
    into the same output; table and lines hold each event once."""
    events = ad.table(spark, sf_dir, "events")
    landing, table, work = (new_path(spark, name) for name in ("landing", "table", "stream"))
    twice = events.union(events)
    files = landed_files(twice, 4)
    twice.repartition(files).write.parquet(landing)

    def to_posts(batch: DataFrame) -> DataFrame:
        items = batch.select(*ad.social_columns(), F.col("event_type").alias("keyword"))
        return social_record(items, extra=arrival(F.lit(0), F.col("id")))

    sinks = Sinks(f"{work}/jsonl", table)
    half = [F.col("event_id") % 2 == 0, F.lit(True)]
    for number, part in enumerate(half):
        stream = stream_landed(spark, landing, events.schema, files_per_trigger=files // 2).filter(part)
        start_ingest(stream, to_posts, sinks, f"{work}/checkpoint{number}").awaitTermination()
    columns = ["source", "post_id", "keyword", "url"]
    stored, lines = read_posts(spark, table), read_jsonl(spark, sinks.output_dir)
    stored = stored.select(F.lit("table").alias("sink"), *columns, "created_at")
    lines = lines.select(F.lit("jsonl").alias("sink"), *columns, parsed_time(F.col("created_at")).alias("created_at"))
    return stored.unionByName(lines).withColumn("created_at", utc_wall_time(F.col("created_at")))


@query("SELECT DISTINCT 'x' AS source, CAST(event_id AS VARCHAR) AS post_id, event_type AS keyword FROM events")
def stream_bounded_dedup(spark, sf_dir):
    """Events landed twice through the stateful dedup, with a delay longer than the table spans so none is late."""
    events = ad.table(spark, sf_dir, "events")
    landing, work = new_path(spark, "landing"), new_path(spark, "stream")
    twice = events.union(events)
    files = landed_files(twice, 4)
    twice.repartition(files).write.parquet(landing)
    stream = stream_landed(spark, landing, events.schema, files_per_trigger=files // 2)
    items = stream.select(*ad.social_columns(), F.col("event_type").alias("keyword"), "ts")
    posts = social_record(items, extra=[from_utc_wall_time(F.col("ts")).alias("seen_at")])
    once = drop_seen(posts.select("source", "post_id", "keyword", "seen_at"), "400 days", "seen_at")
    writer = once.writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint")
    writer.trigger(availableNow=True).start(f"{work}/out").awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{work}/out").drop("seen_at")


def _finished(stream) -> None:
    """Wait for a stream over what is there; one that does not end is an error, not an endless wait."""
    if not stream.awaitTermination(600):
        stream.stop()
        raise TimeoutError("the stream did not end")


@query("""SELECT 'x' AS source, CAST(event_id AS VARCHAR) AS post_id, event_type AS keyword,
CASE WHEN event_id % 2 = 0 THEN 1 ELSE 3 END AS copy FROM events""")
def stream_first_wins(spark, sf_dir):
    """Copies within a batch and over a restart: even events land twice, then the stream is started again and all land
    once more. The first copy of each passes."""
    events = ad.table(spark, sf_dir, "events").withColumn("copy", F.lit(1))
    landing, work = new_path(spark, "landing"), new_path(spark, "stream")
    even = events.filter("event_id % 2 = 0")
    parts = [even.unionAll(even.withColumn("copy", F.lit(2))), events.withColumn("copy", F.lit(3))]
    for number, part in enumerate(parts):
        files = landed_files(part, 2)
        part.repartition(files).write.parquet(f"{landing}/{number}")
        stream = stream_landed(spark, f"{landing}/*", events.schema, files_per_trigger=4 * files)
        items = stream.select(*ad.social_columns(), F.col("event_type").alias("keyword"), "copy")
        posts = social_record(items, extra=["copy"]).select("source", "post_id", "keyword", "copy")
        with rocksdb_state(spark):
            writer = first_across_batches(posts, ["copy"], 86_400_000).writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint")
            _finished(writer.trigger(availableNow=True).start(f"{work}/out"))
    return spark.read.schema("source string, post_id string, keyword string, copy int").parquet(f"{work}/out")


@query("""SELECT CAST(event_id AS VARCHAR) AS id, event_type AS keyword FROM events WHERE event_id % 3 <> 0""")
def stream_unscored(spark, sf_dir):
    """Events as posts, every third scored five minutes later and some of the others too late; rows of a later century
    move both watermarks on, and the stream is started once more, which must not repeat anything."""
    events = ad.table(spark, sf_dir, "events")
    landing, work = new_path(spark, "landing"), new_path(spark, "stream")
    posts = events.select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("keyword"), from_utc_wall_time(F.col("ts")).alias("scraped_at"))
    wait = F.when(F.col("event_id") % 3 == 0, F.expr("INTERVAL 5 MINUTES")).otherwise(F.expr("INTERVAL 5 HOURS"))
    scores = events.filter("event_id % 3 <> 1").select(
        F.col("event_id").cast("string").alias("id"), F.lit("neutral").alias("sentiment_label"), (from_utc_wall_time(F.col("ts")) + wait).alias("analyzed_at")
    )
    posts.write.parquet(f"{landing}/posts/0")
    scores.write.parquet(f"{landing}/scores/0")
    for number in range(3):
        sides = [stream_landed(spark, f"{landing}/{name}/*", frame.schema) for name, frame in (("posts", posts), ("scores", scores))]
        writer = unscored_after(*sides, "10 minutes").writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint")
        _finished(writer.trigger(availableNow=True).start(f"{work}/out"))
        late = F.lit(f"{2100 + number}-01-01 00:00:00").cast("timestamp")
        posts.limit(1).select(F.lit("later").alias("id"), "keyword", late.alias("scraped_at")).write.mode("append").parquet(f"{landing}/posts/{number + 1}")
        scores.limit(1).select(F.lit("later").alias("id"), "sentiment_label", late.alias("analyzed_at")).write.mode("append").parquet(f"{landing}/scores/{number + 1}")
    return spark.read.schema(posts.schema).parquet(f"{work}/out").select("id", "keyword")


@query(f"WITH {ad.SQL_SCORED} {_SUMMARY_SQL}".replace("/ 10.0", "/ CAST(10 AS DOUBLE)"))
def summary_kept_up_to_date(spark, sf_dir):
    """Posts and scores in several batches: one score batch comes before its posts, one scores all posts wrongly, some
    with no label at all, and the right scores come last. The summary is added up from the differences."""
    path = new_path(spark, "table")
    batch, _ = staged(_once(_arrived(spark, sf_dir)), "incoming")
    right = _score_rows(spark, sf_dir, "timestamp").withColumn("even", F.crc32("id") % 2 == 0)
    label = F.when(F.crc32("id") % 3 == 0, F.lit("negative")).when(F.crc32("id") % 3 == 1, F.lit("mixed"))
    wrong = right.withColumns({"sentiment_label": label, "sentiment_score": F.lit(0.125).cast("decimal(5,4)"), "analyzed_at": F.lit("2024-05-01 00:00:00").cast("timestamp")})
    add_scores(right.filter("even"), path, "early")
    for number, part in enumerate((F.col("lang") == "en", F.col("lang") != "en")):
        rows = batch.filter(part)
        count_inserted(to_stored(rows), path, str(number))
        insert_posts(rows, path, str(number))
        add_scores(wrong, path, f"wrong-{number}")
    add_scores(right.filter("NOT even"), path, "right")
    summary = _summary_row(read_summary(spark, path))
    return summary.withColumn("last_scraped", utc_wall_time(F.col("last_scraped")))


@query(f"""WITH {ad.SQL_FIRST} SELECT source, post_id, keyword FROM first_match
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def pending_poll(spark, sf_dir):
    """The work queue when scores are kept in a table of their own."""
    posts = _matched(spark, sf_dir).select(
        tx.record_id(F.col("source"), F.col("post_id")).alias("id"), "source", "post_id", "keyword",
        F.lit(None).cast("string").alias("sentiment_label"),
    )
    return unscored(posts, _score_rows(spark, sf_dir, "timestamp")).select("source", "post_id", "keyword")


@query(f"""WITH {ad.SQL_FIRST}, sinks(sink) AS (VALUES ('jsonl'), ('table'))
SELECT sink, source, post_id, keyword, text FROM first_match, sinks""")
def stream_fanout_equals_batch(spark, sf_dir):
    """Documents through the stream to both sinks; both hold what the batch match gives."""
    documents = ad.table(spark, sf_dir, "documents")
    landing, work = new_path(spark, "landing"), new_path(spark, "stream")
    files = landed_files(documents, 3)
    documents.repartition(files).write.parquet(f"{landing}/documents.parquet")
    table, out = f"{work}/table", f"{work}/jsonl"

    def to_posts(batch: DataFrame) -> DataFrame:
        found = match_all(ad.document_items(batch), "text", ad.KEYWORDS)
        return ad.document_posts(found, extra=arrival(F.col("keyword_ord"), F.lit(0)))

    stream = stream_landed(spark, f"{landing}/documents.parquet", documents.schema, files_per_trigger=files // 3 * 2)
    start_ingest(stream, to_posts, Sinks(out, table), f"{work}/checkpoint").awaitTermination()
    columns = ["source", "post_id", "keyword", "text"]
    from_table = read_posts(spark, table).select(F.lit("table").alias("sink"), *columns)
    return from_table.unionByName(read_jsonl(spark, out).select(F.lit("jsonl").alias("sink"), *columns))


# ---- whole runs ----

_RUN_SQL = f"""{_LINKS_SQL}, words(keyword_ord, keyword) AS (VALUES {_RUN_WORDS}),
web_hits AS (SELECT l.page_id, l.item_ord, min(w.keyword_ord) AS keyword_ord FROM links l
  JOIN words w ON contains(lower(l.title), w.keyword) WHERE l.title <> '' GROUP BY ALL),
found AS (
  SELECT source, 'web' AS source_type, keyword, link AS post_id, title AS text, page_id AS major, item_ord AS minor
  FROM links JOIN web_hits USING (page_id, item_ord) JOIN words USING (keyword_ord)
  UNION ALL (SELECT 'x', 'social', keyword, CAST(event_id AS VARCHAR), event_type || ' ' || props, keyword_ord, 0
    FROM events JOIN words ON contains(lower(event_type || ' ' || props), keyword) WHERE event_id % 3 <> 2
    QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY date_trunc('second', ts) DESC, event_id) <= {ad.SEARCH_LIMIT})
  UNION ALL (SELECT 'youtube', 'social', keyword, {_TURN}, text, keyword_ord, 0
    FROM conversations JOIN words ON contains(lower('video ' || conv_id || ' ' || text), keyword) WHERE role = 'assistant'
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY keyword_ord) = 1)
  UNION ALL (SELECT CASE WHEN quality = 1 THEN 'tokopedia' ELSE 'shopee' END, 'web', coalesce(keyword, source),
      'r' || doc_id, CASE WHEN length(text) >= 200 THEN text END, coalesce(keyword_ord, {len(RUN_KEYWORDS)}), 0
    FROM documents JOIN labels USING (doc_id) LEFT JOIN words
      ON contains(lower(source || ' ' || CASE WHEN length(text) >= 200 THEN text ELSE '' END), keyword)
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY keyword_ord) = 1)),
kept AS (SELECT * FROM found WHERE text IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source, post_id ORDER BY major, minor) = 1)"""


def _run(spark: SparkSession, sf_dir: str) -> tuple[RunReport, RunConfig]:
    """A whole run over four families: events landed twice and partly without a language, reviews without a text."""
    work = new_path(spark, "run")
    config = RunConfig(
        keywords=RUN_KEYWORDS, max_per_keyword=ad.SEARCH_LIMIT, rules=ad.LINK_RULES,
        output_dir=f"{work}/lines", table_dir=f"{work}/table",
    )
    number = F.col("id") % 3
    spoken = F.when(number == 1, "id").when(number == 2, "en")  # the others name no language
    items = ad.social_items(spark, sf_dir).drop("keyword").withColumn("lang", spoken)
    reviews = ad.reviews(spark, sf_dir).withColumn("body", F.when(F.length("body") >= 200, F.col("body")))
    inputs = {
        "x": lambda _: items.unionAll(items),
        "web": lambda _: ad.landed_pages(spark, sf_dir),
        "youtube": lambda _: ad.video_comments(spark, sf_dir),
        "ecommerce": lambda _: reviews,
    }
    return run(spark, config, inputs), config


@query(f"""WITH {_RUN_SQL} SELECT sink, source, source_type, keyword, post_id, text
FROM kept, (VALUES ('jsonl'), ('table')) sinks(sink)""")
def pipeline_run(spark, sf_dir):
    """What a whole run leaves in the table and in the lines."""
    _, config = _run(spark, sf_dir)
    columns = ["source", "source_type", "keyword", "post_id", "text"]
    stored = read_posts(spark, config.table_dir).select(F.lit("table").alias("sink"), *columns)
    return stored.unionByName(read_jsonl(spark, config.output_dir).select(F.lit("jsonl").alias("sink"), *columns))


@query(f"""WITH {_RUN_SQL} SELECT (SELECT count(*) FROM kept WHERE source_type = 'social') AS social,
(SELECT count(*) FROM kept WHERE source_type = 'web') AS web,
(SELECT count(*) FROM found WHERE text IS NOT NULL) - (SELECT count(*) FROM kept) AS duplicates,
(SELECT count(*) FROM found WHERE text IS NULL) AS rejected, CAST(0 AS BIGINT) AS failed""")
def pipeline_run_report(spark, sf_dir):
    """The counters of a whole run."""
    report, _ = _run(spark, sf_dir)
    row = (report.social, report.web, report.duplicates, report.rejected, len(report.failed))
    return spark.createDataFrame([row], "social bigint, web bigint, duplicates bigint, rejected bigint, failed bigint")


_HEALTH_WORDS = "words(keyword_ord, keyword, tag) AS (VALUES (0, 'view error', '#viewerror'), (1, 'the', NULL), (2, 'and', NULL))"


@query(f"""WITH {_LINKS_SQL}, {_HEALTH_WORDS}, landed AS (
  SELECT {_TOP} || '_pages' AS source, count(*) AS pages, count(*) FILTER (WHERE html IS NULL) AS failed FROM pages GROUP BY 1),
items AS (SELECT source, link, title, bool_or(contains(lower(title), keyword)) AS hit FROM links, words WHERE title <> ''
  GROUP BY page_id, item_ord, source, link, title),
counted AS (SELECT source, count(*) AS found, count(*) FILTER (WHERE hit) AS matched, count(DISTINCT link) FILTER (WHERE hit) AS kept
  FROM items GROUP BY source),
web AS (SELECT source, pages, failed, coalesce(found, 0) AS found, coalesce(matched, 0) AS matched, failed AS rejected, coalesce(kept, 0) AS kept
  FROM landed LEFT JOIN counted USING (source) WHERE source IN ('com_pages', 'org_pages')),
videos AS (SELECT {_TURN} AS id, lower(text || CASE WHEN conv_id % 3 = 0 THEN ' #ViewError' ELSE '' END) AS body
  FROM conversations WHERE role = 'system'),
tiktok AS (SELECT 'tiktok', count(*) AS pages, 0, count(*) AS found, count(*) FILTER (WHERE hit) AS matched, 0, count(DISTINCT id) FILTER (WHERE hit) AS kept
  FROM (SELECT id, bool_or(contains(body, keyword) OR (tag IS NOT NULL AND contains(body, tag))) AS hit FROM videos, words GROUP BY id)),
good AS (SELECT * FROM web UNION ALL SELECT 'org_again', pages, failed, found, matched, rejected, kept FROM web WHERE source = 'org_pages'
  UNION ALL SELECT * FROM tiktok),
runs AS (SELECT run, g.* FROM good g, (VALUES (1), (2), (3)) runs(run) WHERE run < 3 OR source = 'tiktok'
  UNION ALL SELECT 1, source, pages, pages, 0, 0, pages, 0 FROM landed WHERE source = 'net_pages'
  UNION ALL SELECT 1, 'instagram', 1, 1, 0, 0, 0, 0
  UNION ALL SELECT 2, source, 0, 0, 0, 0, 0, 0 FROM (VALUES ('net_pages'), ('instagram')) left_out(source))
SELECT CAST(run AS BIGINT) AS run, source, CASE WHEN run = 2 AND source IN ('net_pages', 'instagram') THEN 'open' ELSE 'closed' END AS state,
  pages, failed, found, matched, rejected, kept FROM runs""")
def pipeline_run_sources(spark, sf_dir):
    """Three runs into one output, a row per source of each: a rule whose pages cannot be read and a family that fails
    are left out of the second, the third is for one family only. One rule is added to the others, and a keyword of
    two words is also found as a hashtag."""
    work = new_path(spark, "run")
    broken = F.when(~host_of(F.col("url")).endswith(".net"), F.col("html"))
    pages = ad.landed_pages(spark, sf_dir).withColumn("html", broken)
    tag = F.when(F.split("id", "-")[0].cast("bigint") % 3 == 0, F.lit(" #ViewError")).otherwise(F.lit(""))
    videos = ad.short_videos(spark, sf_dir).withColumn("body", F.concat("body", tag))
    inputs = {
        "web": lambda _: pages,
        "tiktok": lambda _: videos,
        "instagram": lambda _: ad.captions(spark, sf_dir).withColumn("body", F.raise_error(F.lit("no captions landed")).cast("string")),
    }
    rules = [*ad.LINK_RULES, Rule("org_again", "https://example.org/", "nav li a", "::text", "::attr(href)")]
    given = {"keywords": "View Error, the, ,and", "output_dir": f"{work}/lines", "table_dir": f"{work}/table", "rules": rules, "strikes": 1}
    for choice in ("all", "all", "tiktok"):
        config = resolve_config({**given, "source": choice})
        run(spark, config, inputs)
    records = read_health(spark, health_path(config))
    number = F.dense_rank().over(Window.orderBy("run_at")).cast("long")  # one row per run and source
    return records.select(number.alias("run"), "source", "state", *COUNTS)


@query("""WITH RECURSIVE records AS (
  SELECT event_type || user_id % 10 AS source, row_number() OVER (PARTITION BY event_type || user_id % 10 ORDER BY date_trunc('day', ts)) AS run,
         count(*) AS pages, count(*) FILTER (WHERE event_id % 7 < 3) AS failed FROM events GROUP BY event_type || user_id % 10, date_trunc('day', ts)),
folded(source, run, state, strikes, waited) AS (
  SELECT DISTINCT source, CAST(0 AS BIGINT), 'closed', 0, 0 FROM records
  UNION ALL
  SELECT f.source, r.run,
    CASE WHEN f.state = 'closed' THEN CASE WHEN failed * 2 > pages AND strikes + 1 >= 2 THEN 'open' ELSE 'closed' END
         WHEN f.state = 'open' THEN CASE WHEN waited + 1 >= 2 THEN 'half_open' ELSE 'open' END
         WHEN failed * 2 > pages THEN 'open' ELSE 'closed' END,
    CASE WHEN f.state = 'open' THEN strikes WHEN failed * 2 <= pages THEN 0 WHEN f.state = 'closed' THEN strikes + 1 ELSE strikes END,
    CASE WHEN f.state = 'open' THEN waited + 1 ELSE 0 END
  FROM folded f JOIN records r ON r.source = f.source AND r.run = f.run + 1)
SELECT source, state, strikes, waited FROM folded QUALIFY row_number() OVER (PARTITION BY source ORDER BY run DESC) = 1""")
def source_breaker(spark, sf_dir):
    """Events as the daily health records of fifty sources, and where the breaker of each stands after them."""
    source = F.concat("event_type", (F.col("user_id") % 10).cast("string")).alias("source")
    records = ad.table(spark, sf_dir, "events").groupBy(source, F.date_trunc("day", "ts").alias("run_at")).agg(
        F.count("*").alias("pages"), F.count_if(F.col("event_id") % 7 < 3).alias("failed")
    )
    return breaker_states(records, strikes=2, wait=2)
