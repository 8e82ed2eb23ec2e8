"""Matching, duplicates, caps, validity, extraction and reports on small frames."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mentionflow.operators import dedup, match, reports, validity
from mentionflow.operators.reports import apply_scores, pending_analysis
from mentionflow.operators.extract import source_health
from mentionflow.operators.filters import keep_where
from mentionflow.schema import CARD_PAGE, PAGE, POST, STORED_POST
from mentionflow.sources.posts import card_posts, titled, web_items, web_posts
from mentionflow.sources.rules import DEFAULT_RULES, Rule, checked_rules, pages_by_rule


def plan_of(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


# ---- matching ----

TITLES = ["Economy of the POLICY", "ECONOMYwide", "nothing", "", "technology, news", None, "NEWS"]


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame([(n, title) for n, title in enumerate(TITLES)], "n int, title string")


def expected_first(words):
    hits = {n: next((w for w in words if w.lower() in t.lower()), None) for n, t in enumerate(TITLES) if t is not None}
    return {n: word for n, word in hits.items() if word}


@pytest.mark.parametrize("extra", [0, 100])
def test_first_keyword_in_list_order(titles, extra):
    """Short lists are spelled out, long ones go through an array; both give the same."""
    words = ["News", "policy", "economy"] + [f"absent{n}" for n in range(extra)]
    got = {row["n"]: row["keyword"] for row in match.match_first(titles, "title", words).collect()}
    assert got == expected_first(words)
    kept = match.with_first_keyword(titles, "title", words).collect()
    assert {row["n"]: row["keyword"] for row in kept} == {n: got.get(n) for n in range(len(TITLES))}


@pytest.mark.parametrize("extra", [0, 100])
def test_keywords_as_hashtags(spark, extra):
    rows = [(0, "see #AcmeUtara"), (1, "acme  utara"), (2, "ACME UTARA"), (3, "#acme utara"), (4, "acmeutara")]
    frame = spark.createDataFrame(rows, "n int, title string")
    words = ["acme utara"] + [f"absent{n}" for n in range(extra)]
    assert {row["n"] for row in match.match_first(frame, "title", words, tagged=True).collect()} == {0, 2, 3}
    assert {row["n"] for row in match.match_first(frame, "title", words).collect()} == {2, 3}


@pytest.mark.parametrize("extra", [0, 100])
def test_all_keywords(titles, extra):
    words = ["News", "policy", "economy", "technology"] + [f"absent{n}" for n in range(extra)]
    got = {(row["n"], row["keyword_ord"], row["keyword"]) for row in match.match_all(titles, "title", words).collect()}
    want = {
        (n, at, word)
        for n, title in enumerate(TITLES)
        for at, word in enumerate(words)
        if title is not None and word.lower() in title.lower()
    }
    assert got == want


def test_keywords_are_needed(titles):
    with pytest.raises(ValueError):
        match.match_first(titles, "title", [" ", ""])


def long_lists():
    words = [f"{a}{b}" for a in "abcdé" for b in ("", "a", "ab", "bca", " d", "ÉÜ")]
    return words + [f"x{at}" for at in range(40)] + ["a", "AB"]


@pytest.mark.parametrize("tagged", [False, True])
def test_long_lists_give_the_rows_of_spelled_out_tests(spark, monkeypatch, tagged):
    draw = random.Random(4)
    texts = ["".join(draw.choices("abcdéAÉü x19#", k=draw.randint(0, 40))) for _ in range(200)] + [None, "", "x39", "#bd b d", "a\x00ab\U0001f600ab"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, title string").withColumn("keyword", F.lit("old"))
    words = long_lists()

    def rows():
        both = [match.match_all(frame, "title", words), match.match_first(frame, "title", words, tagged=tagged), match.with_first_keyword(frame, "title", words)]
        return [sorted((row["n"], str(row["keyword_ord"]), str(row["keyword"])) for row in one.collect()) for one in both]

    assert len(words) > match.INLINE_KEYWORDS
    by_automaton = rows()
    monkeypatch.setattr(match, "INLINE_KEYWORDS", 1000)
    assert by_automaton == rows() and len(by_automaton[2]) == len(texts)


def test_long_lists_are_searched_once(titles):
    for found in (match.match_all, match.match_first, match.with_first_keyword):
        plan = found(titles, "title", long_lists())._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, plan


def test_matching_neither_joins_nor_shuffles(titles):
    plan = plan_of(match.match_all(titles, "title", ["news", "policy"]))
    assert "Join" not in plan and "Exchange" not in plan


def test_computed_test_is_not_pushed_into_the_projection(titles):
    folded = titles.withColumn("low", F.lower("title"))
    kept = keep_where(folded, F.col("low").contains("news") & (F.col("n") > 0))
    assert sorted(row["n"] for row in kept.collect()) == [4, 6]
    assert plan_of(kept).count("lower(") == 1


# ---- duplicates and caps ----


def copies(spark, total, seed=1):
    """Posts of which a third share one key."""
    rng = random.Random(seed)
    rows = []
    for n in range(total):
        hot = n % 3 == 0
        rows.append(("hot" if hot else f"s{rng.randrange(5)}", "p" if hot else f"p{rng.randrange(40)}", rng.random(), n))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "source string, post_id string, arrived double, n int").repartition(7)


def test_first_wins_with_a_hot_key(spark):
    rows, frame = copies(spark, 3000)
    want = {}
    for source, post_id, arrived, n in sorted(rows, key=lambda row: (row[2], row[3])):
        want.setdefault((source, post_id), n)
    once = dedup.first_wins(frame, ["arrived", "n"])
    assert {(row["source"], row["post_id"]): row["n"] for row in once.collect()} == want
    assert plan_of(once).count("WindowGroupLimit") >= 2


def test_keys_are_pairs(spark):
    frame = spark.createDataFrame([("a:b", "c", 1), ("a", "b:c", 2), ("x", "c", 3)], "source string, post_id string, n int")
    assert dedup.first_wins(frame, ["n"]).count() == 3


@pytest.mark.parametrize("limit", [1, 3, 1500])
def test_cap_per_keyword(spark, limit):
    rng = random.Random(limit)
    rows = [("hot" if n % 3 else f"k{n % 5}", f"p{n}", rng.randrange(50)) for n in range(6000)]
    frame = spark.createDataFrame(rows, "keyword string, post_id string, at int").repartition(5)
    got = dedup.cap_per_keyword(frame, limit, [F.col("at").desc(), F.col("post_id")], rank="place")
    want = set()
    for keyword in {row[0] for row in rows}:
        mine = sorted((row for row in rows if row[0] == keyword), key=lambda row: (-row[2], row[1]))
        want |= {(*row, place) for place, row in enumerate(mine[:limit], 1)}
    assert {tuple(row) for row in got.collect()} == want


def test_cap_must_be_positive(spark):
    with pytest.raises(ValueError):
        dedup.cap_per_keyword(spark.range(1), 0, ["id"])


def test_cap_is_salted_at_any_size(spark):
    frame = spark.range(10).select(F.lit("k").alias("keyword"), F.col("id").alias("post_id"))
    plan = plan_of(dedup.cap_per_keyword(frame, 50, ["post_id"]))
    assert "_salt" in plan and plan.count("Window (") + plan.count(") Window") >= 3


def test_counters(spark):
    rows = [("x", "social", "1"), ("x", "social", "1"), ("x", "social", "2"), ("w", "web", "1"), ("w", "web", "1")]
    frame = spark.createDataFrame(rows, "source string, source_type string, post_id string")
    assert dedup.run_counters(frame).first().asDict() == {"social": 2, "web": 1, "duplicates": 2}
    assert dedup.run_counters(frame.limit(0)).first().asDict() == {"social": 0, "web": 0, "duplicates": 0}


def test_counting_combines_before_the_shuffle(spark):
    _, frame = copies(spark, 10)
    assert "SortAggregate" not in plan_of(dedup.run_counters(frame.withColumn("source_type", F.lit("web"))))


# ---- validity ----


def test_faults_are_named(spark):
    good = dict.fromkeys(POST.names, "v") | {"source_type": "web", "scraped_at": "2026-01-01T00:00:00Z"}
    rows = [good, good | {"source_type": "forum"}, good | {"text": None, "source": None}, good | {"url": None},
            good | {"source": ""}]
    frame = spark.createDataFrame([tuple(row[name] for name in POST.names) for row in rows], POST)
    assert validity.valid_rows(frame).count() == 2
    reasons = sorted(tuple(row["reason"]) for row in validity.rejected_rows(frame).collect())
    assert reasons == [("source is empty",), ("source is null", "text is null"), ("source_type is not social or web",)]


# ---- extraction ----

RULES = (
    Rule("news", "https://www.example.org/", "article.item", "h3 a::text", "h3 a::attr(href)"),
    Rule("blog", "https://blog.example.org/", "a[href*='/read/']", "::text", "::attr(href)"),
)
NEWS = """<article class="item"><h3><a href="/n/1"> Economy  up </a></h3></article>
<article class="item"><h3><a>Policy without a link, and long enough to be cut somewhere after sixty characters é</a></h3></article>
<article class="item"><h3><a href="/n/3"> </a></h3></article><article class="item">no title</article>
<article class="item"><h3><a href="/n/4">Weather</a></h3></article>"""
BLOG = '<a href="../read/1?x=1&amp;y=2">The ECONOMY</a><a href="/about">economy</a><a href="//o.org/read/2">policy</a>'


def page_frame(spark):
    rows = [
        (1, "https://example.org/start", NEWS),
        (2, "https://blog.example.org/a/b/c", BLOG),
        (3, "https://other.net/", BLOG),
        (4, "https://blog.example.org/empty", "<p>nothing"),
        (5, "https://blog.example.org/failed", None),
    ]
    return spark.createDataFrame(rows, PAGE)


def test_rules_apply_to_their_host_and_its_subdomains(spark):
    got = {(row["page_id"], row["source"]) for row in pages_by_rule(page_frame(spark), RULES).collect()}
    assert got == {(1, "news"), (2, "news"), (2, "blog"), (4, "news"), (4, "blog"), (5, "news"), (5, "blog")}


def test_default_rules_are_readable():
    assert len(checked_rules(DEFAULT_RULES)) == 5
    with pytest.raises(ValueError):
        checked_rules([Rule("x", "https://a.org/", "a", "::text", "::attr(href)")])
    with pytest.raises(ValueError):
        checked_rules([Rule("n", "https://a.org/", "a:hover", "::text", "::attr(href)")])


def test_more_rules_need_no_code(spark):
    rules = (*DEFAULT_RULES, *RULES)
    assert web_posts(page_frame(spark), rules, ["economy"]).count() == 2


def test_web_path(spark):
    posts = web_posts(page_frame(spark), RULES, ["policy", "economy"]).collect()
    got = {(p["source"], p["keyword"], p["post_id"], p["text"], p["url"], p["raw"]) for p in posts}
    long = "Policy without a link, and long enough to be cut somewhere after sixty characters é"
    start, deep = '{"source_url":"https://example.org/start"}', '{"source_url":"https://blog.example.org/a/b/c"}'
    assert got == {
        ("news", "economy", "https://example.org/n/1", "Economy  up", "https://example.org/n/1", start),
        ("news", "policy", long[:60], long, "", start),
        ("blog", "economy", "https://blog.example.org/a/read/1?x=1&y=2", "The ECONOMY",
         "https://blog.example.org/a/read/1?x=1&y=2", deep),
        ("blog", "policy", "https://o.org/read/2", "policy", "https://o.org/read/2", deep),
    }
    assert {p["source_type"] for p in posts} == {"web"} and {p["lang"] for p in posts} == {"id"}


def test_bad_pages_are_reported_and_the_others_go_on(spark):
    items = web_items(page_frame(spark), RULES[1:])
    assert {(row["page_id"], row["error"]) for row in items.filter("item_ord is null").collect()} == {
        (4, None), (5, "no content"),
    }
    health = source_health(items, 0.3).first()
    assert (health["pages"], health["failed"], health["is_open"]) == (3, 1, True)
    assert titled(items).count() == 2


CARD = """<article data-testid="tweet"><a href="/"></a><a href="{author}">n</a>
<div data-testid="tweetText"><span> {text} </span>
<b> !</b></div><a href="{status}"><time datetime="2026-01-01T00:00:00.000Z"></time></a></article>"""


def test_cards_and_cap_on_valid_ones(spark):
    cards = [("/u1", "one", "/u1/status/1"), ("/u2", "", "/u2/status/2"), ("https://x.com/u", "three", "/u/status/x"),
             ("/u/status/4", "four", "https://x.com/u4/status/4?s=1"), ("/u5", "five", "/u5/status/5/photo/1")]
    html = "".join(CARD.format(author=a, text=t or " ", status=s).replace("<b> !</b>", "<b> !</b>" if t else "") for a, t, s in cards)
    frame = spark.createDataFrame([("ai", 0, html), ("ml", 0, html), ("off", 0, html), ("ai", 1, None)], CARD_PAGE)
    posts = card_posts(frame, ["ml", "ai"], "id", 2).orderBy("arrival_major", "arrival_minor").collect()
    got = [(p["keyword"], p["post_id"], p["text"], p["author"], p["url"], p["created_at"], p["raw"]) for p in posts]
    first = ("1", "one !", "u1", "https://x.com/u1/status/1", "2026-01-01T00:00:00.000Z", "{}")
    second = ("4", "four !", "", "https://x.com/u/status/4", "2026-01-01T00:00:00.000Z", "{}")
    assert got == [("ml", *first), ("ml", *second), ("ai", *first), ("ai", *second)]


# ---- reports ----


def stored(spark, rows):
    """Rows of (source, post_id, keyword, label, score, minute)."""
    full = []
    for source, post_id, keyword, label, score, minute in rows:
        at = datetime(2026, 1, 1, 0, minute)
        values = dict(
            id=f"{source}-{post_id}", source=source, source_type="web", keyword=keyword, post_id=post_id, text="t",
            lang="id", raw='{"star_rating":4}', scraped_at=at, sentiment_label=label,
            sentiment_score=None if score is None else Decimal(score), scraped_date=at.date(),
        )
        full.append(tuple(values.get(name) for name in STORED_POST.names))
    return spark.createDataFrame(full, STORED_POST)


def test_summary_edges(spark):
    rows = [("a", f"{n}", "k", "positive" if n == 0 else "negative", "0.5000", n) for n in range(16)]
    rows += [("b", "1", "k", "mixed", None, 1), ("b", "2", "k", "neutral", "0.1000", 5), ("c", "1", "k", None, None, 1)]
    got = [tuple(row) for row in reports.sentiment_summary(stored(spark, rows)).collect()]
    assert got == [
        ("k", "a", 16, 1, 0, 15, Decimal("6.3"), Decimal("0.5"), datetime(2026, 1, 1, 0, 15)),
        ("k", "b", 2, 0, 1, 0, Decimal("0.0"), Decimal("0.1"), datetime(2026, 1, 1, 0, 5)),
    ]


def test_queue_order_and_views(spark):
    rows = [("a", "1", "k", None, None, 9), ("a", "2", "k", None, None, 3), ("a", "3", "k", "neutral", "0.5", 1)]
    posts = stored(spark, rows)
    reports.register_views(posts)
    assert [row["post_id"] for row in spark.sql("select post_id from pending_analysis order by scraped_at").collect()] == ["2", "1"]
    assert [row["post_id"] for row in reports.latest_unanalyzed(posts, 1).collect()] == ["1"]
    assert spark.sql("select total from sentiment_summary").first()[0] == 1
    assert [row["post_id"] for row in reports.by_source(posts, "a", 2).collect()] == ["1", "2"]


def test_scores_fill_in_and_the_last_one_counts(spark):
    posts = stored(spark, [("a", "1", "k", None, None, 1), ("a", "2", "k", "neutral", "0.3", 1), ("a", "3", "k", None, None, 1)])
    t1, t2 = datetime(2026, 1, 2), datetime(2026, 1, 3)
    scores = spark.createDataFrame(
        [("a-1", "positive", Decimal("0.9"), t2), ("a-1", "negative", Decimal("0.8"), t1), ("zz", "negative", None, t1)],
        "id string, sentiment_label string, sentiment_score decimal(5,4), analyzed_at timestamp",
    )
    got = {r["post_id"]: (r["sentiment_label"], r["analyzed_at"]) for r in reports.apply_scores(posts, scores).collect()}
    assert got == {"1": ("positive", t2), "2": ("neutral", None), "3": (None, None)}


def test_source_without_items_is_reported(spark):
    items = spark.createDataFrame([("a", "k"), ("a", None), ("b", None)], "source string, keyword string")
    got = {tuple(row) for row in reports.source_yield(items, ["a", "b", "c"]).collect()}
    assert got == {("a", 2, 1, False), ("b", 1, 0, True), ("c", 0, 0, True)}


def test_star_rating(spark):
    posts = stored(spark, [("a", "1", "k", "positive", None, 1), ("a", "2", "k", None, None, 1)])
    assert reports.with_star_rating(posts, 4).count() == 2 and reports.with_star_rating(posts, 5).count() == 0
    assert [tuple(row) for row in reports.rating_against_label(posts).collect()] == [(4, "positive", 1)]


def test_pending_texts_are_in_no_join(spark):
    """With the scores kept apart the queue is that of `apply_scores`, and the texts move in the sort alone."""
    when = F.lit("2026-01-01 00:00:00").cast("timestamp")
    posts = spark.range(40).select(
        F.concat(F.lit("p"), F.col("id") % 37).alias("id"), F.lit("a").alias("source"), F.lit("web").alias("source_type"), F.lit("k").alias("keyword"),
        F.col("id").cast("string").alias("post_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 5 > 0, when + F.make_dt_interval(F.col("id").cast("int") % 7)).alias("scraped_at"),
        F.lit(None).cast("string").alias("sentiment_label"), F.lit(None).cast("decimal(5,4)").alias("sentiment_score"), F.lit(None).cast("timestamp").alias("analyzed_at"),
    )
    scores = spark.range(60).select(
        F.concat(F.lit("p"), F.col("id") % 20).alias("id"), F.when(F.col("id") % 4 > 0, "neutral").alias("sentiment_label"),
        F.lit(0.5).cast("decimal(5,4)").alias("sentiment_score"), (when + F.make_dt_interval(F.col("id").cast("int"))).alias("analyzed_at"),
    )
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        queue = pending_analysis(posts, scores=scores)
        got, want = queue.collect(), pending_analysis(apply_scores(posts, scores)).collect()
        assert [(row.scraped_at, row.id) for row in got] == [(row.scraped_at, row.id) for row in want]
        assert sorted(map(repr, got)) == sorted(map(repr, want)) and 20 < len(got) < 40
        plan = queue._jdf.queryExecution().sparkPlan().toString(), queue._jdf.queryExecution().executedPlan().toString()
        assert "LeftOuter" not in plan[0]
        final = plan[1].split("== Initial Plan ==")[0]
        assert final.count("rangepartitioning(") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
