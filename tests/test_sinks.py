"""Table, JSON lines, fan-out, runs and streams, each in a folder of its own."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mentionflow import session
from mentionflow.plans.config import DEFAULT_KEYWORDS, FAMILIES, families_of, resolve_config
from mentionflow.plans.run import run
from mentionflow.schema import CAPTION_ITEM, CARD_PAGE, PAGE, POST, REVIEW_ITEM, SCORE, SOCIAL_ITEM, VIDEO_COMMENT, VIDEO_ITEM
from mentionflow.session import new_path, spread_scan, work_dir
from mentionflow.sinks import database, table
from mentionflow.sinks.fanout import Sinks, publish
from mentionflow.sinks.jsonl import read_jsonl, write_jsonl
from mentionflow.sources import platforms
from mentionflow.sources.landed import read_landed, stream_landed
from mentionflow.sources.posts import arrival
from mentionflow.sources.rules import Rule
from mentionflow.operators.reports import by_keyword_and_time, by_source
from mentionflow.streaming.ingest import drop_seen, start_ingest, unscored


def posts(spark, rows):
    """Rows of (source, post_id, keyword, arrival, hour)."""
    full = [
        (source, "web", keyword, post_id, f"text é of {post_id}", "", "", "", "id", '{"b":1,"a":{"c":"é"}}',
         f"2026-01-{1 + hour // 24:02d}T{hour % 24:02d}:00:00+00:00", at)
        for source, post_id, keyword, at, hour in rows
    ]
    frame = spark.createDataFrame(full, ", ".join(f"{name} string" for name in POST.names) + ", at int")
    return frame.select(*POST.names, *arrival(F.col("at"), F.lit(0)))


ROWS = [("a", "1", "k", 0, 0), ("a", "1", "m", 1, 0), ("a", "2", "k", 0, 30), ("b", "1", "k", 0, 1), ("a:b", "1", "k", 0, 60)]


def keys_of(frame):
    return sorted((row["source"], row["post_id"], row["keyword"]) for row in frame.collect())


WANT = [("a", "1", "k"), ("a", "2", "k"), ("a:b", "1", "k"), ("b", "1", "k")]


# ---- table and files ----


@pytest.mark.parametrize("limit", [table.BROADCAST_KEY_BYTES, 0])
def test_running_twice_leaves_the_table_and_doubles_the_files(spark, tmp_path, monkeypatch, limit):
    """Both ways of finding stored keys: small batches are broadcast, large ones shuffled."""
    monkeypatch.setattr(table, "BROADCAST_KEY_BYTES", limit)
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"))
    for batch in ("one", "two"):
        publish(posts(spark, ROWS), sinks, batch, "20260101")
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == WANT
    assert keys_of(read_jsonl(spark, sinks.output_dir)) == sorted(WANT * 2)


def test_any_split_into_batches_gives_the_same_keys(spark, tmp_path):
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"))
    for number, row in enumerate(reversed(ROWS)):
        publish(posts(spark, [row]), sinks, str(number))
    assert [key[:2] for key in keys_of(table.read_posts(spark, sinks.table_dir))] == [key[:2] for key in WANT]


def test_replayed_batch_repeats_nothing(spark, tmp_path):
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"))
    for _ in range(2):
        publish(posts(spark, ROWS), sinks, "one", "20260101")
    assert keys_of(read_jsonl(spark, sinks.output_dir)) == WANT


def test_lines_have_all_keys_and_raw_as_an_object(spark, tmp_path):
    out = str(tmp_path / "out")
    frame = posts(spark, ROWS[:1]).withColumn("url", F.lit(None).cast("string"))
    write_jsonl(frame, out, "b", "20260416")
    files = list((tmp_path / "out" / "for_source=a" / "day=20260416" / "batch=b").glob("*.json"))
    line = files[0].read_text(encoding="utf-8").strip()
    record = json.loads(line)
    assert set(record) == set(POST.names) and record["url"] is None
    assert record["raw"] == {"a": {"c": "é"}, "b": 1} and "é" in line
    back = read_jsonl(spark, out).filter("day = '20260416'").first()
    assert json.loads(back["raw"]) == record["raw"]


def test_empty_table_and_empty_batch(spark, tmp_path):
    path = str(tmp_path / "table")
    assert table.read_posts(spark, path).count() == 0
    table.create_table(spark, path)
    table.create_table(spark, path)
    assert table.read_posts(spark, path).count() == 0
    publish(posts(spark, ROWS).limit(0), Sinks(str(tmp_path / "out"), path), "b")
    assert table.read_posts(spark, path).count() == 0


def test_faulty_rows_are_set_aside(spark, tmp_path):
    bad = posts(spark, ROWS[:2]).withColumn("source_type", F.lit("forum"))
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"), quarantine_dir=str(tmp_path / "bad"))
    publish(posts(spark, ROWS).unionByName(bad), sinks, "one")
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == WANT
    assert spark.read.json(f"{sinks.quarantine_dir}/batch=one").count() == 2


def plan_of(frame):
    mode = spark_mode(frame)
    return frame._jdf.queryExecution().explainString(mode)


def spark_mode(frame):
    return frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


def test_queries_skip_directories(spark, tmp_path):
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"))
    publish(posts(spark, ROWS), sinks, "one")
    stored = table.read_posts(spark, sinks.table_dir)
    in_range = by_keyword_and_time(stored, "k", "2026-01-01 00:00:00", "2026-01-01 12:00:00")
    assert keys_of(in_range) == [("a", "1", "k"), ("b", "1", "k")]
    filters = [line for line in plan_of(in_range).splitlines() if line.startswith("PartitionFilters")]
    assert "scraped_date" in filters[0] and "2026-01-02" in filters[0]
    assert "source" in next(line for line in plan_of(by_source(stored, "a")).splitlines() if line.startswith("PartitionFilters"))
    files = in_range.select(F.input_file_name()).distinct().collect()
    assert all("2026-01-03" not in row[0] for row in files)


def test_stored_keys_are_read_without_other_columns(spark, tmp_path):
    path = str(tmp_path / "table")
    publish(posts(spark, ROWS), Sinks(str(tmp_path / "out"), path), "one")
    fresh = table.fresh_rows(posts(spark, ROWS), table.read_posts(spark, path))
    schemas = [line for line in plan_of(fresh).splitlines() if line.startswith("ReadSchema")]
    assert schemas == ["ReadSchema: struct<post_id:string>"]


def test_scores_leave_the_posts_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    publish(posts(spark, ROWS), Sinks(str(tmp_path / "out"), path), "one")
    files = {row[0] for row in table.read_table(spark, path).select(F.input_file_name()).collect()}
    ids = {(row["source"], row["post_id"]): row["id"] for row in table.read_posts(spark, path).collect()}
    first = [(ids["a", "1"], "neutral", Decimal("0.5"), datetime(2026, 2, 1)), ("unknown", "positive", None, None)]
    table.write_scores(spark.createDataFrame(first, SCORE), path)
    publish(posts(spark, [("c", "1", "k", 0, 0)]), Sinks(str(tmp_path / "out"), path), "two")
    table.write_scores(spark.createDataFrame([(ids["a", "1"], "positive", Decimal("0.75"), datetime(2026, 2, 2))], SCORE), path)
    want = {("a", "1"): "positive", ("a", "2"): None, ("b", "1"): None, ("a:b", "1"): None, ("c", "1"): None}
    for compacted in (False, True):
        if compacted:
            table.compact_scores(spark, path)
            assert spark.read.parquet(table.scores_path(path)).count() == 2
        after = table.read_posts(spark, path)
        assert {(row["source"], row["post_id"]): row["sentiment_label"] for row in after.collect()} == want
    assert files <= {row[0] for row in table.read_table(spark, path).select(F.input_file_name()).collect()}
    assert unscored(after, spark.createDataFrame([], SCORE)).count() == 4
    filters = [line for line in plan_of(by_source(after, "a")).splitlines() if line.startswith("PartitionFilters")]
    assert any("source" in line for line in filters)


def test_scores_of_very_many_sources(spark, tmp_path):
    path = str(tmp_path / "table")
    many = posts(spark, ROWS[:1]).crossJoin(spark.range(2000)).withColumn("source", F.concat(F.lit("s"), "id")).drop("id")
    table._append(table.to_stored(many).withColumn("scraped_date", F.lit(None).cast("date")).repartition(1), path)
    ids = table.read_posts(spark, path).select("id", F.lit("neutral").alias("sentiment_label"), F.lit(None).alias("sentiment_score"), F.lit(None).alias("analyzed_at"))
    table.write_scores(ids, path)
    assert table.read_posts(spark, path).filter("sentiment_label = 'neutral'").count() == 2000


@pytest.mark.parametrize("sources", [0, 1000])
def test_broadcast_does_not_depend_on_the_number_of_sources(spark, tmp_path, monkeypatch, sources):
    monkeypatch.setattr(table, "PRUNE_SOURCES", sources)
    path = str(tmp_path / "table")
    publish(posts(spark, ROWS), Sinks(str(tmp_path / "out"), path), "one")
    fresh = table.fresh_rows(posts(spark, [*ROWS, ("z", "1", "k", 0, 0)]), table.read_table(spark, path))
    assert {row["source"] for row in fresh.collect()} == {"z"}
    assert "BroadcastHashJoin" in plan_of(fresh)


def test_unreadable_scrape_time(spark, tmp_path):
    bad = posts(spark, ROWS[:1]).withColumn("scraped_at", F.lit("yesterday"))
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"), quarantine_dir=str(tmp_path / "bad"))
    publish(bad.unionByName(posts(spark, ROWS[3:4])), sinks, "one")
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == [("b", "1", "k")]
    assert spark.read.json(f"{sinks.quarantine_dir}/batch=one").first()["reason"] == ["scraped_at is not a time"]
    with pytest.raises(Exception, match="scraped_at is not a time"):
        table.to_stored(bad).collect()


def test_replay_on_the_next_day_keeps_the_first_day(spark, tmp_path):
    out = str(tmp_path / "out")
    for day in ("20260101", "20260102"):
        write_jsonl(posts(spark, ROWS[:1]), out, "b", day)
    write_jsonl(posts(spark, ROWS[:1]), out, "c", "20260102")
    assert sorted((row["day"], row["batch"]) for row in read_jsonl(spark, out).collect()) == [("20260101", "b"), ("20260102", "c")]


def test_database_options():
    options = database.connection_options("jdbc:postgresql://db/x?stringtype=unspecified", "posts", user="u")
    assert options["numPartitions"] == "10" and options["user"] == "u"
    assert len(set(database.key_predicates(4))) == 4


# ---- runs ----


def landed_inputs(spark):
    social = [(1, "news of AI", "2026-01-01T00:00:00Z", "id"), (2, "policy and news", "2026-01-02T00:00:00Z", "id"),
              (3, "news", "2026-01-03T00:00:00Z", "en"), (4, "News again", "2026-01-04T00:00:00Z", "id")]
    rows = [(*row, {"screen_name": "u"} if row[0] != 2 else None, None, 3, None) for row in social]
    html = '<a href="/read/1">Policy one</a><a href="/read/1">Policy one</a><a href="/read/2">weather</a>'
    return {
        "x": lambda s: s.createDataFrame(rows, SOCIAL_ITEM),
        "web": lambda s: s.createDataFrame([(1, "https://news.example.org/", html)], PAGE),
        "youtube": lambda s: s.createDataFrame([("c1", "good news", "N", "v1", "t", "", 1, None)], VIDEO_COMMENT),
    }


RULES = (Rule("site", "https://news.example.org/", "a[href*='/read/']", "::text", "::attr(href)"),)


def config_for(tmp_path, **given):
    base = {"keywords": "policy,news", "output_dir": str(tmp_path / "out"), "table_dir": str(tmp_path / "table"), "rules": RULES}
    return resolve_config({**base, **given})


def test_run_over_all_families(spark, tmp_path):
    config = config_for(tmp_path, max_per_keyword=2)
    report = run(spark, config, landed_inputs(spark))
    assert (report.social, report.web, report.duplicates, report.failed) == (3, 1, 2, {})
    stored = {(r["source"], r["post_id"]): r for r in table.read_posts(spark, config.table_dir).collect()}
    assert set(stored) == {("x", "2"), ("x", "4"), ("youtube", "c1"), ("site", "https://news.example.org/read/1")}
    assert stored["x", "2"]["keyword"] == "policy" and stored["x", "2"]["author"] == ""
    assert json.loads(stored["x", "4"]["raw"]) == {"retweet_count": 0, "like_count": 3, "reply_count": 0}
    assert stored["x", "4"]["url"] == "https://x.com/i/web/status/4"


def test_failing_family_is_left_out_and_reported(spark, tmp_path):
    def broken_read(s):
        return read_landed(s, str(tmp_path / "missing"), PAGE)

    def broken_job(s):
        frame = s.range(3).selectExpr("raise_error('boom') as id", "'x' as body")
        return frame.withColumns({name: F.lit(None) for name in CAPTION_ITEM.names if name not in frame.columns})

    inputs = landed_inputs(spark) | {"web": broken_read, "instagram": broken_job}
    report = run(spark, config_for(tmp_path), inputs)
    assert set(report.failed) == {"web", "instagram"} and report.social == 4


def test_family_choice(spark, tmp_path):
    report = run(spark, config_for(tmp_path, source="web"), landed_inputs(spark))
    assert (report.social, report.web) == (0, 1)
    assert families_of("all") == families_of("nonsense") == families_of(None) == frozenset(FAMILIES)
    assert families_of(" YouTube ") == {"youtube"}


def test_configuration_order():
    assert resolve_config().keywords == DEFAULT_KEYWORDS
    env = {"KEYWORDS": " a, ,b", "X_MAX_RESULTS": "7", "SOURCE": "x", "OUTPUT_DIR": "o"}
    config = resolve_config({}, env)
    assert (config.keywords, config.max_per_keyword, config.families, config.output_dir) == (("a", "b"), 7, {"x"}, "o")
    config = resolve_config({"keywords": "c", "max_per_keyword": 3, "source": "all", "output_dir": " p "}, env)
    assert (config.keywords, config.max_per_keyword, config.output_dir) == (("c",), 3, "p")
    assert config.families == frozenset(FAMILIES)
    for text in ("x", "-1", "0", ""):
        assert resolve_config({}, {"X_MAX_RESULTS": text}).max_per_keyword == 50
    for given in ({"keywords": " ,"}, {"max_per_keyword": 0}, {"output_dir": " "}, {"source": "y"}):
        with pytest.raises(ValueError):
            resolve_config(given, env)


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from mentionflow.__main__ import main

    html = '<a href="/read/1">Policy one</a><a href="/read/2">weather</a>'
    pages = spark.createDataFrame([(1, "https://www.kompas.com/", html)], PAGE)
    pages.write.parquet(str(tmp_path / "pages"))
    options = ["--landed", f"web={tmp_path}/pages", "--output-dir", f"{tmp_path}/out", "--table-dir", f"{tmp_path}/table"]
    monkeypatch.setattr("sys.argv", ["mentionflow", *options, "--source", "web"])
    monkeypatch.setenv("KEYWORDS", "weather, policy")
    main()
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"social": 0, "web": 2, "duplicates": 0, "rejected": 0, "failed": {}}
    assert {row["keyword"] for row in table.read_posts(spark, f"{tmp_path}/table").collect()} == {"policy", "weather"}


def test_repeated_landed_inputs_are_read_together(spark, tmp_path, monkeypatch, capsys):
    from mentionflow.__main__ import main

    for number, word in enumerate(("policy", "weather", "other")):
        html = f'<a href="/read/{number}">{word} one</a>'
        spark.createDataFrame([(number, "https://www.kompas.com/", html)], PAGE).write.parquet(f"{tmp_path}/pages{number}")
    items = [(1, "policy today", "2026-01-01T00:00:00Z", None, None, None, None, None)]
    spark.createDataFrame(items, SOCIAL_ITEM).write.parquet(f"{tmp_path}/items")
    card = '<article data-testid="tweet"><div data-testid="tweetText">policy</div><a href="/u/status/7">x</a></article>'
    spark.createDataFrame([("policy", 1, card)], CARD_PAGE).write.parquet(f"{tmp_path}/cards")
    landed = [f"web={tmp_path}/pages{number}" for number in range(3)] + [f"x={tmp_path}/items", f"x_pages={tmp_path}/cards"]
    options = [part for entry in landed for part in ("--landed", entry)]
    options += ["--output-dir", f"{tmp_path}/out", "--table-dir", f"{tmp_path}/table", "--keywords", "weather,policy"]
    monkeypatch.setattr("sys.argv", ["mentionflow", *options])
    main()
    report = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert (report["social"], report["web"], report["failed"]) == (2, 2, {})


def test_language_copies_and_platform_keywords(spark, tmp_path):
    items = [(1, "news a", "2026-01-01T00:00:00Z", None)] + [(2, "news b", "2026-01-02T00:00:00Z", "id")] * 4
    social = [(*item, None, None, None, None) for item in items]
    captions = [("c1", "see #acmeutara", "u", "p", "t", "caption", "m", 1), ("c2", "acme", "u", "p", "t", "caption", "m", 1)]
    comments = [("y1", "nice", "n", "v", "All about Acme Utara", "t", 1, 0), ("y2", "nice", "n", "v", "other", "t", 1, 0)]
    reviews = [("r1", "shopee", "bagus", "u", "https://s/1", "2026-01-01", 4, "Acme Utara kettle", True), ("r2", "shopee", None, "u", "", "", 1, "pan", True)]
    inputs = {
        "x": lambda s: s.createDataFrame(social, SOCIAL_ITEM),
        "instagram": lambda s: s.createDataFrame(captions, CAPTION_ITEM),
        "youtube": lambda s: s.createDataFrame(comments, VIDEO_COMMENT),
        "ecommerce": lambda s: s.createDataFrame(reviews, REVIEW_ITEM),
    }
    config = config_for(tmp_path, keywords="acme utara,news", max_per_keyword=2)
    report = run(spark, config, inputs)
    assert (report.social, report.web, report.rejected) == (4, 1, 1)
    assert keys_of(table.read_posts(spark, config.table_dir)) == [
        ("instagram", "c1", "acme utara"), ("shopee", "r1", "acme utara"), ("x", "1", "news"), ("x", "2", "news"), ("youtube", "y1", "acme utara"),
    ]


def test_platform_records(spark):
    caption = spark.createDataFrame([("1", "b", None, "https://p/1", None, "caption", "m", None)], CAPTION_ITEM)
    row = platforms.caption_posts(caption).first()
    assert (row["source"], row["source_type"], row["author"], row["created_at"]) == ("instagram", "social", "", "")
    assert json.loads(row["raw"]) == {"type": "caption", "media_id": "m", "like_count": 0}
    video = spark.createDataFrame([("1", "b", "u", "https://v/1", "t", "description", "v", 5, 6)], VIDEO_ITEM)
    assert json.loads(platforms.short_video_posts(video).first()["raw"])["play_count"] == 5
    comment = spark.createDataFrame([("c", "b", "n", "v", "title", "t", 1, 2)], VIDEO_COMMENT)
    assert platforms.video_comment_posts(comment).first()["url"] == "https://youtube.com/watch?v=v&lcdv=c"
    review = spark.createDataFrame([("r", "shopee", "b", "u", "https://s/1", "2026-01-01", 4, "p", True)], REVIEW_ITEM)
    row = platforms.review_posts(review).first()
    assert (row["source"], row["source_type"]) == ("shopee", "web")
    assert json.loads(row["raw"]) == {"star_rating": 4, "product_name": "p", "verified_purchase": True}


# ---- streams ----


def test_stream_gives_the_table_of_the_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    half = [("a", str(n % 7), "k", n, n) for n in range(20)]
    for number, part in enumerate((half[:10], half[5:])):
        posts(spark, part).coalesce(1).write.parquet(str(landing / str(number)))
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"), quarantine_dir=str(tmp_path / "bad"))
    schema = posts(spark, half).schema

    def ingest():
        stream = stream_landed(spark, str(landing / "*"), schema, files_per_trigger=1)
        start_ingest(stream, lambda batch: batch, sinks, str(tmp_path / "check")).awaitTermination()

    ingest()
    batch = Sinks(str(tmp_path / "out2"), str(tmp_path / "table2"))
    publish(posts(spark, half), batch, "one")
    stored = keys_of(table.read_posts(spark, sinks.table_dir))
    assert stored == keys_of(table.read_posts(spark, batch.table_dir)) and len(stored) == 7
    posts(spark, [("c", "9", "k", 0, 0), ("a", "1", "k", 0, 0)]).write.parquet(str(landing / "later"))
    ingest()
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == sorted([*stored, ("c", "9", "k")])


def test_two_streams_into_one_output(spark, tmp_path):
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"))
    landing = {name: str(tmp_path / name) for name in ("one", "two")}
    posts(spark, ROWS[:3]).write.parquet(landing["one"])
    posts(spark, [*ROWS[1:], ("a", "9", "k", 0, 0)]).write.parquet(landing["two"])
    for name in ("one", "two", "two"):
        stream = stream_landed(spark, landing[name], posts(spark, ROWS).schema)
        start_ingest(stream, lambda batch: batch, sinks, str(tmp_path / f"check-{name}"), "20260101").awaitTermination()
    want = sorted([*WANT, ("a", "9", "k")])
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == want
    assert keys_of(read_jsonl(spark, sinks.output_dir)) == want


def test_stream_dedup_with_bounded_state(spark, tmp_path):
    landing = str(tmp_path / "landing")
    rows = [("a", str(n % 5), "k", 0, 0) for n in range(50)]
    posts(spark, rows).repartition(3).write.parquet(landing)
    stream = stream_landed(spark, landing, posts(spark, rows).schema)
    once = drop_seen(stream.withColumn("scraped_at", F.col("scraped_at").cast("timestamp")), "1 hour")
    query = once.writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("seen").count() == 5


# ---- session ----


def test_work_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_dir(spark) == named.rstrip("/")
    assert new_path(spark, "x").startswith(work_dir(spark)) and new_path(spark, "x") != new_path(spark, "x")


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        session.work_dir(Cluster())


def test_only_small_scans_are_spread(spark):
    small = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert spread_scan(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
        again = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
        assert spread_scan(again) is again
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
