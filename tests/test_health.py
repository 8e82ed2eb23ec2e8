"""The breaker, counts taken while writing, and runs that leave sources out."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mentionflow.operators.health import HEALTH, Meter, breaker_states
from mentionflow.plans.config import resolve_config
from mentionflow.plans.run import health_path, read_health, run
from mentionflow.schema import CAPTION_ITEM, PAGE
from mentionflow.sources.rules import Rule

RULES = [Rule(name, f"https://{name}.example.org/", "a", "::text", "::attr(href)") for name in ("good", "bad")]


def plain_breaker(runs, threshold, strikes, wait):
    state, count, waited = "closed", 0, 0
    for pages, failed in runs:
        bad = pages > 0 and failed > threshold * pages
        if state == "open":
            waited += 1
            state = "half_open" if waited >= wait else "open"
            continue
        waited = 0
        if state == "half_open":
            state, count = (state, count) if not pages else ("open", count) if bad else ("closed", 0)
        elif pages:
            count = count + 1 if bad else 0
            state = "open" if bad and count >= strikes else "closed"
    return state, count, waited


@pytest.mark.parametrize("strikes, wait", [(1, 1), (2, 2), (3, 1)])
def test_breaker_folds_the_records_in_order(spark, strikes, wait):
    draw, day = random.Random(strikes), datetime(2026, 1, 1)
    runs = {f"s{n}": [draw.choice([(0, 0), (4, 0), (4, 2), (4, 3), (1, 1)]) for _ in range(draw.randint(1, 14))] for n in range(60)}
    rows = [(day + timedelta(days=at), "r", name, "closed", *pair, 0, 0, 0, 0) for name, pairs in runs.items() for at, pair in enumerate(pairs)]
    draw.shuffle(rows)
    got = {row.source: (row.state, row.strikes, row.waited) for row in breaker_states(spark.createDataFrame(rows, HEALTH), 0.5, strikes, wait).collect()}
    assert got == {name: plain_breaker(pairs, 0.5, strikes, wait) for name, pairs in runs.items()}
    assert {state for state, _, _ in got.values()} == {"closed", "open", "half_open"}


@pytest.mark.parametrize("rows", [0, 50])
def test_counts_come_with_the_write(spark, tmp_path, rows):
    meter = Meter()
    frame = meter.watch(spark.range(rows), {"even": F.col("id") % 2 == 0, "none": F.lit(None).cast("boolean")})
    frame = meter.watch(frame.filter("id < 10"), {"small": F.lit(True)})
    frame.write.parquet(f"{tmp_path}/out")
    assert meter.counts() == {"even": rows // 2, "none": 0, "small": min(rows, 10)}


def pages(spark, bad):
    html = '<a href="/1">policy one</a><a href="/2">weather</a><a href="/3"> </a>'
    rows = [(1, "https://good.example.org/", html), (2, "https://good.example.org/", html), (3, "https://bad.example.org/x", None if bad else html)]
    return {"web": lambda _: spark.createDataFrame(rows, PAGE), "instagram": lambda _: spark.createDataFrame([], CAPTION_ITEM)}


def test_open_source_is_left_out_and_tried_again(spark, tmp_path, caplog):
    config = resolve_config({"keywords": "policy", "output_dir": f"{tmp_path}/out", "rules": RULES, "strikes": 2, "wait": 1})
    seen = []
    for bad in (True, True, False, False):
        report = run(spark, config, pages(spark, bad))
        one = {source.source: source for source in report.sources}
        good = one["good"]
        assert (good.state, good.pages, good.failed, good.found, good.matched, good.rejected, good.kept) == ("closed", 2, 0, 4, 2, 0, 1)
        assert one["instagram"].pages == 0 and "source instagram: nothing matched" in caplog.text
        seen.append((one["bad"].state, one["bad"].pages, one["bad"].failed, one["bad"].matched, one["bad"].rejected, report.rejected, report.duplicates))
    assert seen == [("closed", 1, 1, 0, 1, 1, 1), ("closed", 1, 1, 0, 1, 1, 1), ("open", 0, 0, 0, 0, 0, 1), ("half_open", 1, 0, 1, 0, 0, 1)]
    assert "source bad left out" in caplog.text
    rejected = [json.loads(row.value) for row in spark.read.text(f"{tmp_path}/out-rejected/*").collect()]
    assert len(rejected) == 2 and all(row["reason"][0] == "page not read: no content" and row["url"] == "https://bad.example.org/x" for row in rejected)
    records = read_health(spark, health_path(config))
    assert records.count() == 12 and records.select("run_id").distinct().count() == 4


def test_all_sources_open(spark, tmp_path):
    config = resolve_config({"keywords": "policy", "output_dir": f"{tmp_path}/out", "rules": RULES[1:], "source": "web", "strikes": 1})
    run(spark, config, pages(spark, True))
    report = run(spark, config, pages(spark, True))
    assert (report.web, report.failed, [source.state for source in report.sources]) == (0, {}, ["open"])
