"""One batch run: landed inputs of several families to posts, duplicates out, all sinks, counts and health of sources.

Counts are observed while the run writes. They go, per source, to the report and to the health table next to the output;
the breaker folds that table before the next run and leaves out sources that failed again and again.
"""

from __future__ import annotations

import logging
import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.operators.health import CLOSED, COUNTS, HEALTH, OPEN, Meter, breaker_states
from mentionflow.operators.match import match_first, with_first_keyword
from mentionflow.plans.config import RunConfig
from mentionflow.schema import SOURCE_TYPES
from mentionflow.session import delete_path, path_exists, spread_scan, staged
from mentionflow.sinks.fanout import Sinks, publish
from mentionflow.sources import platforms
from mentionflow.sources.posts import arrival, card_posts, social_posts, web_posts, web_rows

log = logging.getLogger(__name__)

Landed = Callable[[SparkSession], DataFrame]
#: A family has one landed input, or one per layout it comes in.
Inputs = Mapping[str, Landed | Sequence[Landed]]


@dataclass(frozen=True)
class SourceReport:
    """What a run did with a source: a web source by its rule's name, another family by its own.

    `pages` are landed rows, `failed` those that could not be read, `found` items with a title (or landed rows),
    `matched` those with a keyword, `rejected` rows that break the table's rules or stand for unreadable pages, `kept`
    posts after duplicates. `state` is the breaker the run worked with; an open source was left out.
    """

    source: str
    state: str
    pages: int = 0
    failed: int = 0
    found: int = 0
    matched: int = 0
    rejected: int = 0
    kept: int = 0


@dataclass(frozen=True)
class RunReport:
    """Valid posts kept per type, duplicates skipped, what went wrong with the families left out, faulty rows."""

    social: int
    web: int
    duplicates: int
    failed: Mapping[str, str]
    rejected: int = 0
    sources: tuple[SourceReport, ...] = ()


def _tagged(to_record: Callable[..., DataFrame]) -> Callable[[DataFrame, RunConfig], DataFrame]:
    """A platform searched by hashtag: an item is kept when its text has a keyword, as words or as a hashtag."""

    def build(items: DataFrame, config: RunConfig) -> DataFrame:
        matched = match_first(items, "body", config.keywords, tagged=True)
        return to_record(matched, extra=arrival(F.col("keyword_ord"), F.lit(0)))

    return build


def _comments(items: DataFrame, config: RunConfig) -> DataFrame:
    """Comments of videos the search found: the keyword may stand in the video's title or in the comment."""
    found = items.withColumn("_about", F.concat_ws(" ", "video_title", "body"))
    matched = match_first(found, "_about", config.keywords)
    return platforms.video_comment_posts(matched, extra=arrival(F.col("keyword_ord"), F.lit(0)))


def _reviews(items: DataFrame, config: RunConfig) -> DataFrame:
    """Reviews of configured products: all are kept, under the first keyword they have or else the product's name."""
    about = items.withColumn("_about", F.concat_ws(" ", "product_name", "body"))
    matched = with_first_keyword(about, "_about", config.keywords)
    named = matched.withColumn("keyword", F.coalesce("keyword", "product_name"))
    place = F.coalesce(F.col("keyword_ord"), F.lit(len(config.keywords)))
    return platforms.review_posts(named, extra=arrival(place, F.lit(0)))


def _from_pages(pages: DataFrame, config: RunConfig) -> DataFrame:
    return web_posts(spread_scan(pages), config.rules, config.keywords)


def _watched_pages(pages: DataFrame, config: RunConfig, meter: Meter) -> DataFrame:
    return web_rows(spread_scan(pages), config.rules, config.keywords, meter)


def _watched(name: str, landed: DataFrame, config: RunConfig, meter: Meter) -> DataFrame:
    """Any other family: its landed rows and the posts they give are counted under its name."""
    failed = F.col("html").isNull() if "html" in landed.columns else F.lit(False)
    landed = meter.watch(landed, {f"pages:{name}": F.lit(True), f"found:{name}": ~failed, f"failed:{name}": failed})
    return meter.watch(BUILDERS[name](landed, config), {f"matched:{name}": F.lit(True)})


def _from_search(items: DataFrame, config: RunConfig) -> DataFrame:
    """Search results come as items, or as rendered pages when they have markup."""
    if "html" in items.columns:
        return card_posts(spread_scan(items), config.keywords, config.lang, config.max_per_keyword)
    return social_posts(items, config.keywords, config.lang, config.max_per_keyword)


BUILDERS: dict[str, Callable[[DataFrame, RunConfig], DataFrame]] = {
    "x": _from_search,
    "web": _from_pages,
    "instagram": _tagged(platforms.caption_posts),
    "tiktok": _tagged(platforms.short_video_posts),
    "youtube": _comments,
    "ecommerce": _reviews,
}


def collect_families(
    spark: SparkSession, config: RunConfig, inputs: Inputs, counts: Counter | None = None
) -> tuple[dict[str, tuple[DataFrame, str]], dict[str, str]]:
    """Stage the posts of each selected family by its own job, at the same time; `counts` gets what was observed.

    A family that fails, when it is planned or while it runs, is reported and left out; the others go on.
    """
    wanted = [name for name in inputs if name in config.families]
    meters = {name: Meter() for name in wanted}

    def stage(name: str):
        landed = [inputs[name]] if callable(inputs[name]) else inputs[name]
        if name == "web":
            parts = [_watched_pages(read(spark), config, meters[name]) for read in landed]
        else:
            parts = [_watched(name, read(spark), config, meters[name]) for read in landed]
        return staged(reduce(lambda left, right: left.unionByName(right), parts), f"family-{name}")

    done, failed = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, len(wanted))) as pool:
        jobs = {name: pool.submit(stage, name) for name in wanted}
    for name, job in jobs.items():
        problem = job.exception()
        if problem is None:
            done[name] = job.result()
            if counts is not None:
                counts.update(meters[name].counts())
        else:
            log.error("source family %s left out: %s", name, problem)
            failed[name] = f"{type(problem).__name__}: {problem}"
    return done, failed


def health_path(config: RunConfig) -> str:
    return f"{config.output_dir.rstrip('/')}-health"


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """The records of earlier runs; none when there was no run."""
    return spark.read.schema(HEALTH).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], HEALTH)


def source_states(spark: SparkSession, config: RunConfig, inputs: Inputs) -> dict[str, str]:
    """The breaker of every source a run would read: one row per rule or family, all closed before the first run."""
    families = [name for name in inputs if name in config.families]
    names = [rule.name for rule in config.rules if "web" in families] + [name for name in families if name != "web"]
    records = read_health(spark, health_path(config)).filter(F.col("source").isin(names))
    states = breaker_states(records, strikes=config.strikes, wait=config.wait)
    known = {row["source"]: row["state"] for row in states.collect()}
    return {name: known.get(name, CLOSED) for name in names}


def _without_open(config: RunConfig, states: Mapping[str, str]) -> RunConfig:
    """The configuration without the rules and families whose breaker is open."""
    left_out = {name for name, state in states.items() if state == OPEN}
    for name in sorted(left_out):
        log.warning("source %s left out: it failed in earlier runs", name)
    rules = tuple(rule for rule in config.rules if rule.name not in left_out)
    families = config.families - left_out - (frozenset() if rules else {"web"})
    return replace(config, rules=rules, families=families)


def _by_source(states: Mapping[str, str]) -> Callable[[str], dict[str, Column]]:
    """Tests that count rows by source. Families that name their sources themselves (shops) share their family's count."""
    fixed = [name for name in states if name != "ecommerce"]
    own = {name: F.col("source") == name for name in fixed}
    if "ecommerce" in states:
        own["ecommerce"] = ~F.coalesce(F.col("source").isin(fixed), F.lit(False))
    return lambda label: {f"{label}:{name}": test for name, test in own.items()}


def run(spark: SparkSession, config: RunConfig, inputs: Inputs, day: str | None = None) -> RunReport:
    """Run the selected families over their landed inputs and write to all configured sinks.

    Rows that break the table's rules, and pages that could not be read, go to `<output_dir>-rejected` with the
    reasons. Sources whose breaker is open are left out. The health of all sources goes to `<output_dir>-health`.
    """
    run_id, states = uuid.uuid4().hex, source_states(spark, config, inputs)
    config, counts = _without_open(config, states), Counter()
    done, failed = collect_families(spark, config, inputs, counts)
    meter, by_source = Meter(), _by_source(states)
    tests = {
        "rejected": {"all:rejected": F.lit(True), **by_source("rejected")},
        "valid": {"all:valid": F.lit(True)},
        "kept": {**{f"type:{kind}": F.col("source_type") == kind for kind in SOURCE_TYPES}, **by_source("kept")},
    }
    if done:
        posts = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), [frame for frame, _ in done.values()])
        rejected = f"{config.output_dir.rstrip('/')}-rejected"
        try:
            sinks = Sinks(config.output_dir, config.table_dir, config.database, rejected)
            publish(posts, sinks, run_id, day, watch=lambda label, rows: meter.watch(rows, tests[label]))
        finally:
            for _, path in done.values():
                delete_path(spark, path)
        counts.update(meter.counts())
    for name in failed:  # a family that failed as a whole counts as one page that did
        for source in ([rule.name for rule in config.rules] if name == "web" else [name]):
            counts.update({f"pages:{source}": 1, f"failed:{source}": 1})
    sources = tuple(SourceReport(name, state, *[counts[f"{label}:{name}"] for label in COUNTS]) for name, state in states.items())
    for source in sources:
        if source.state != OPEN and not source.matched:
            log.warning("source %s: nothing matched (%d pages, %d failed, %d items)", source.source, source.pages, source.failed, source.found)
    stamp = datetime.now(timezone.utc)
    records = [(stamp, run_id, one.source, one.state, *[getattr(one, label) for label in COUNTS]) for one in sources]
    if records:
        spark.createDataFrame(records, HEALTH).coalesce(1).write.mode("append").parquet(health_path(config))
    kept = sum(counts[f"type:{kind}"] for kind in SOURCE_TYPES)
    return RunReport(counts["type:social"], counts["type:web"], counts["all:valid"] - kept, failed, counts["all:rejected"], sources)
