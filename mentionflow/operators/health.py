"""Health of sources over runs: counts taken while a run writes, and a breaker that leaves failing sources out."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"
#: A run is bad for a source when more than this share of its pages failed; so many bad runs in a row open the breaker,
#: and after so many runs without the source it is tried again.
THRESHOLD, STRIKES, WAIT = 0.5, 3, 2

COUNTS = ("pages", "failed", "found", "matched", "rejected", "kept")
#: One row per source and run. `state` is the one the run worked with; a source left out has counts of zero.
HEALTH = T.StructType(
    [T.StructField("run_at", T.TimestampType()), T.StructField("run_id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("state", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in COUNTS]
)


class Meter:
    """Counts rows by tests while the job that writes them runs, without a job of its own.

    The counts are Spark observations: they are there once the write is done, and must not be asked for otherwise.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def watch(self, rows: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
        if not tests:
            return rows
        seen = Observation()
        self._seen.append(seen)
        return rows.observe(seen, *[F.count_if(test).alias(name) for name, test in tests.items()])

    def counts(self) -> Counter:
        total: Counter = Counter()
        for seen in self._seen:
            total.update({name: value or 0 for name, value in seen.get.items()})
        return total


def breaker_states(records: DataFrame, threshold: float = THRESHOLD, strikes: int = STRIKES, wait: int = WAIT) -> DataFrame:
    """`source`, `state`, `strikes`, `waited`: the breaker of each source after its records, in order of `run_at`.

    Closed: bad runs in a row are counted, a good one starts anew, a run without pages changes nothing; at `strikes` it
    opens. Open: every run waits, and after `wait` of them it is half open. Half open: the next run with pages decides.
    A source has one small record per run, so its records are folded in one row.
    """
    record = F.struct("run_at", "run_id", "pages", "failed") if "run_id" in records.columns else F.struct("run_at", "pages", "failed")
    number = lambda value: F.lit(value).cast("int")

    def step(now: Column, run: Column) -> Column:
        seen = run["pages"] > 0
        bad = seen & (run["failed"] > F.lit(threshold) * run["pages"])
        closed, opened = now["state"] == CLOSED, now["state"] == OPEN
        more = now["strikes"] + 1
        state = (
            F.when(closed, F.when(bad & (more >= strikes), F.lit(OPEN)).otherwise(F.lit(CLOSED)))
            .when(opened, F.when(now["waited"] + 1 >= wait, F.lit(HALF_OPEN)).otherwise(F.lit(OPEN)))
            .otherwise(F.when(~seen, F.lit(HALF_OPEN)).when(bad, F.lit(OPEN)).otherwise(F.lit(CLOSED)))
        )
        counted = F.when(opened | ~seen, now["strikes"]).when(~bad, number(0)).when(closed, more).otherwise(now["strikes"])
        return F.struct(state.alias("state"), counted.cast("int").alias("strikes"), F.when(opened, now["waited"] + 1).otherwise(number(0)).cast("int").alias("waited"))

    first = F.struct(F.lit(CLOSED).alias("state"), number(0).alias("strikes"), number(0).alias("waited"))
    folded = records.groupBy("source").agg(F.aggregate(F.array_sort(F.collect_list(record)), first, step).alias("now"))
    return folded.select("source", "now.state", "now.strikes", "now.waited")
