"""

Same environment as bench.py. Rates are warm: each measurement is taken after one run of the same job.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from mentionflow.operators.dedup import first_wins  # noqa: E402
from mentionflow.operators.match import match_all, match_first  # noqa: E402
from mentionflow.plans import adapters as ad  # noqa: E402
from mentionflow.session import build_session, new_path, spread_scan, staged  # noqa: E402
from mentionflow.sinks.fanout import Sinks  # noqa: E402
from mentionflow.sinks.table import insert_posts  # noqa: E402
from mentionflow.sources.landed import stream_landed  # noqa: E402
from mentionflow.sources.posts import arrival, social_record, web_items  # noqa: E402
from mentionflow.streaming.ingest import start_ingest  # noqa: E402


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def noop(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def extraction(spark, sf_dir) -> dict[str, float]:
    pages = ad.landed_pages(spark, sf_dir)
    rows = pages.count()
    result = {}
    for name, scan in (("one_core", pages.coalesce(1)), ("all_cores", spread_scan(pages))):
        job = lambda scan=scan: noop(web_items(scan, ad.LINK_RULES))
        job()
        result[name] = round(rows / seconds(job))
    return result


def insertion(spark, sf_dir) -> dict[str, float]:
    matched = match_first(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    batch, _ = staged(ad.document_posts(matched, ["doc_id"]), "bench")
    rows = batch.count()
    result = {}
    for name, stored in (("0", F.lit(False)), ("50", F.col("doc_id") % 2 == 0), ("100", F.lit(True))):
        path = new_path(spark, "table")
        insert_posts(batch.filter(stored), path)
        result[name] = round(rows / seconds(lambda path=path: insert_posts(batch, path)))
    return result


def dedup_shuffle_bytes(spark, sf_dir) -> int:
    store = spark.sparkContext._jsc.sc().statusStore()
    quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def written() -> int:
        stages = store.stageList(None, False, False, quantiles, None)
        return sum(stages.apply(at).shuffleWriteBytes() for at in range(stages.size()))

    found = match_all(ad.documents(spark, sf_dir), "text", ad.KEYWORDS)
    before = written()
    noop(first_wins(found.select("source", "post_id", "keyword_ord", "keyword"), ["keyword_ord"]))
    return written() - before


def micro_batches(spark, sf_dir) -> dict[str, float]:
    events = ad.table(spark, sf_dir, "events")

    def to_posts(batch):
        items = batch.select(*ad.social_columns(), F.col("event_type").alias("keyword"))
        return social_record(items, extra=arrival(F.lit(0), F.col("id")))

    result = {}
    for files in (1, 10, 100):
        landing, work = new_path(spark, "landing"), new_path(spark, "stream")
        events.repartition(files).write.parquet(landing)
        stream = stream_landed(spark, landing, events.schema)
        sinks = Sinks(f"{work}/jsonl", f"{work}/table")
        result[str(files)] = round(
            seconds(lambda: start_ingest(stream, to_posts, sinks, f"{work}/check").awaitTermination()), 2
        )
    return result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {"spark.sql.shuffle.partitions": "8" if cpus == "*" else cpus, "spark.driver.memory": "16g"}
    settings |= {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("bench_details", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    result = {}
    for name, measure in (
        ("extraction_pages_per_second", extraction),
        ("insert_rows_per_second_by_overlap", insertion),
        ("first_wins_shuffle_bytes", dedup_shuffle_bytes),
        ("micro_batch_seconds_by_files", micro_batches),
    ):
        result[name] = measure(spark, sf_dir)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
