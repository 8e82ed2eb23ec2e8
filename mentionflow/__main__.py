"""Batch run from the command line: `spark-submit ... -m mentionflow --landed web=/pages --landed x=/items`."""

from __future__ import annotations

import argparse
import json
import os

from mentionflow import schema
from mentionflow.plans.config import FAMILIES, resolve_config
from mentionflow.plans.run import run
from mentionflow.session import build_session
from mentionflow.sinks.database import connection_options
from mentionflow.sources.landed import read_landed

LAYOUTS = {
    "x": schema.SOCIAL_ITEM,
    "x_pages": schema.CARD_PAGE,
    "web": schema.PAGE,
    "instagram": schema.CAPTION_ITEM,
    "tiktok": schema.VIDEO_ITEM,
    "youtube": schema.VIDEO_COMMENT,
    "ecommerce": schema.REVIEW_ITEM,
}


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="mentionflow", description="Monitor keywords in landed posts and pages.")
    parser.add_argument("--landed", action="append", required=True, metavar="KIND=PATH",
                        help=f"landed input, one of {', '.join(LAYOUTS)}; several of a kind are read together")
    parser.add_argument("--format", default="parquet", help="file format of the landed inputs")
    parser.add_argument("--keywords", help="comma-separated keywords")
    parser.add_argument("--x-max-results", type=int, help="most posts per keyword of the social search")
    parser.add_argument("--source", choices=["all", *FAMILIES], help="source family to run")
    parser.add_argument("--lang", help="language of the social search")
    parser.add_argument("--output-dir", help="directory of the JSON lines")
    parser.add_argument("--table-dir", help="directory of the posts table")
    return parser.parse_args()


def main() -> None:
    args = arguments()
    url = os.environ.get("DATABASE_URL", "")
    config = resolve_config(
        {
            "keywords": args.keywords,
            "max_per_keyword": args.x_max_results,
            "source": args.source,
            "lang": args.lang,
            "output_dir": args.output_dir,
            "table_dir": args.table_dir,
            "database": connection_options(url, "stored_posts") if url.startswith("jdbc:") else None,
        },
        os.environ,
    )
    landed: dict[str, list[str]] = {}
    for entry in args.landed:
        kind, _, path = entry.partition("=")
        if kind not in LAYOUTS or not path:
            raise SystemExit(f"not a landed input: {entry}")
        landed.setdefault(kind, []).append(path)
    inputs = {}
    for family in {kind.removesuffix("_pages") for kind in landed}:
        parts = [(kind, paths) for kind, paths in landed.items() if kind.removesuffix("_pages") == family]
        inputs[family] = [
            lambda spark, kind=kind, paths=paths: read_landed(spark, paths, LAYOUTS[kind], args.format) for kind, paths in parts
        ]
    report = run(build_session(), config, inputs)
    print(json.dumps({"social": report.social, "web": report.web, "duplicates": report.duplicates,
                      "rejected": report.rejected, "failed": dict(report.failed)}))


if __name__ == "__main__":
    main()
