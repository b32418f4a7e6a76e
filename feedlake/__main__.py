"""``spark-submit`` entry: lands two CSV feeds and runs every stage.

    python -m feedlake --root <lake> --panel <csv> --linelist <csv> [--day yyyy-MM-dd]

Without sources the snapshots already in the lake are used.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from feedlake.feeds import LINE_LIST, PANEL
from feedlake.operators.quality import published_cleaning
from feedlake.plans.jobs import Lake, land, run_stages, stages_after_landing
from feedlake.sources import read_detected_csv


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="feedlake")
    parser.add_argument("--root", required=True, help="root of the lake, any path Spark reaches")
    parser.add_argument("--panel", help="CSV file or directory of the panel feed")
    parser.add_argument("--linelist", help="CSV file or directory of the line list")
    parser.add_argument("--panel-country", default="PANEL")
    parser.add_argument("--linelist-country", default="LINELIST")
    parser.add_argument("--day", help="snapshot day, today if left out")
    parser.add_argument("--encoding", default="UTF-8")
    parser.add_argument("--missing", choices=("null", "zero"), default="null")
    parser.add_argument("--clean", action="store_true", help="apply the published quality rules")
    parser.add_argument("--quarantine", action="store_true", help="set broken lines aside")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("feedlake").getOrCreate()
    lake = Lake(options.root)
    stages = {
        f"land_{feed.name}": lambda feed=feed, path=path: land(
            read_detected_csv(spark, path, options.encoding), lake, feed, options.day
        )
        for feed, path in ((PANEL, options.panel), (LINE_LIST, options.linelist))
        if path
    }
    stages |= stages_after_landing(
        spark,
        lake,
        options.panel_country,
        options.linelist_country,
        options.day,
        options.missing,
        {feed.name: published_cleaning(feed) for feed in (PANEL, LINE_LIST)} if options.clean else None,
        options.quarantine,
    )
    results = run_stages(stages)
    for result in results:
        outcome = "ok" if result.ok else f"failed: {result.error}"
        print(f"{result.name}: {outcome} ({result.seconds:.1f} s) {result.details or ''}")
    return 0 if all(result.ok for result in results) else 1


if __name__ == "__main__":
    sys.exit(main())
