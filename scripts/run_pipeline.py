"""Run the whole flow on a table directory: land Bronze, clean it into Silver,
load Gold, build the marts and publish documents; then run it again to show
that nothing is added twice, and refresh one day of marts incrementally.

Usage: python scripts/run_pipeline.py [sf_dir]
Outputs go under the session's checkpoint folder (a temp folder locally).
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tickforge.plans import datasets as ds  # noqa: E402
from tickforge.plans import pipeline as pl  # noqa: E402
from tickforge.session import get_session, work_dir  # noqa: E402
from tickforge.sinks import writers  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", shuffle_partitions=8,
                        extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    root = work_dir(spark, "lake")
    bronze, silver, dead, gold, marts, docs = (f"{root}/{n}" for n in
                                               ("bronze", "silver", "dead_letter", "gold", "marts", "documents"))
    writers.write_bronze(ds.bronze(spark, sf), bronze)
    report = {"lake": root}
    for run in (1, 2):
        m = pl.bronze_to_silver(spark, bronze, silver, dead, run_id=f"run{run}")
        g = pl.silver_to_gold(spark, silver, gold)
        pl.gold_to_marts(spark, gold, marts)
        d = pl.marts_to_documents(spark, gold, marts, docs, run_time=f"2024-02-0{run}T00:00:00Z")
        report[f"run{run}"] = {"silver": m.as_dict(), "gold": g,
                               "documents": {k: v for k, v in d.items() if k != "path"}}
    day = str(spark.read.parquet(f"{marts}/mart_daily_summary").agg(F.max("trade_date")).first()[0])
    pl.gold_to_marts(spark, gold, marts, dates=[day])
    report["incremental_refresh"] = day
    report["mart_rows"] = {n: spark.read.parquet(f"{marts}/{n}").count()
                           for n in ("mart_daily_summary", "mart_symbol_performance", "mart_daily_state")}
    print(json.dumps(report, indent=2, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
