"""Run the medallion layers: ``python -m strata <data folder> [stage ...]``.

Stages: bronze, silver, gold, incremental, layout, snapshots (default: bronze silver gold).
Tables go to the plain layer schemas (bronze / silver / gold), stored in a fresh
folder under ``spark.checkpoint.dir``; ``--run-ts now`` stamps loads with the wall clock.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from strata.config import Config
from strata.plans.medallion import MedallionRun
from strata.session import new_run_root
from strata.sources.tables import Warehouse


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m strata")
    ap.add_argument("data", help="folder with the source parquet tables")
    ap.add_argument("stages", nargs="*", default=["bronze", "silver", "gold"])
    ap.add_argument("--run-ts", default=Config.run_ts, help="load stamp, or 'now'")
    ap.add_argument("--root", default=None,
                    help="new table folder (default: a fresh <spark.checkpoint.dir>/strata/warehouse-<id>)")
    ap.add_argument("--config", default=None, help="your own ingestion config (JSON list of FilePath, TargetTableName) for the bronze stage")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("strata").getOrCreate()
    cfg = Config(run_ts=None if args.run_ts == "now" else args.run_ts).resolved()
    # the session catalog lives as long as the session, so each run takes a fresh folder
    root = args.root or new_run_root(spark, "warehouse")
    print(f"tables under {root}")
    p = MedallionRun(spark, args.data, cfg, Warehouse(spark, cfg, root=root, prefix=""), config_file=args.config)
    steps = {"bronze": p.bronze, "silver": p.silver, "gold": p.gold, "incremental": p.incremental,
             "layout": lambda: (p.partitioned_fact(), p.zordered_fact()), "snapshots": p.fact_snapshots}
    for s in args.stages:
        steps[s]()
        print(f"{s}: done")


if __name__ == "__main__":
    main()
