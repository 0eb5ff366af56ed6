"""`python -m logloom [log ...] [--root folder]`: load a log, refresh tables and reports."""

from __future__ import annotations

import argparse

from pyspark import SparkConf

from .plans.build import build_tables
from .scratch import shared_folder
from .session import CLUSTER_SETTINGS, build_session
from .sources.logs import DEFAULT_LOG


def main() -> None:
    options = argparse.ArgumentParser(prog="logloom", description="Load an access log, refresh tables and reports.")
    options.add_argument("log", nargs="*", default=[DEFAULT_LOG], help="files, folders or globs")
    options.add_argument("--root", default="logloom-tables", help="folder of the tables")
    options.add_argument("--rejects", help="folder for lines that do not parse")
    options.add_argument("--shared", help="folder for intermediate tables, if spark.checkpoint.dir is not set")
    options.add_argument("--spread-days", action="store_true", help="the files mix many days")
    given = options.parse_args()
    local = SparkConf().get("spark.master", "local[*]").startswith("local")
    spark = build_session(**({} if local else CLUSTER_SETTINGS))
    if not shared_folder(spark):
        # beside the tables, which all executors reach
        spark.sparkContext.setCheckpointDir(given.shared or f"{given.root.rstrip('/')}/.work")
    load = build_tables(spark, given.log, given.root, rejects_path=given.rejects, spread_days=given.spread_days)
    print(f"load {load.load_id}: {load.accepted} requests, {load.rejected} lines left out")
    spark.stop()


if __name__ == "__main__":
    main()
