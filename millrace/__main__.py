"""The dataset stages as a command: ``python -m millrace [--root DIR] [--log-dir DIR] [STAGE...]``.

Without a stage: clean, eda, profile and split.  Every stage runs whatever the
ones before it report; the command ends with 1 if a dataset failed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import logs, registry
from .plans import pipeline

STAGES = {
    "clean": pipeline.clean_all,
    "eda": lambda spark, manager, config: pipeline.eda_all(spark, manager),
    "profile": lambda spark, manager, config: pipeline.profile_all(spark, manager),
    "split": pipeline.split_all,
}


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="millrace")
    parser.add_argument("stages", nargs="*", metavar="STAGE", help=", ".join(STAGES))
    parser.add_argument("--root", default=".")
    parser.add_argument("--log-dir")
    given = parser.parse_args(arguments)
    unknown = set(given.stages) - set(STAGES)
    if unknown:
        parser.error(f"no such stage: {', '.join(sorted(unknown))}")
    log = logs.start("millrace", given.log_dir)
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    config = registry.load_config()
    manager = registry.DatasetManager.from_config(config, given.root)
    failed = False
    for stage in given.stages or STAGES:
        for key, outcome in STAGES[stage](spark, manager, config).items():
            log.info("%s %s: %s", stage, key, outcome)
            failed |= outcome.startswith("FAILED")
    logs.stop("millrace")
    return int(failed)


if __name__ == "__main__":
    sys.exit(main())
