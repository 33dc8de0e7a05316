"""Run a job file: ``python -m rowbridge job.json [name=value ...]``."""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession

from rowbridge.plans.job import load_job, run_job


def main(arguments: list[str]) -> int:
    if not arguments:
        print(__doc__)
        return 2
    variables = dict(a.partition("=")[::2] for a in arguments[1:])
    spark = SparkSession.builder.appName("rowbridge").getOrCreate()
    print(json.dumps(run_job(spark, load_job(arguments[0], variables)), ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
