"""Command line: `python -m tallyman.cli key=value ...`, or one JSON payload."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from tallyman.operators.drift import log_report
from tallyman.plans.compare import Comparison, config_of_parameters, parse_arguments
from tallyman.sources.sinks import export_summary
from tallyman.sources.tables import sides


def run(args: list[str], spark: SparkSession | None = None) -> Comparison:
    parameters = parse_arguments(args)
    named, config = config_of_parameters(parameters)
    spark = spark or SparkSession.builder.appName("tallyman").getOrCreate()
    done = Comparison(*sides(spark, named["refTable"], named["newTable"], config), config)
    log_report(done.schema_report)
    path = f"{named['outputBucket'].rstrip('/')}/{named['tablePrefix']}"
    done.write(path, named["initiativeName"], named["outputDate"], named["files"])
    if parameters.get("exportExcelPath"):
        export_summary(spark.read.parquet(f"{path}/summary/initiative={named['initiativeName']}/data_date_part={named['outputDate']}"), parameters["exportExcelPath"])
    if (parameters.get("show") or "").lower() == "true":
        for result in (done.differences, done.duplicates, done.summary):
            result.show(100, truncate=False)
    return done


if __name__ == "__main__":
    run(sys.argv[1:])
