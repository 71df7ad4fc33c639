"""What the jobs share: settings, tables by their settings, the command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def settings(job: str, path: str | None = None) -> dict:
    """The job's settings, from its own file beside the module or another one on the driver."""
    return json.loads(Path(path or Path(__file__).with_name(f"{job}.json")).read_text(encoding="utf-8"))


def place(tables: str, source: dict) -> str:
    """Where a source of the settings is: its own path, or its table in the folder of tables."""
    return source["path"] if "path" in source else f"{tables.rstrip('/')}/{source['table']}"


def selected(rows: DataFrame, source: dict) -> DataFrame:
    """The source's rows under the library's names: ``columns`` gives each its SQL expression, ``where`` a condition."""
    rows = rows.where(source["where"]) if "where" in source else rows
    return rows.select(*[F.expr(e).alias(name) for name, e in source["columns"].items()])


def table(spark: SparkSession, tables: str, source: dict) -> DataFrame:
    return selected(spark.read.format(source.get("format", "parquet")).options(**source.get("options", {})).load(place(tables, source)), source)


def main(job: str, about: str, run: Callable[..., dict], *paths: str) -> None:
    """Runs a job from the command line, in a session of its own."""
    arguments = argparse.ArgumentParser(prog=f"python -m jobs.{job}", description=about)
    arguments.add_argument("--tables", required=True, help="folder of the input tables")
    for name in paths:
        arguments.add_argument(f"--{name}", required=True)
    arguments.add_argument("--config", help=f"settings; those of {job}.json if it is left out")
    given = arguments.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(job).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        print(json.dumps(run(spark, given.tables, *[getattr(given, name) for name in paths], settings(job, given.config)), sort_keys=True))
    finally:
        spark.stop()
