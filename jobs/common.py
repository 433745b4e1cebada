"""Command lines, configuration and logging of the jobs."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("jobs")


def config(name: str, path: str | None = None) -> dict:
    """The settings of the file beside the job, replaced by those of ``path``; a name that the job does not know is an error."""
    known = json.loads((Path(__file__).parent / f"{name}.json").read_text())
    given = json.loads(Path(path).read_text()) if path else {}
    if unknown := sorted(set(given) - set(known)):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return known | given


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, counted while they pass on to a writer: no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def total(seen: Observation) -> int:
    """The rows that a write counted; where Spark found beforehand that there are none, it counts nothing."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:  # an empty row, which has no schema
        return 0


def command_line(name: str, about: str, paths: dict[str, str], run: Callable[..., dict], argv: list[str] | None = None) -> None:
    """Parses paths and ``--config``, starts a session for the run and stops it."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=about)
    for path, text in paths.items():
        parser.add_argument(f"--{path}", required=True, help=text)
    parser.add_argument("--config", help=f"JSON file; settings left out are those of jobs/{name}.json")
    given = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    settings = config(name, given.pop("config"))
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        run(spark, **given, settings=settings)
    finally:
        spark.stop()
