"""Sends this package to the executors of an application, so that Python stages can import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Once for each application; without a session, the active one."""
    spark = spark or SparkSession.active()
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    home = Path(__file__).resolve().parent
    target = f"{tempfile.mkdtemp(prefix='lodestone-')}/{home.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent))
    spark.sparkContext.addPyFile(target)
    _sent.add(app)
