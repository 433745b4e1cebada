"""JSON sinks and the log."""

from __future__ import annotations

import json
import logging
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls

RECORD = ("overview", "tuition_breakdown", "admission_deadlines", "page_metadata", "extraction_sources", "extraction_confidence", "quality_report")


def record_json(*columns: str, pretty: bool = False) -> Column:
    """One JSON text of the columns, nulls kept, characters as they are."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "pretty": str(pretty).lower()})


def write_json(records: DataFrame, folder: str) -> None:
    """All records as JSON lines, through Spark's writer."""
    columns = [x for x in RECORD if x in records.columns]
    records.select(record_json("seed", *columns).alias("value")).write.mode("overwrite").text(folder)


def write_files(records: DataFrame, folder: str, seed: str = "seed") -> None:
    """One indented file for each seed, named by its domain, in a folder that all executors share.

    A file gets its name when it is whole, so a task that fails or is repeated leaves no part of one under that name.
    """
    columns = [x for x in RECORD if x in records.columns]
    rows = records.select(urls.file_slug(seed).alias("name"), record_json(*columns).alias("json"))

    def save(part):
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        for r in part:
            begun = f"{folder}/.{r.name}.{uuid.uuid4().hex}.part"
            try:
                with open(begun, "w", encoding="utf-8") as f:
                    json.dump(json.loads(r.json), f, indent=2, ensure_ascii=False)
                os.replace(begun, f"{folder}/{r.name}.json")
            finally:
                if os.path.exists(begun):
                    os.remove(begun)

    rows.foreachPartition(save)


def log_to(path: str, level: int = logging.INFO) -> logging.Logger:
    """Console and file; handlers set before are replaced."""
    root = logging.getLogger("lodestone")
    for h in list(root.handlers):
        root.removeHandler(h)
        h.close()
    for h in (logging.StreamHandler(sys.stdout), logging.FileHandler(path, encoding="utf-8")):
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        root.addHandler(h)
    root.setLevel(level)
    return root
