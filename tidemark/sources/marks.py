"""Marks of stored partitions: what a reader has taken in, and what changed since.

A partition's mark is a digest of its data files' names, sizes and times; writers of this
library replace whole partitions by new files, so a mark differs whenever a partition was
replaced, appended to or removed.  A reader keeps the marks it took *before* reading, and
saves them after its own write: what changes in between counts as changed the next time.
Marks are one short text per partition, so their number is bounded by the calendar.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import SparkSession

from tidemark.session import delete_path, path_exists, read_text, rename_path, write_text
from tidemark.sources.tables import stored_parts
from tidemark.specs import TableSpec


def partition_marks(spark: SparkSession, path: str, spec: TableSpec) -> dict[dt.date, str]:
    """The mark of every stored partition (file listings only)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    marks = {}
    for part in stored_parts(spark, path, spec):
        p = folder(f"{path}/{spec.part_col}={part.isoformat()}")
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files = [(s.getPath().getName(), s.getLen(), s.getModificationTime())
                 for s in fs.listStatus(p) if s.isFile()]
        data = sorted(f for f in files if not f[0].startswith(("_", ".")))
        marks[part] = hashlib.sha1(json.dumps(data).encode()).hexdigest()
    return marks


def save_marks(spark: SparkSession, path: str, tables: dict[str, dict[dt.date, str]]) -> None:
    """Keep the marks of several tables in one file.  An interruption leaves the old file or
    none; without one everything counts as changed."""
    draft = f"{path}.draft"
    write_text(spark, draft, json.dumps(
        {t: {p.isoformat(): m for p, m in marks.items()} for t, marks in tables.items()}))
    delete_path(spark, path)
    rename_path(spark, draft, path)


def load_marks(spark: SparkSession, path: str) -> dict[str, dict[dt.date, str]]:
    """The kept marks; none if there is no file or it cannot be read as marks."""
    if not path_exists(spark, path):
        return {}
    try:
        kept = json.loads(read_text(spark, path))
        return {t: {dt.date.fromisoformat(p): m for p, m in marks.items()}
                for t, marks in kept.items()}
    except (ValueError, AttributeError):
        return {}


def changed_parts(now: dict[dt.date, str], kept: dict[dt.date, str]) -> list[dt.date]:
    """Partitions that are new, gone or have other files."""
    return sorted(p for p in now.keys() | kept.keys() if now.get(p) != kept.get(p))


def part_end(part: dt.date, spec: TableSpec) -> dt.date:
    """The last day of a partition."""
    if spec.grain == "day":
        return part
    return (part + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
