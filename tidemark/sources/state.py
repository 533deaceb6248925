"""Watermark state: one row per source, ``(source, last_watermark)``.

Written *after* the data it describes; a crash between the two is harmless because the data
write is an idempotent keyed upsert.

Every save is a version of its source: a small numbered file that can be made only once.
A load remembers the version it planned from and saves the next one, so of two loads of one
source that planned from the same version one saves and the other raises ``StaleState``; a
slow load can never move the watermark back.  The newest version is the state.  A Parquet
table of the same rows is kept beside the versions for other readers.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import as_date
from tidemark.session import create_once, list_names, path_exists, read_text
from tidemark.specs import STATE

VERSIONS = "_versions"


class StaleState(RuntimeError):
    """Another load of the source has saved its watermark since this one planned."""


def _folder(path: str, source: str) -> str:
    return f"{path}/{VERSIONS}/{quote(source, safe='')}"


def state_version(spark: SparkSession, path: str, source: str) -> int:
    """The number of the newest saved version of a source; 0 before the first.  Read it
    before the state that a load plans from."""
    numbers = [n[:-len(".json")] for n in list_names(spark, _folder(path, source))]
    return max((int(n) for n in numbers if n.isdigit()), default=0)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The state table; absent ⇒ empty (every watermark unknown)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE.schema)
    saved = []
    for name in list_names(spark, f"{path}/{VERSIONS}"):    # one per source
        source = unquote(name)
        n = state_version(spark, path, source)
        if n:
            kept = json.loads(read_text(spark, f"{_folder(path, source)}/{n}.json"))
            saved.append((source, as_date(kept["last_watermark"])))
    rows = spark.read.schema(STATE.schema).parquet(path).select(*STATE.columns)
    if not saved:
        return rows
    return spark.createDataFrame(saved, STATE.schema).unionByName(
        rows.filter(~F.col("source").isin([s for s, _ in saved])))


def save_state(spark: SparkSession, path: str, new_state: DataFrame,
               seen: Mapping[str, int] | None = None) -> None:
    """Replace the rows of the given sources; other sources' watermarks are never rewritten,
    and sources may save at the same time.  ``seen`` (source to version): raise unless this
    is still the newest version of the source, with nothing saved."""
    new_state = new_state.select(*STATE.columns)
    for r in new_state.collect():    # one row per source
        day = r["last_watermark"]
        text = json.dumps({"last_watermark": day.isoformat() if day else None})
        while True:
            now = state_version(spark, path, r["source"])
            if seen is not None and now != seen[r["source"]]:
                raise StaleState(f"{r['source']}: planned from version {seen[r['source']]}, "
                                 f"the newest is {now}; run the load again")
            if create_once(spark, f"{_folder(path, r['source'])}/{now + 1}.json", text):
                break
    (new_state.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path))


def watermark_of(state: DataFrame, source: str):
    row = state.filter(F.col("source") == F.lit(source)).select("last_watermark").first()
    return row[0] if row else None
