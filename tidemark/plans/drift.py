"""Schema drift of stored tables: every partition and file against the declared schema."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.quality import contract_diff
from tidemark.session import path_exists
from tidemark.sources.tables import stored_parts
from tidemark.specs import TableSpec

DRIFT = T.StructType([T.StructField("partition", T.DateType()),
                      T.StructField("column_name", T.StringType()),
                      T.StructField("issue", T.StringType()),
                      T.StructField("expected_type", T.StringType()),
                      T.StructField("actual_type", T.StringType())])

VERDICTS = "_drift"
VERDICT = ("file string, modified timestamp, bytes bigint, definition string, "
           "column_name string, issue string, expected_type string, actual_type string")


def _any_drift(spark: SparkSession, folders: list[str], path: str, spec: TableSpec) -> bool:
    """Whether any footer has a column more or of another type than declared."""
    try:
        merged = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*folders)
    except (PySparkException, Py4JJavaError):    # types that do not merge
        return True
    return bool(contract_diff(merged.drop(spec.part_col).schema, spec.schema))


def _stored_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(file, modified, bytes) of the data files of some partitions; a listing, nothing is
    opened.  ``file`` is the partition folder and the name."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
              .load(folders).select("path", "modificationTime", "length"))
    return listed.select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("file"),
                         F.col("modificationTime").alias("modified"),
                         F.col("length").alias("bytes"))


def _kept_verdicts(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Verdicts of earlier runs under the same declared schema."""
    if not path_exists(spark, f"{path}/{VERDICTS}"):
        return spark.createDataFrame([], VERDICT)
    return spark.read.schema(VERDICT).parquet(f"{path}/{VERDICTS}").filter(
        F.col("definition") == F.lit(spec.schema.simpleString()))


def _file_drift(spark: SparkSession, path: str, spec: TableSpec, files: list[str],
                threads: int) -> dict[str, list[tuple]]:
    """What the footers of each of ``files`` show against the declared schema."""
    found: dict[str, list[tuple]] = {f: [] for f in files}
    by_part: dict[str, list[str]] = {}
    for f in files:
        by_part.setdefault(f.split("/")[0], []).append(f)

    def one(f: str) -> list[tuple]:
        return contract_diff(spark.read.parquet(f"{path}/{f}").schema, spec.schema)

    odd: list[str] = []
    if _any_drift(spark, [f"{path}/{f}" for f in files], path, spec):
        with ThreadPoolExecutor(threads) as pool:
            drifted = pool.map(lambda fs: _any_drift(spark, [f"{path}/{f}" for f in fs], path, spec),
                               by_part.values())
            odd = [f for fs, differs in zip(by_part.values(), drifted) if differs for f in fs]
            found.update(zip(odd, pool.map(one, odd)))
    rest = sorted(set(files) - set(odd))
    if rest:
        rows = spark.read.schema(spec.schema).parquet(*[f"{path}/{f}" for f in rest])
        per_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            *[F.count(c).alias(c) for c in spec.columns])
        empty = per_file.filter(F.least(*[F.col(c) for c in spec.columns], F.lit(1)) == 0)
        for r in empty.select("file").toLocalIterator():
            name = "/".join(r["file"].split("/")[-2:])
            found[name] = one(name)
    return found


def stored_drift(spark: SparkSession, path: str, spec: TableSpec, since=None,
                 threads: int = 16) -> list[tuple]:
    """``(partition, column, issue, expected, actual)`` of every partition a build reads
    (those from ``since``'s on).

    Verdicts are kept per file (name, size, time) and declared schema, in a folder of the table
    that readers skip, so only files that came since the last run are opened; a run over an
    unchanged table lists files and reads the verdicts.  The footers of new files are merged
    in one distributed job.  If they differ from the declared schema, each partition's new
    files are merged on their own, and those of a differing one read singly.  A column that
    some files lack reads as NULL there: new files without a single value of a column are
    found by one distributed scan, and those files' own footers decide."""
    parts = [p for p in stored_parts(spark, path, spec) if since is None or p >= since]
    if not parts:
        return []
    there = _stored_files(spark, [f"{path}/{spec.part_col}={p.isoformat()}" for p in parts]
                          ).persist()
    try:
        same = ["file", "modified", "bytes"]
        kept = _kept_verdicts(spark, path, spec)
        drift = {(r.file, (r.column_name, r.issue, r.expected_type, r.actual_type))
                 for r in kept.filter("issue IS NOT NULL").join(there, same, "left_semi")
                 .toLocalIterator()}
        new = there.join(kept, same, "left_anti").collect()    # as the reader's file index
    finally:
        there.unpersist()
    if new:
        found = _file_drift(spark, path, spec, sorted(r.file for r in new), threads)
        text = spec.schema.simpleString()
        rows = [(r.file, r.modified, r.bytes, text, *d) for r in new
                for d in (found[r.file] or [(None,) * 4])]
        spark.createDataFrame(rows, VERDICT).coalesce(1).write.mode("append").parquet(
            f"{path}/{VERDICTS}")
        drift |= {(f, d) for f, ds in found.items() for d in ds}
    day = dt.date.fromisoformat
    return sorted({(day(f.split("/")[0].split("=")[1]), *d) for f, d in drift}, key=str)


def drift_report(spark: SparkSession, path: str, spec: TableSpec, since=None) -> DataFrame:
    """``stored_drift`` as a table."""
    return spark.createDataFrame(stored_drift(spark, path, spec, since), DRIFT)
