"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest.  A batch is reduced to one row per
digest (partial aggregation, so a text repeated millions of times travels as one row per
task), anti-joined with the index by sort-merge, and what is new is appended to the same
buckets.

Defined cases: a null text equals the empty one; texts are compared after replacing each
run of space and 0x09-0x0D by one space; the kept row of a group is the smallest id (rows
that repeat that id all say kept); rows with a null id are kept only in a group without
any id; an empty batch leaves the index as it is and gives no rows; columns other than id
and text are not read, so their names cannot clash; ids are of any orderable type: an index
takes that of its first batch, and a batch of another type raises (integers are widened).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, list_names, scratch_path
from .scratch import staged
from .skew import join_groups


def normalised(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: str | Column) -> Column:
    """SHA-256 (binary) of the normalised text in UTF-8."""
    return F.unhex(F.sha2(F.encode(normalised(text), "UTF-8"), 256))


class DigestIndex:
    """Digests seen so far, with the id that was kept for each."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        """Open the index at ``path`` (a fresh one in the shared scratch folder by
        default); ``buckets`` must be what it was created with."""
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table_name = f"digest_index_{uuid.uuid4().hex[:12]}"
        self.id_type: T.DataType | None = None
        if any(name.endswith(".parquet") for name in list_names(spark, self.path)):
            self._open(spark.read.parquet(self.path).schema["first_id"].dataType)

    def _open(self, id_type: T.DataType) -> None:
        """Name the index in the catalog, with ids of this type."""
        self.id_type = id_type
        self.spark.sql(
            f"CREATE TABLE {self.table_name} (digest BINARY, first_id {id_type.simpleString()}) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")

    def _accept(self, id_type: T.DataType) -> None:
        if self.id_type is None:
            self._open(T.LongType() if isinstance(id_type, T.IntegralType) else id_type)
        elif self.id_type != id_type and not (isinstance(self.id_type, T.LongType)
                                              and isinstance(id_type, T.IntegralType)):
            raise TypeError(f"ids of the index are {self.id_type.simpleString()}, "
                            f"of the batch {id_type.simpleString()}")

    def table(self) -> DataFrame:
        self._accept(self.id_type or T.LongType())
        return self.spark.table(self.table_name)

    def close(self) -> None:
        """Take the index out of the catalog; its files stay, to be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table_name}")
        self.id_type = None

    def append_new(self, groups: DataFrame) -> None:
        """Append the groups (digest, first_id) whose digest the index lacks."""
        fresh = groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        path = scratch_path(self.spark, "digest-new")  # a failed write never touches the index
        new = staged(fresh.select("digest", F.col("first_id").cast(self.id_type)), "", path)
        (new.repartition(self.buckets, "digest")
         .write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet")
         .mode("append").saveAsTable(self.table_name))
        delete_path(self.spark, path)

    def add(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Deduplicate a batch within itself and against the index, and index it.

        Returns every row of the batch: ``key``, ``digest``, ``keep_id`` (the id indexed
        first for its text), ``group_size`` (rows of this batch with its text), ``kept``.
        """
        spark = self.spark
        id_type = docs.schema[key].dataType
        self._accept(id_type)
        rows = staged(docs.select(F.col(key), digest(text).alias("digest")), "digests")
        grouped = scratch_path(spark, "digest-groups")
        groups = staged(rows.groupBy("digest").agg(F.min(key).alias("first_id"),
                                                   F.count("*").alias("group_size")), "", grouped)
        self.append_new(groups)
        known = staged(groups.drop("first_id").join(self.table().hint("merge"), "digest")
                       .withColumnRenamed("first_id", "keep_id"), "digest-known")
        delete_path(spark, grouped)
        found = join_groups(rows, known, "digest", "group_size", rows.count())
        return found.withColumn("kept", F.col(key).eqNullSafe(F.col("keep_id")))
