"""Bloom filters of the keys of stored partitions.

Where a table's date is no part of its key, a batch key may stand in any partition.  Each
partition keeps filters of its keys in a folder of its own (readers skip it, and a swap of
the partition replaces both together): one per bucket of the key's hash, ten bits a key, in
Parquet.  ``may_hold`` brings the filters of a bucket and the batch keys of that bucket
together, so neither the filters nor the batch meet whole in one task, and names the
partitions that may hold a batch key: none that does is missing, about one key in a hundred
is named falsely per partition.  A partition without filters may hold any key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import delete_path, path_exists, rename_path
from tidemark.specs import TableSpec

FOLDER = "_keys"
BUCKETS = 256
BITS_A_KEY = 10
PROBES = 7
FILTER = "held date, bucket int, n_keys long, bits binary"


def _hashed(df: DataFrame, keys, *cols) -> DataFrame:
    h = F.xxhash64(*keys)
    return df.select(*cols, F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket"), h.alias("h"))


def _probes(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """Bit positions of every hash, a row per probe."""
    h = hashes.view(np.uint64) // np.uint64(BUCKETS)
    step = (h >> np.uint64(28)) | np.uint64(1)
    return ((h + np.arange(PROBES, dtype=np.uint64)[:, None] * step) % np.uint64(n_bits)
            ).astype(np.int64)


def _build(table: pa.Table) -> pa.Table:
    hashes = np.unique(table["h"].to_numpy())
    bits = np.zeros(max(64, -(-BITS_A_KEY * len(hashes) // 8) * 8), bool)
    bits[_probes(hashes, len(bits)).ravel()] = True
    return pa.table({"held": table["held"].slice(0, 1), "bucket": table["bucket"].slice(0, 1),
                     "n_keys": pa.array([len(hashes)]),
                     "bits": pa.array([np.packbits(bits).tobytes()])})


def _test(filters: pa.Table, batch: pa.Table) -> pa.Table:
    hashes = batch["h"].to_numpy()
    named = []
    for held, raw in zip(filters["held"].to_pylist(), filters["bits"].to_pylist(), strict=True):
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)
        if len(hashes) and bits[_probes(hashes, len(bits))].all(axis=0).any():
            named.append(held)
    return pa.table({"held": pa.array(named, pa.date32())})


def write_filters(spark: SparkSession, stage: str, spec: TableSpec, parts) -> None:
    """Put filters into the folders of the staged partitions ``parts``."""
    if not parts:
        return
    pc = spec.part_col
    rows = spark.read.parquet(stage).select(*spec.keys, F.col(pc).cast("date").alias("held"))
    filters = (_hashed(rows, spec.keys, "held").groupBy("held", "bucket")
               .applyInArrow(_build, FILTER))
    made = f"{stage}/_filters"
    (filters.withColumn(pc, F.col("held")).repartition(pc).write.partitionBy(pc).parquet(made))
    for part in parts:
        name = f"{pc}={part.isoformat()}"
        rename_path(spark, f"{made}/{name}", f"{stage}/{name}/{FOLDER}")
    delete_path(spark, made)


def may_hold(spark: SparkSession, path: str, batch: DataFrame, spec: TableSpec, parts) -> list:
    """Those of the partitions ``parts`` that may hold a key of the batch."""
    folders = {p: f"{path}/{spec.part_col}={p.isoformat()}/{FOLDER}" for p in parts}
    filtered = {p: f for p, f in folders.items() if path_exists(spark, f)}
    named = set(parts) - set(filtered)
    if filtered:
        filters = spark.read.schema(FILTER).parquet(*filtered.values())
        hashes = _hashed(batch, spec.keys).distinct()
        found = (filters.groupBy("bucket").cogroup(hashes.groupBy("bucket"))
                 .applyInArrow(_test, "held date"))
        named |= {r[0] for r in found.distinct().collect()}    # bounded by the calendar
    return sorted(named)
