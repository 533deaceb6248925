"""Labelled rows for the classifiers: held-out split and bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows a classifier is fitted on at most, in expectation; more are thinned by a
#: hash of their id.
TRAIN_ROWS = 10_000
#: Example visits of a fit: small samples are passed over more often.
VISITS = 40_000


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (null id: remainder 0)."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.crc32(F.encode(text, "UTF-8")) % divisor)


def training_labels(labels: DataFrame, label: str, key: str = "doc_id",
                    max_rows: int = TRAIN_ROWS, folds: int = 5) -> DataFrame:
    """(key, y double, order long) of at most about ``max_rows`` labelled ids outside the
    held-out fold.  Null ids and labels are left out; an id labelled several times gets
    the majority, 1 on a tie."""
    seen = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
            .groupBy(key).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("double").alias("y"))
            .filter(id_remainder(key, folds) != 0)
            .withColumn("order", F.xxhash64(F.lit(17), F.col(key))))
    n = seen.count()
    if n > max_rows:
        share = F.pmod(F.col("order"), F.lit(1 << 20))
        seen = seen.filter(share < int((1 << 20) * max_rows / n))
    return seen


def training_rows(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id",
                  text: str = "text", max_rows: int = TRAIN_ROWS) -> DataFrame:
    """(y, order, text) of the sampled labelled documents.  The sample's labels, bounded by
    ``max_rows``, are broadcast, so texts are filtered where they are read."""
    sample = training_labels(labels, label, key, max_rows)
    return (docs.select(key, F.col(text).alias("text"))
            .join(F.broadcast(sample), key).select("y", "order", "text"))
