"""Ids of other types than bigint."""
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    line_templates,
    mixing,
    near_dedup,
    ppm,
    quality_lr,
    secret_forest,
    toxicity_fm,
    weak_rules,
)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_operators_keep_the_type_of_the_id(spark, kind):
    docs = spark.createDataFrame(
        [(i, "one two three four five six seven eight " * (1 + i % 3), "en", "a") for i in range(6)],
        "doc_id int, text string, lang string, source string").withColumn(
            "doc_id", F.col("doc_id").cast(kind))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(1).alias("toxic"))
    results = [weak_rules.judge(docs), quality_lr.classify(docs, labels),
               toxicity_fm.classify(docs, labels), near_dedup.find(docs),
               line_templates.dedup_lines(docs), ppm.score(docs, F.lit(True)),
               mixing.allocate(docs)]
    for out in results:
        assert out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        assert out.select("doc_id").distinct().count() == 6
    assert secret_forest.scan(docs).count() == 0
