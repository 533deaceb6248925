import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from tidemark.llm import catalog, exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for k, t in rows:
        groups.setdefault(norm(t), []).append(k)
    out = []
    for k, t in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((k, keep, len(g), k == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex())
                   for r in df.collect()), key=str)


def test_query_against_brute_force(spark, small_texts):
    out = catalog.op3_exact_dedup(spark, SMALL)
    rows = sorted(map(tuple, out.select("doc_id", "keep_id", "group_size", "kept",
                                        "text_sha256").collect()), key=str)
    assert rows == expected(list(small_texts.items()))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(exact_dedup.DigestIndex(spark).add(odd_docs)) == expected(rows)
    assert exact_dedup.DigestIndex(spark).add(no_docs).count() == 0


def test_hot_group_and_index_across_batches(spark):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    first = spark.createDataFrame([(i, "hot  text" if i % 3 else f"t{i}") for i in range(60)],
                                  "doc_id bigint, text string")
    again = spark.createDataFrame([(5, "hot\ttext"), (90, "t0"), (91, "new"), (92, "new")],
                                  "doc_id bigint, text string")
    a = {r.doc_id: r for r in index.add(first).collect()}
    assert a[1].kept and a[1].group_size == 40 and a[2].keep_id == 1 and not a[2].kept
    b = {r.doc_id: (r.keep_id, r.kept) for r in index.add(again).collect()}
    assert b == {5: (1, False), 90: (0, False), 91: (91, True), 92: (91, False)}
    assert index.table().count() == 22
    reopened = exact_dedup.DigestIndex(spark, index.path, 3)
    assert reopened.table().count() == 22
    assert {r.kept for r in reopened.add(again).collect()} == {False, True}


def test_index_scan_needs_no_shuffle(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    index.add(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string"))
    plan = (index.table().groupBy("digest").count()
            ._jdf.queryExecution().executedPlan().toString())
    assert "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("kind", ["string", "int", "date"])
def test_ids_of_other_types(spark, kind):
    texts = ["a b", "c", "a  b", None, "", "c"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    made = {"string": F.concat(F.lit("d"), F.col("n").cast("string")), "int": F.col("n"),
            "date": F.date_from_unix_date("n")}[kind]
    docs = docs.withColumn("doc_id", made)
    index = exact_dedup.DigestIndex(spark, buckets=2)
    out = index.add(docs)
    assert out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    ids = [r[0] for r in docs.orderBy("n").select("doc_id").collect()]
    keep = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in out.collect()}
    assert [keep[i] for i in ids] == [
        (ids[f], 2, f == i) for i, f in enumerate([0, 1, 0, 3, 3, 1])]
    index.close()
    later = exact_dedup.DigestIndex(spark, index.path, 2).add(docs.filter("n >= 2"))
    assert {r.doc_id: r.keep_id for r in later.collect()} == {
        ids[i]: ids[f] for i, f in ((2, 0), (3, 3), (4, 3), (5, 1))}


def test_other_id_types_do_not_mix(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    index = exact_dedup.DigestIndex(spark, buckets=2)
    index.add(docs)
    with pytest.raises(TypeError):
        index.add(docs.withColumn("doc_id", F.col("doc_id").cast("string")))
    assert index.add(docs.withColumn("doc_id", F.col("doc_id").cast("int"))).count() == 1


def test_the_query_leaves_no_catalog_table(spark):
    before = {t.name for t in spark.catalog.listTables()}
    catalog.op3_exact_dedup(spark, SMALL).count()
    assert {t.name for t in spark.catalog.listTables()} <= before
