"""Randomised properties (hypothesis, few examples: each one runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.dates import month_bucket
from tidemark.operators.enrich import gap_fill
from tidemark.operators.incremental import merge_incremental, window_replace
from tidemark.operators.series import carry_forward, carry_forward_increment
from tidemark.operators.upsert import upsert

S = "k string, date date, v double"
BASE = dt.date(2024, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

cells = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 120),
                           st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))),
                 max_size=60)


def _df(spark, data):
    seen, out = set(), []
    for k, d, v in data:          # natural key (k, date) unique
        if (k, d) not in seen:
            seen.add((k, d))
            out.append((k, BASE + dt.timedelta(days=d), v))
    return spark.createDataFrame(out, S)


@SETTINGS
@given(t=cells, b=cells)
def test_upsert_idempotent_and_keyed(spark, t, b):
    target, batch = _df(spark, t), _df(spark, b)
    once = upsert(target, batch, ["k", "date"])
    assert rows(upsert(once, batch, ["k", "date"])) == rows(once)
    got = {(k, d): v for k, d, v in rows(once)}
    for k, d, v in rows(batch):
        assert got[(k, d)] == v
    assert len(got) == len(rows(once))


@SETTINGS
@given(data=cells, cut=st.integers(0, 130))
def test_locf_forms_and_increment(spark, data, cut):
    df = _df(spark, data)
    keyed = rows(carry_forward(df, "date", ["v"], ["k"]))
    assert rows(carry_forward(df, "date", ["v"], ["k"], bucket=month_bucket("date"))) == keyed
    since = BASE + dt.timedelta(days=cut)
    inc = rows(carry_forward_increment(df, "date", ["v"], since, ["k"]))
    assert inc == [r for r in keyed if r[1] >= since]
    filled = gap_fill(df, "date", "v", ["k"], "f")
    assert rows(gap_fill(df, "date", "v", ["k"], "f", since=since)) == \
        [r for r in rows(filled) if r[1] >= since]


@SETTINGS
@given(t=cells, s=cells)
def test_merge_properties(spark, t, s):
    target, source = _df(spark, t), _df(spark, s)
    keys = ["k", "date"]
    if not rows(target):
        return
    # merging an unchanged source is the identity
    assert rows(merge_incremental(target, target, keys)) == rows(target)
    # window replace: inside the window only source keys remain
    cutoff = max(r[1] for r in rows(target)) - dt.timedelta(days=10)
    wr = rows(window_replace(target, source, "date", 10))
    src_keys = {(k, d) for k, d, _ in rows(source)}
    assert all((k, d) in src_keys for k, d, _ in wr if d >= cutoff)
    assert [r for r in wr if r[1] < cutoff] == [r for r in rows(target) if r[1] < cutoff]


arrays = st.lists(st.one_of(st.none(), st.floats(-9, 9, allow_nan=False)), max_size=6)


@SETTINGS
@given(a=st.one_of(st.none(), arrays), b=st.one_of(st.none(), arrays),
       c=st.one_of(st.none(), arrays))
def test_parallel_arrays_match_python_zip(spark, a, b, c):
    from pyspark.sql import types as T
    from tidemark.sources.landed import explode_parallel
    arr = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("d", T.StructType(
        [T.StructField("a", arr), T.StructField("b", arr), T.StructField("c", arr)]))])
    df = spark.createDataFrame([(1, {"a": a, "b": b, "c": c})], schema)
    got = [tuple(r) for r in explode_parallel(df, {"x": "d.a", "y": "d.b", "z": "d.c"},
                                              carry=["id"]).collect()]
    assert got == [(1, x, y, z) for x, y, z in zip(a or [], b or [], c or [])]


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5)),
                     max_size=40))
def test_key_violations_match_counter(spark, data):
    from collections import Counter
    from tidemark.operators.upsert import key_violations
    df = spark.createDataFrame([(k, BASE + dt.timedelta(days=d)) for k, d in data],
                               "k string, date date")
    rows_, nulls, dups, months = key_violations(df, ["k", "date"], "date")
    cnt = Counter((k, d) for k, d in data)
    assert rows_ == len(data)
    assert nulls == sum(1 for k, _ in data if k is None)
    assert dups == sum(1 for (k, _), n in cnt.items() if k is not None and n > 1)
    assert months == sorted({(BASE + dt.timedelta(days=d)).replace(day=1) for _, d in data})


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.dictionaries(st.sampled_from("abcd"), st.integers(0, 120), min_size=1),
                        min_size=1, max_size=3))
def test_stored_upsert_of_moving_dates_has_one_row_per_key(spark, batches):
    import tempfile
    from pyspark.sql import types as T
    from tidemark.operators.upsert import upsert_path
    from tidemark.sources.tables import read_table
    from tidemark.specs import TableSpec

    spec = TableSpec("p", T.StructType([T.StructField("k", T.StringType()),
                                        T.StructField("date", T.DateType()),
                                        T.StructField("v", T.DoubleType())]), keys=("k",))
    path, want = tempfile.mkdtemp(prefix="tm-prop-") + "/t", {}
    for i, batch in enumerate(batches):
        data = [(k, BASE + dt.timedelta(days=d), float(i)) for k, d in batch.items()]
        upsert_path(spark, path, spark.createDataFrame(data, S), spec)
        want |= {k: (d, v) for k, d, v in data}
    assert {k: (d, v) for k, d, v in rows(read_table(spark, path, spec))} == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(cells, min_size=1, max_size=3))
def test_stored_upsert_equals_in_memory(spark, batches):
    import tempfile
    from pyspark.sql import types as T
    from tidemark.operators.upsert import upsert_path
    from tidemark.sources.tables import read_table
    from tidemark.specs import TableSpec

    spec = TableSpec("p", T.StructType([T.StructField("k", T.StringType()),
                                        T.StructField("date", T.DateType()),
                                        T.StructField("v", T.DoubleType())]), keys=("k", "date"))
    path = tempfile.mkdtemp(prefix="tm-prop-") + "/t"
    expected = spark.createDataFrame([], S)
    for b in batches:
        batch = _df(spark, b)
        upsert_path(spark, path, batch, spec)
        expected = upsert(expected, batch, ["k", "date"])
    assert rows(read_table(spark, path, spec)) == rows(expected)
