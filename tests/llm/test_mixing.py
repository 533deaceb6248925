import re
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import SMALL
from tidemark.llm import catalog, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Reshare the excess until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        total = sum(weight[s] for s in rest)
        want = {s: left * weight[s] / total for s in rest}
        over = [s for s in rest if want[s] > cap * sizes[s]]
        if not over:
            return full | want
        for s in over:
            full[s] = cap * sizes[s]
            left -= full[s]


def check(rows, out):
    """rows: (doc_id, source, text); out: the query's rows."""
    size_of = Counter()
    words = [(k, s, len(WORD.findall(t or ""))) for k, s, t in rows]
    for _, s, n in words:
        size_of[s] += n
    want = targets(size_of)
    assert Counter((k, n, size_of[s]) for k, s, n in words) == \
        Counter((r.doc_id, r.size, r.source_size) for r in out)
    assert all(r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in out)
    assert sorted(round(want[s], 3) for _, s, _ in words) == sorted(round(r.target, 3) for r in out)
    by_target, largest = Counter(), defaultdict(int)
    for r in out:
        by_target[round(r.target, 3)] += r.taken
        largest[round(r.target, 3)] = max(largest[round(r.target, 3)], r.size)
    for t, taken in by_target.items():
        n_sources = sum(round(w, 3) == t for w in want.values())
        assert abs(taken - t * n_sources) <= 2 * n_sources * largest[t]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    out = catalog.op9_source_mix(spark, SMALL).collect()
    check([(r.doc_id, r.source, r.text) for r in docs], out)
    again = catalog.op9_source_mix(spark, SMALL).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


@pytest.mark.parametrize("fan_in", [2, 5])
def test_levels_of_the_tree_and_a_hot_source(spark, monkeypatch, fan_in):
    monkeypatch.setattr(mixing, "FAN_IN", fan_in)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i * i % 37)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    units = mixing.allocate(docs)
    out = units.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken")
    check(rows, out.collect())
    hot = units.filter("source = 'hot'").selectExpr(
        "sum(size * copies) AS taken", "max(target) AS target", "max(size) AS size").first()
    assert abs(hot.taken - hot.target) <= hot.size


def test_chances_are_kept_on_average(spark, monkeypatch):
    rows = [(i, "a", "w " * (1 + i % 5)) for i in range(30)] + [(99, "b", "w " * 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    copies, runs = Counter(), 12
    monkeypatch.setattr(mixing, "FAN_IN", 8)
    for seed in range(runs):
        monkeypatch.setattr(mixing, "SEED", seed)
        for r in mixing.allocate(docs).filter("source = 'b'").collect():
            copies[r.doc_id] += r.copies
            expected = r.target / r.source_size
    assert abs(copies[99] / runs - expected) < 0.45


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.source, r.text) for r in odd_docs.collect()]
    units = mixing.allocate(odd_docs)
    out = units.selectExpr("explode(sequence(1L, rows))", "doc_id", "size", "source_size",
                           "target", "size * copies AS taken").collect()
    check(rows, out)
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    took = Counter()
    for r in out:
        took[r.doc_id] += r.taken
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
    assert got == +took
    assert mixing.allocate(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_no_python_in_the_plan(odd_docs):
    plan = mixing.mix(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
