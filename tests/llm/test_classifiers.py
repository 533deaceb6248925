import math
import zlib

import numpy as np
import pytest

from tidemark.llm import catalog, labelled, quality_lr, toxicity_fm
from tidemark.llm import textkit as tk


def remainder(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % k


def held_out_pairs(spark, query, label, sf):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = query(spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in out)
    return [(labels[r.doc_id], r.predicted, r.score) for r in out
            if r.held_out and r.doc_id in labels]


def test_quality_on_held_out_documents(spark):
    pairs = held_out_pairs(spark, catalog.op2_quality_lr, "quality", "/root/testdata/sf0.01")
    assert sum(y == p for y, p, _ in pairs) / len(pairs) > 0.97
    assert all(p == (s >= 0.3) for _, p, s in pairs)


def test_toxicity_on_held_out_documents(spark):
    pairs = held_out_pairs(spark, catalog.op5_toxicity_fm, "toxic", "/root/testdata/sf0.1")
    clean = [p for y, p, _ in pairs if y == 0]
    toxic = [p for y, p, _ in pairs if y == 1]
    assert sum(clean) / len(clean) < 0.01
    assert sum(toxic) / len(toxic) > 0.75
    assert all(p == (s >= 0.5) for _, p, s in pairs)


@pytest.mark.parametrize("module", [quality_lr, toxicity_fm])
def test_odd_rows(spark, odd_docs, no_docs, module):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2, "x") for i in range(1, 14)] + [(2, 1, 1, "x"), (None, 1, 0, "x"),
                                                          (7, None, None, "x"), (99, 1, 1, "x")],
        "doc_id bigint, quality int, toxic int, text string")
    out = module.classify(odd_docs, labels).collect()
    assert len(out) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in out)
    empty = {round(r.score, 12) for r in out if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    assert len({r.score for r in out if r.doc_id == 2}) == 1
    assert module.classify(no_docs, labels).count() == 0
    unlabelled = module.classify(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id bigint, quality int")
    ids = [r.doc_id for r in labelled.training_labels(labels, "quality", max_rows=500).collect()]
    assert 350 < len(ids) < 650 and all(remainder(i, 5) for i in ids)
    assert len(ids) == len(set(ids))


def blocks(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(d) for d in data])]


def test_quality_score_is_the_sparse_dot_product():
    rng = np.random.default_rng(1)
    model = quality_lr.Model(0.3, rng.normal(size=1 << quality_lr.BITS).astype(np.float32))
    buf, off = blocks(["Some words, some WORDS !!", "", "one", "a a a a | 12 é"])
    want = []
    for at, value in quality_lr._sparse(buf, off):
        weights = np.r_[model.weights.astype(float), model.bias]
        want.append(1 / (1 + math.exp(-float(weights[at] @ value))))
    assert np.allclose(model.scores(buf, off), want)


def test_machine_scores_every_pair_of_distinct_terms():
    rng = np.random.default_rng(2)
    vocabulary = "red green blue dark light".split()
    buf, off = blocks([" ".join(vocabulary)])
    hashes = np.sort(toxicity_fm.terms(buf, off)[0])
    m = toxicity_fm.Machine(-0.5, hashes, rng.normal(size=5).astype(np.float32),
                            rng.normal(size=(5, 8)).astype(np.float32))
    texts = ["Red red GREEN, dark!", "", "other", "blue light red dark green"]
    buf, off = blocks(texts)
    for text, got in zip(texts, m.scores(buf, off), strict=True):
        b, o = blocks([text])
        at = sorted({int(np.flatnonzero(hashes == h)[0]) for h in toxicity_fm.terms(b, o)[0]
                     if h in hashes})
        total = m.bias + sum(float(m.weights[i]) for i in at) + sum(
            float(m.factors[i].astype(float) @ m.factors[j]) for i in at for j in at if i < j)
        assert math.isclose(got, 1 / (1 + math.exp(-total)), rel_tol=1e-6)


def test_machine_learns_an_interaction():
    """Two words are harmless alone and toxic together."""
    rng = np.random.default_rng(4)
    words = tk.mix(np.arange(40, dtype=tk.U64))
    examples = []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rest = rng.choice(np.arange(2, 40), 6, replace=False)
        at = np.r_[rest, [0] * int(a), [1] * int(b)].astype(int)
        examples.append((float(a and b), np.sort(words[at])))
    m = toxicity_fm.fit(examples)
    at = {int(h): i for i, h in enumerate(m.terms)}
    i, j = at[int(words[0])], at[int(words[1])]
    assert float(m.factors[i] @ m.factors[j]) > 1
