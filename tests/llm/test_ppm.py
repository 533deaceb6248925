import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from tidemark.llm import catalog, ppm

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").encode().translate(LOWER)


def model(texts, order):
    """context -> symbol -> count, for all contexts of 0 to ``order`` bytes."""
    counts = defaultdict(Counter)
    for t in texts:
        line = bytes([ppm.PAD]) * order + lower(t) + bytes([ppm.END])
        for i in range(order, len(line)):
            for k in range(order + 1):
                counts[line[i - k:i]][line[i]] += 1
    return counts


def symbol_probability(counts, context, symbol):
    excluded, p = set(), 1.0
    for k in range(len(context), -1, -1):
        seen = counts.get(context[len(context) - k:])
        if not seen:
            continue
        rest = {s: n for s, n in seen.items() if s not in excluded}
        total = sum(rest.values())
        if symbol in rest:
            return p * (rest[symbol] - 0.5) / total
        if total:
            p *= 0.5 * len(rest) / total
        excluded |= seen.keys()
    return p / (ppm.SYMBOLS - len(excluded))


def brute_score(counts, text, order):
    line = bytes([ppm.PAD]) * order + lower(text) + bytes([ppm.END])
    return sum(math.log10(symbol_probability(counts, line[i - order:i], line[i]))
               for i in range(order, len(line)))


def brute_base(training, texts):
    c = Counter()
    for t in training:
        c.update(WORD.findall(lower(t)))
    c["end"] = len(training)
    c = +c
    n, v = sum(c.values()), len(c)
    out = []
    for t in texts:
        tokens = [*WORD.findall(lower(t)), "end"]
        out.append((len(tokens), sum(c[w] > 0 for w in tokens), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def compare(rows, got, order=ppm.ORDER):
    """rows: (id, text, learn); got: result rows."""
    training = [t for _, t, learn in rows if learn]
    counts = model(training, order)
    want = sorted(((k, *b, brute_score(counts, t, order)) for (k, t, _), b in
                   zip(rows, brute_base(training, [t for _, t, _ in rows]), strict=True)), key=str)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                   for r in got), key=str)
    assert len(want) == len(have)
    for a, b in zip(want, have, strict=True):
        assert a[:4] == b[:4]
        assert math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-9)


def test_against_brute_force_over_several_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 40")
    monkeypatch.setattr(ppm, "BLOCK_TEXT", 20_000)
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2)
            for r in docs.collect()]
    out = ppm.score_held_out(docs).collect()
    compare(rows, out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in out)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text, r.doc_id is None or r.doc_id % 3 != 0) for r in odd_docs.collect()]
    learn = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    compare(rows, ppm.score(odd_docs, learn).collect())
    compare([(a, b, False) for a, b, _ in rows], ppm.score(odd_docs, F.lit(False)).collect())
    assert ppm.score(no_docs, F.lit(True)).count() == 0


@pytest.mark.parametrize("context", [b"\xfe" * 5, b"fe at", b"zzzzz", b"e the"])
def test_probabilities_sum_to_one(small_texts, context):
    counts = model(list(small_texts.values())[:20], 5)
    total = sum(symbol_probability(counts, context, s) for s in range(256))
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_query_beats_the_unigram_base_on_held_out_text(spark):
    out = catalog.op1_ppm_score(spark, "/root/testdata/sf0.1").filter("held_out").agg(
        F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert out.score > 0.99 * out.base
