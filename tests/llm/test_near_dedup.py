import random
import re
from itertools import pairwise

import numpy as np
import pytest

from tests.llm.conftest import SMALL, WORDS, prose
from tidemark.llm import catalog, near_dedup
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or {tuple(w)}


def brute(rows, width, percent=80):
    """(id, n, component, kept) of rows (id, text), by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = find(i)
        if k is not None and (least.get(r) is None or k < least[r]):
            least[r] = k
    return sorted(((k, len(s), least.get(find(i)), k == least.get(find(i)))
                   for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, small_texts):
    assert got(catalog.op6_odd_sketch_dedup(spark, SMALL)) == brute(list(small_texts.items()), 4)


@pytest.mark.parametrize("width", [4, 5])
def test_odd_rows(odd_docs, no_docs, width):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(near_dedup.find(odd_docs, width)) == brute(rows, width)
    assert near_dedup.find(no_docs, width).count() == 0


@pytest.mark.parametrize("chunk", [2 << 20, 1000])
def test_large_groups_around_the_threshold(spark, monkeypatch, chunk):
    """Chains and clouds of near copies whose similarities straddle 80 %, and pairs that
    share long passages only: every link between different texts counts."""
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", chunk)
    r = random.Random(11)
    rows = []
    for g in range(6):
        base = prose(100 + g, 120).split()
        for _ in range(40):
            words = list(base)
            for _ in range(r.randint(0, 5)):
                words[r.randrange(len(words))] = r.choice(WORDS)
            rows.append((len(rows) * 3 % 1009, " ".join(words)))
    chain = prose(7, 100).split()
    for i in range(30):
        chain[(7 * i) % 100] = f"link{i}"
        rows.append((2000 - i, " ".join(chain)))
    shared = prose(8, 60)
    rows += [(3000 + i, f"{shared} {prose(500 + i, r.randint(5, 60))}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(near_dedup.find(docs, 4)) == brute(rows, 4)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(5)
    for true in (0.95, 0.8, 0.6):
        found = []
        for _ in range(100):
            u = rng.integers(0, 2**64 - 1, 400, dtype=np.uint64)
            c = int(true * 400)
            half = (400 - c) // 2
            x, y = (near_dedup.odd_sketch(near_dedup.min_hashes(s))
                    for s in (u[:c + half], np.r_[u[:c], u[c + half:]]))
            found.append(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert abs(near_dedup.similarity_estimate(np.array(found)).mean() - true) < 0.02


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, j) for i, j in pairwise(range(100, 160))]
    star = [(7, i) for i in range(200, 260)]
    links = spark.createDataFrame([*chain, *star, (3, 3)], "a long, b long")
    out = {r.node: r.component for r in components(links).collect()}
    assert out == {i: 100 for i in range(100, 160)} | {i: 7 for i in [7, *range(200, 260)]}
