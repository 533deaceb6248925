import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from tidemark.llm import catalog, collocations, textkit, transducer


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def brute(rows, least=10, longest=3, share=50, top=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score) from counters of tuples of words."""
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    count[lang, tuple(words[i:i + m])] += 1
    cands = {k: a for k, a in count.items() if a >= least and len(k[1]) >= 2}
    over = defaultdict(int)
    for (lang, p), a in cands.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                over[lang, p[i:i + m]] = max(over[lang, p[i:i + m]], a)
    found = defaultdict(list)
    for (lang, p), a in cands.items():
        if 100 * over[lang, p] >= share * a:
            continue
        cuts = [(10**6 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k)
                for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), count[lang, p[:k]],
                            count[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, l_, r, n[lang], -s)
                  for lang, rows in found.items()
                  for rank, (s, a, p, l_, r) in enumerate(sorted(rows)[:top], 1))


def got(df):
    return sorted(tuple(r) for r in df.select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_against_brute_force(spark):
    rows = [(r.lang, r.text) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(rows)
    assert len(want) > 100 and got(catalog.op12_phrase_transducers(spark, SMALL)) == want


def test_shards_ranges_and_longer_phrases_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    rows = [(r.lang, r.text) for r in docs.collect()]
    for kind in ({"ranges": 1}, {"ranges": 23, "shard_text": 1}):
        out = collocations.find(docs, least=3, longest=4, share=70, top=150, **kind)
        assert got(out) == brute(rows, 3, 4, 70, 150)


def test_odd_rows_and_hot_words(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert got(collocations.find(odd_docs, least=2)) == brute(rows, 2)
    assert collocations.find(no_docs).count() == 0
    assert collocations.find(odd_docs.filter("doc_id in (3, 4, 5)")).count() == 0
    texts = [(None, "hot hot hot A\x01b c.d\tE"), ("und", "Hot hot, x hot hot hot! É é É é"),
             ("", "a b a b a b"), ("zz", "hot " * 500)] * 30
    docs = spark.createDataFrame(texts, "lang string, text string")
    assert got(collocations.find(docs, ranges=9)) == brute(texts)
    assert got(collocations.find(docs.withColumn("n", F.lit("x")), top=3)) == brute(texts, top=3)


SEQS = st.dictionaries(st.tuples(st.sampled_from([b"", b"de", b"en"]), *[
    st.sampled_from([b"", b"a", b"ab", b"b", b"\xc3\xa9"])] * 3), st.integers(1, 3), max_size=25)


def as_trie(found):
    """Trie of {(head, word, ...): weight}; an empty word ends the sequence."""
    keys = [(k[0], *[w for i, w in enumerate(k[1:], 1) if b"" not in k[1:i + 1]]) for k in found]
    heads, head = transducer.sorted_symbols(pa.array([k[0] for k in keys], pa.large_binary()))
    words, _ = transducer.sorted_symbols(pa.array([w for k in keys for w in k[1:]],
                                                  pa.large_binary()))
    place = {w: i for i, w in enumerate(words.to_pylist())}
    columns = [head] + [np.array([place[k[i]] if len(k) > i else 0 for k in keys], np.int64)
                        for i in (1, 2, 3)]
    weight = np.array(list(found.values()), np.int64)
    trie, _ = transducer.sequences(columns, np.array([len(k) for k in keys], np.int64), weight,
                                   heads, words)
    want = Counter()
    for k, w in zip(keys, weight.tolist(), strict=True):
        want[k] += w
    return trie, want


def as_dict(trie):
    out = {}
    for k, level in enumerate(trie.levels):
        path = trie.path(k, np.arange(len(level.label)))
        for i, w in enumerate(level.weight.tolist()):
            if w:
                out[tuple(trie.symbols(j)[int(p[i])].as_py() for j, p in enumerate(path))] = w
    return out


@settings(max_examples=80, deadline=None)
@given(SEQS, SEQS, st.lists(st.lists(st.sampled_from([b"a", b"ab", b"b", b"c"]), max_size=3),
                            max_size=4))
def test_automata_against_dictionaries(one, two, cuts):
    (a, want_a), (b, want_b) = as_trie(one), as_trie(two)
    assert as_dict(a) == want_a
    packed = transducer.Automaton.load(transducer.Automaton.build(a).dump())
    assert as_dict(packed.expand()) == want_a
    assert as_dict(transducer.union([a, b])) == want_a + want_b
    assert as_dict(transducer.union([a, b], np.maximum)) == want_a | want_b
    assert as_dict(transducer.pruned(a, 2)) == {k: w for k, w in want_a.items() if w >= 2}
    found = transducer.compose(transducer.Automaton.build(a), transducer.Automaton.build(b))
    assert as_dict(found) == {k: w for k, w in want_b.items() if k in prefixes(want_a)}
    bounds = sorted({(h, *c) for h in (b"de", b"ef") for c in cuts})
    parts = {r: as_dict(t) for r, t in transducer.split(a, bounds)}
    assert Counter({k: w for t in parts.values() for k, w in t.items()}) == want_a
    assert all(sum(x <= k for x in bounds) == r for r, t in parts.items() for k in t)


def prefixes(keys):
    return {k[:i] for k in keys for i in range(1, len(k) + 1)}


def test_automaton_shares_equal_states(monkeypatch):
    trie, want = as_trie({(b"en", w, b"b", b"a"): 1 for w in (b"a", b"ab", b"b", b"\xc3\xa9")})
    automaton = transducer.Automaton.build(trie)
    assert [len(x) for x in automaton.label] == [1, 4, 1, 1]
    monkeypatch.setattr(textkit, "hash_sequences", lambda v, s, e: np.zeros(len(s), np.uint64))
    assert as_dict(transducer.Automaton.build(trie).expand()) == want
