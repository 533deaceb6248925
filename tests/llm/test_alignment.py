import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import SMALL
from tests.llm.test_token_planes import ODD
from tidemark.llm import alignment, catalog, textkit, units

DEFINITION = open(catalog.BYTE_LEVEL, "rb").read()
MODEL = open(catalog.PIECES, "rb").read()
A = Tokenizer.from_file(catalog.BYTE_LEVEL)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
BYTES_A, BYTES_B = units.token_bytes_byte_level(DEFINITION), units.token_bytes_pieces(MODEL)


def brute(text):
    """(a ids, b ids, groups, links, shared-group links) from the byte ranges."""
    if not text:
        return [], [], [], [], 0
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(BYTES_A[i] for i in a) != whole or b"".join(BYTES_B[i] for i in b) != whole:
        return [], [], [], [], 0
    ends_a = np.cumsum([len(BYTES_A[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(BYTES_B[i]) for i in b]).tolist()
    starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
    links = [(i, j) for i in range(len(a))
             for j in range(bisect_right(ends_b, starts_a[i]), bisect_left(starts_b, ends_a[i]))]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        to_i, to_j = bisect_right(ends_a, cut), bisect_right(ends_b, cut)
        groups.append((a[i:to_i], b[j:to_j]))
        i, j = to_i, to_j
    return a, b, groups, links, sum(len(x) * len(y) for x, y in groups)


def expected(rows):
    found = [(k, brute(t)) for k, t in rows]
    count = Counter((a[i], b[j]) for _, (a, b, _, links, _) in found for i, j in links)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for k, (a, b, groups, links, shared) in found:
        counts = [(count[a[i], b[j]], top[b[j]]) for i, j in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((k, len(a), len(b), len(groups), len(links), sum(n == t for n, t in counts),
                    sum(n for n, _ in counts),
                    hashlib.sha256(text.encode()).hexdigest() if groups else "", shared))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def aligned(docs, **kind):
    return alignment.align(docs, catalog.BYTE_LEVEL, catalog.PIECES, **kind)


def test_query_against_brute_force(spark, small_texts):
    assert got(catalog.op13_token_alignment(spark, SMALL)) == expected(small_texts.items())


def test_small_blocks_change_nothing(spark, small_texts):
    rows = sorted(small_texts.items())[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = got(aligned(docs))
    assert got(aligned(docs, block_text=1, pairs_a_row=7)) == want


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(aligned(odd_docs)) == expected(rows)
    assert aligned(no_docs).count() == 0
    texts = list(enumerate(ODD)) + [(90, "a▁b"), (91, "plain a"), (91, "plain a")]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    out = aligned(docs)
    assert out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert got(out) == expected(texts)


def test_links_and_pair_counts(spark):
    texts = [(1, "Hello tokenised world, été"), (2, None), (3, "a▁b"), (4, "Hello")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for r in alignment.links(docs, catalog.BYTE_LEVEL, catalog.PIECES).collect():
        a, b, groups, links, _ = brute(dict(texts)[r.doc_id])
        assert (r.a_ids, r.b_ids) == (a, b)
        assert list(zip(r.link_a, r.link_b, strict=True)) == links
        assert len(set(r.a_group)) == len(groups) and sum(r.overlap) == sum(
            len(BYTES_A[i]) for i in a)
    counts = alignment.pair_counts(docs, catalog.BYTE_LEVEL, catalog.PIECES).collect()
    want = Counter((a[i], b[j]) for a, b, _, links, _ in map(brute, dict(texts).values())
                   for i, j in links)
    assert {(r.a_id, r.b_id): r["count"] for r in counts} == want


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_row_products_equal_dense_products(data):
    n, m, k = (data.draw(st.integers(1, 6)) for _ in range(3))
    dense = lambda r, c: np.array(data.draw(st.lists(
        st.integers(0, 2), min_size=r * c, max_size=r * c))).reshape(r, c)
    a, b = dense(n, m), dense(k, m)

    def csr(x):
        rows, cols = np.nonzero(x)
        return alignment.Csr(np.searchsorted(rows, np.arange(len(x) + 1)), cols, x[rows, cols],
                             x.shape[1])

    out = np.zeros((n, k), int)
    for first, part in alignment.row_products(csr(a), csr(b).transposed()):
        out[part.row_of_entries() + first, part.cols] = part.vals
    assert (out == a @ b.T).all()
    assert (csr(a).times_vector(np.arange(m)) == a @ np.arange(m)).all()


def test_shared_group_links_in_slices(monkeypatch):
    a, b = alignment.sides(DEFINITION, MODEL)
    text = "Zażółć gęślą jaźń 漢字かな tokenised"
    (lo, hi, buf, off), = textkit.text_blocks(alignment.spaced(pa.array([text, None, "été"])))
    x = alignment.align_block(buf, off, a, b)
    want = [(i, j) for i, g in enumerate(x.group_a) for j, h in enumerate(x.group_b) if g == h]
    for size in (1, 5, 1 << 20):
        monkeypatch.setattr(alignment, "SLICE", size)
        found = [p for i, j in x.shared_group() for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert found == want
    assert x.shared_group_counts().tolist()[1] == 0 and x.shared_group_counts().sum() == len(want)
