import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SMALL
from tidemark.llm import bpe, catalog

DATA = open(catalog.RANKS, "rb").read()
VOCAB = bpe.vocabulary(DATA, P.PATTERN)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, DATA.splitlines())}
PUBLIC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab estion\n\t!é漢1'"), max_size=60), max_size=20))
def test_same_ids_as_the_public_library(texts):
    for text, ids in zip(texts, bpe.encode_texts(texts, VOCAB), strict=True):
        assert ids.tolist() == PUBLIC.encode_ordinary(text)
        assert bpe.decode_ids(ids, VOCAB) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 2000, " " * 3000, "!" * 999, "-=" * 700,
                                  "aaaaaaab" * 50, "的" * 400, "\x00", "<|endoftext|>"])
def test_long_and_repetitive_pieces(text):
    (ids,) = bpe.encode_texts([text], VOCAB)
    assert ids.tolist() == PUBLIC.encode_ordinary(text)


def test_small_replay_blocks_change_nothing(monkeypatch, small_texts):
    import pyarrow as pa

    texts = list(small_texts.values())[:40]
    monkeypatch.setattr(bpe, "REPLAY_BYTES", 1)
    batches = pa.table({"text": texts}).to_batches(max_chunksize=7)
    got = [x.tolist() for _, ids in bpe.encoded_batches(batches, VOCAB) for x in ids]
    assert got == [PUBLIC.encode_ordinary(t) for t in texts]


def test_query_against_the_public_library(spark, small_texts):
    got = {r.doc_id: r for r in catalog.op7_byte_bpe(spark, SMALL).collect()}
    assert got.keys() == small_texts.keys()
    for k, text in small_texts.items():
        ids = PUBLIC.encode_ordinary(text or "")
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows_round_trip(odd_docs, no_docs):
    enc = bpe.encode(odd_docs, catalog.RANKS, P.PATTERN)
    assert enc.columns.count("token_ids") == 1 and set(enc.columns) == set(odd_docs.columns)
    out = bpe.decode(enc, catalog.RANKS, P.PATTERN).collect()
    assert len(out) == odd_docs.count()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in out)
    assert bpe.round_trip_digests(no_docs, catalog.RANKS, P.PATTERN).count() == 0


def test_unknown_id_raises():
    with pytest.raises(ValueError):
        bpe.decode_ids(np.array([50256]), VOCAB)
