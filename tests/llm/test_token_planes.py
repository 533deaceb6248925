import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import SMALL
from tidemark.llm import catalog, textkit, token_planes, units
from tidemark.session import scratch_path

DEFINITION = open(catalog.BYTE_LEVEL, "rb").read()
MODEL = open(P.path("piece_bpe_32k.model"), "rb").read()
PUBLIC = Tokenizer.from_file(catalog.BYTE_LEVEL)
PIECES = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ODD = ["", " ", "  ", "\n", " \n x", "a　 b", "a 　b", "　 \n", "é à", "x  y   z\t\tq\n\n\nr",
       "foo ", "it's 's 're\n's", "’ x “ y", "a<|endoftext|> b<|endoftext|>\n", "a\x00 b\x1c c",
       "<s> </s> <unk> <0x0A>", "a▁b ▁ x", "a\u0085 b", "的 漢字 。 x", "a" * 3000, " " * 300]


def coded(encoder, texts):
    out = []
    for lo, hi, buf, off in textkit.text_blocks(pa.array(texts, pa.string()), 64):
        ids, bounds = encoder(buf, off)
        out += [ids[bounds[i]:bounds[i + 1]].tolist() for i in range(hi - lo)]
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab's \n\t!é漢1’　\u0085▁<"), max_size=40), max_size=12))
def test_units_equal_whole_texts(texts):
    texts = texts + ODD
    assert coded(units.byte_level(DEFINITION), texts) == [
        PUBLIC.encode(t, add_special_tokens=False).ids for t in texts]
    spaced = coded(units.pieces(MODEL), [" " + t for t in texts])
    assert [x for x, t in zip(spaced, texts, strict=True) if t] == [
        PIECES.encode(t) for t in texts if t]


def test_equal_hashes_are_no_equal_units(monkeypatch):
    monkeypatch.setattr(textkit, "hash_spans", lambda b, s, e: np.zeros(len(s), np.uint64))
    assert coded(units.byte_level(DEFINITION), ["one two", "six ten"]) == [
        PUBLIC.encode(t).ids for t in ("one two", "six ten")]


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 9, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, np.uint32)
    for x in (ids, ids % 50257, ids * 0):
        planes = token_planes.split_planes(x, kind)
        assert len(planes) == (4 if kind == "byte" else 32)
        assert (token_planes.join_planes(planes, n, kind) == x).all()


def expected(rows):
    """Rows (id, text) in the order of the files."""
    start, out = 0, []
    for key, text in rows:
        ids = [*PUBLIC.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    return out


def test_query_against_the_public_library(spark, small_texts):
    out = catalog.op11_token_planes(spark, SMALL)
    got = sorted(tuple(r) for r in out.select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(sorted(small_texts.items()))


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_files_with_small_chunks_and_random_access(spark, small_texts, planes):
    path = scratch_path(spark, "planes")
    docs = spark.createDataFrame(sorted(small_texts.items())[:90], "doc_id long, text string")
    index = token_planes.write(docs, path, catalog.BYTE_LEVEL, 2, planes=planes, chunk_ids=100)
    want = {k: [*PUBLIC.encode(t or "").ids, 2] for k, t in sorted(small_texts.items())[:90]}
    got = {r.doc_id: r for r in token_planes.read(spark, path).collect()}
    assert {k: r.token_ids for k, r in got.items()} == want
    flat = sum((want[k] for k in sorted(want)), [])
    for shard in index.collect():
        found = token_planes.read_ids(f"{path}/ids/{shard.file}", 150, 333)
        assert found.tolist() == flat[shard.start + 150:shard.start + min(483, shard.n_ids)]


def test_odd_rows(spark, odd_docs, no_docs):
    path = scratch_path(spark, "planes")
    token_planes.write(odd_docs, path, catalog.BYTE_LEVEL, 2)
    rows = token_planes.read_digests(spark, path).collect()
    given_ = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    want = expected([(None if none else key, text) for none, key, text in given_])
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    empty = scratch_path(spark, "planes")
    token_planes.write(no_docs, empty, catalog.BYTE_LEVEL, 2)
    assert token_planes.read_digests(spark, empty).count() == 0


def test_hot_row_is_spread_and_foreign_files_are_no_part(spark):
    path = scratch_path(spark, "planes")
    docs = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("the same row").alias("text"))
    token_planes.write(docs.repartition(4), path, catalog.BYTE_LEVEL, 2)
    index = token_planes.shards(spark, path).collect()
    assert sum(r.n_docs for r in index) == 4000
    starts = [r.start for r in token_planes.read_digests(spark, path).collect()]
    assert sorted(starts) == [4 * k for k in range(4000)]
    with pytest.raises(ValueError):
        token_planes.PlaneFile(__file__)
