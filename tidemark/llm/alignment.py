"""Alignment of two tokenizers by sparse token-byte incidence matrices.

For a block of texts, matrix A has a row per token of the first tokenizer, B one per token of
the second; the columns are the bytes of the block.  Both are kept in hand-built CSR (row
bounds, columns, values).  Gustavson's row product A·Bᵀ has an entry for each pair of tokens
that share bytes, valued with the number of bytes: the *links*.  Byte offsets where tokens of
both sides end cut the tokens into groups; with token-group incidences G the product
G_A·G_Bᵀ has an entry for each pair in one group: the *shared-group links*.  A group of
unalignable text may hold all tokens of a text, so these are counted by a product with a
vector of ones, and put out (``shared_group``) in slices of rows of bounded size.

Corpus-wide counts of linked id pairs come from blocks of documents: a task numbers the
distinct pairs of a block and keeps each document's links as those numbers; the distinct
pairs are summed over all blocks by Spark, joined back to the blocks that have them, and each
block's documents are then streamed past its own table.  No task or broadcast holds the pairs
of the corpus; what is broadcast has one row per id of the second vocabulary.

Defined cases: texts that are null, empty, or whose tokens' bytes differ from the text with a
space in front have no tokens (zeros, an empty digest); rows are independent, so repeated
rows, ids and null ids each give a row and count each; an empty table gives no rows; columns
other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from . import units
from .scratch import staged
from .units import spread

#: Text of the documents whose distinct pairs are numbered together.
BLOCK_TEXT = 24 << 20
#: Numbered pairs in a row of a block's table.
PAIRS_A_ROW = 1 << 15
#: Entries that a slice of a product expands to at most (a row alone may have more).
SLICE = 1 << 22


# --- CSR -----------------------------------------------------------------------

@dataclass
class Csr:
    """Sparse matrix: the entries of row i are ``cols``, ``vals`` from bounds[i] to
    bounds[i + 1]."""

    bounds: np.ndarray
    cols: np.ndarray
    vals: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.bounds) - 1

    def row_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.bounds))

    def transposed(self) -> Csr:
        rows = self.row_of_entries()
        if len(self.cols) > 1 and (self.cols[1:] < self.cols[:-1]).any():
            order = np.argsort(self.cols, kind="stable")
            cols, rows, vals = self.cols[order], rows[order], self.vals[order]
        else:
            cols, vals = self.cols, self.vals
        bounds = np.searchsorted(cols, np.arange(self.width + 1))
        return Csr(bounds, rows, vals, self.height)

    def times_vector(self, x: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(self.vals * x[self.cols])]
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def _product_rows(a: Csr, b: Csr, lo: int, hi: int) -> Csr:
    """Rows ``lo`` to ``hi`` of a·b: each entry (i, k) of a brings row k of b, scaled, and
    entries of one row and column are added."""
    first, last = int(a.bounds[lo]), int(a.bounds[hi])
    cols = a.cols[first:last]
    sizes = b.bounds[cols + 1] - b.bounds[cols]
    at = spread(b.bounds[cols], sizes)
    rows = np.repeat(np.repeat(np.arange(hi - lo), np.diff(a.bounds[lo:hi + 1])), sizes)
    key = rows * b.width + b.cols[at]
    vals = np.repeat(a.vals[first:last], sizes) * b.vals[at]
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, vals = key[order], vals[order]
    lead = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    summed = np.add.reduceat(vals, lead) if len(lead) else vals
    row = key[lead] // b.width if len(lead) else key
    return Csr(np.searchsorted(row, np.arange(hi - lo + 1)), key[lead] % max(1, b.width),
               summed, b.width)


def row_products(a: Csr, b: Csr) -> Iterator[tuple[int, Csr]]:
    """The product a·b by Gustavson's method: (first row, slice of rows), each slice made
    from at most ``SLICE`` products, or from one row."""
    work = np.r_[0, np.cumsum(b.bounds[a.cols + 1] - b.bounds[a.cols])][a.bounds]
    lo = 0
    while lo < a.height:
        hi = int(np.searchsorted(work, work[lo] + SLICE, "right")) - 1
        hi = min(max(hi, lo + 1), a.height)
        yield lo, _product_rows(a, b, lo, hi)
        lo = hi


def token_bytes(ends: np.ndarray, n_bytes: int) -> Csr:
    """Incidence of tokens, which tile the bytes, and bytes."""
    return Csr(np.r_[0, ends], np.arange(n_bytes), np.ones(n_bytes, np.int64), n_bytes)


def token_groups(group: np.ndarray, n_groups: int) -> Csr:
    n = len(group)
    return Csr(np.arange(n + 1), group, np.ones(n, np.int64), n_groups)


# --- a block of texts ------------------------------------------------------------

class Side:
    """One tokenizer: encoder, and the bytes and printed ids of its vocabulary."""

    def __init__(self, encode: units.UnitEncoder, tokens: list[bytes], last: bytes):
        self.encode, self.size = encode, len(tokens)
        self.length = np.fromiter(map(len, tokens), np.int64, self.size)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        shown = [b"%d," % i for i in range(self.size)] + [b"%d%s" % (i, last)
                                                         for i in range(self.size)]
        self.shown_length = np.fromiter(map(len, shown), np.int64, len(shown))
        self.shown = b"".join(shown)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.start[ids], self.length[ids])]


@lru_cache(maxsize=2)
def sides(definition: bytes, model: bytes) -> tuple[Side, Side]:
    """The byte-level and the piece tokenizer, both without special tokens."""
    return (Side(units.byte_level(definition, True), units.token_bytes_byte_level(definition),
                 b"|"),
            Side(units.pieces(model), units.token_bytes_pieces(model), b";"))


@dataclass
class Aligned:
    """Tokens of a block's rows.  ``bounds_a`` and ``bounds_b`` are each row's tokens,
    ``bounds_groups`` its groups, ``bounds_links`` its links; ``group_a``, ``group_b`` the
    group of each token; a link joins tokens ``link_a``, ``link_b``, sharing ``overlap``."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    bounds_a: np.ndarray
    bounds_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    bounds_groups: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    overlap: np.ndarray
    bounds_links: np.ndarray

    def shared_group(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(token of A, token of B) of one group each, in bounded slices."""
        n = int(self.bounds_groups[-1])
        other = token_groups(self.group_b, n).transposed()
        for first, part in row_products(token_groups(self.group_a, n), other):
            yield part.row_of_entries() + first, part.cols

    def shared_group_counts(self) -> np.ndarray:
        """Number of shared-group links of each row: G_A·(G_Bᵀ·1), summed by row."""
        n = int(self.bounds_groups[-1])
        in_group = token_groups(self.group_b, n).transposed().times_vector(
            np.ones(len(self.group_b), np.int64))
        total = np.r_[0, np.cumsum(token_groups(self.group_a, n).times_vector(in_group))]
        return np.diff(total[self.bounds_a])


def _kept(ids: np.ndarray, bounds: np.ndarray, keep: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds with the rows outside ``keep`` emptied."""
    sizes = np.diff(bounds)
    return ids[np.repeat(keep, sizes)], np.r_[0, np.cumsum(np.where(keep, sizes, 0))]


def align_block(buf: np.ndarray, off: np.ndarray, a: Side, b: Side) -> Aligned:
    """Align the rows of a block; every row has its space in front already, or is empty."""
    coded = [side.encode(buf, off) for side in (a, b)]
    keep = np.ones(len(off) - 1, bool)
    for side, (ids, bounds) in zip((a, b), coded, strict=True):
        total = np.r_[0, np.cumsum(side.length[ids])]
        keep &= total[bounds[1:]] - total[bounds[:-1]] == np.diff(off)
    if not keep.all():
        coded = [_kept(ids, bounds, keep) for ids, bounds in coded]
        buf, off = _kept(buf, off, keep)
    for side, (ids, _) in zip((a, b), coded, strict=True):
        same = side.bytes_of(ids) == buf
        if not same.all():
            keep[tk.rows_of(np.flatnonzero(~same), off)] = False
    if len(buf) and not keep[np.diff(off) > 0].all():
        coded = [_kept(ids, bounds, keep) for ids, bounds in coded]
        buf, off = _kept(buf, off, keep)
    (ids_a, bounds_a), (ids_b, bounds_b) = coded
    ends_a, ends_b = np.cumsum(a.length[ids_a]), np.cumsum(b.length[ids_b])
    both = np.zeros(len(buf) + 1, np.int8)
    both[ends_a] += 1
    both[ends_b] += 1
    cuts = np.flatnonzero(both == 2)
    link_a, link_b, overlap = [], [], []
    by_byte = token_bytes(ends_b, len(buf)).transposed()
    for first, part in row_products(token_bytes(ends_a, len(buf)), by_byte):
        link_a.append(part.row_of_entries() + first)
        link_b.append(part.cols)
        overlap.append(part.vals)
    none = np.zeros(0, np.int64)
    link_a = np.concatenate([none, *link_a])
    return Aligned(ids_a, ids_b, bounds_a, bounds_b, np.searchsorted(cuts, ends_a),
                   np.searchsorted(cuts, ends_b), np.searchsorted(cuts, off, "right"), link_a,
                   np.concatenate([none, *link_b]), np.concatenate([none, *overlap]),
                   np.searchsorted(link_a, bounds_a))


def group_digests(x: Aligned, a: Side, b: Side) -> list[str]:
    """SHA-256 of each row's groups as text ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    n_a, n_b = len(x.ids_a), len(x.ids_b)
    n = int(x.bounds_groups[-1])
    before_a = np.searchsorted(x.group_a, np.arange(n + 1))    # tokens of earlier groups
    before_b = np.searchsorted(x.group_b, np.arange(n + 1))
    entry = np.empty(n_a + n_b, np.int64)
    last = np.zeros(n_a, bool)
    last[before_a[1:] - 1] = True
    entry[np.arange(n_a) + before_b[x.group_a]] = x.ids_a + last * a.size
    last = np.zeros(n_b, bool)
    last[before_b[1:] - 1] = True
    entry[np.arange(n_b) + before_a[x.group_b + 1]] = 2 * a.size + x.ids_b + last * b.size
    length = np.concatenate([a.shown_length, b.shown_length])
    start = np.cumsum(length) - length
    text = np.frombuffer(a.shown + b.shown, np.uint8)[
        spread(start[entry], length[entry])].tobytes()
    ends = np.r_[0, np.cumsum(length[entry])][x.bounds_a + x.bounds_b].tolist()
    return [hashlib.sha256(text[lo:hi - 1]).hexdigest() if hi > lo else ""
            for lo, hi in zip(ends[:-1], ends[1:], strict=True)]


def spaced(col: pa.Array) -> pa.Array:
    """Texts with the space in front; null and empty ones stay empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    none, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    return pc.if_else(pc.equal(pc.binary_length(col), 0), none,
                      pc.binary_join_element_wise(space, col, none))


# --- Spark ---------------------------------------------------------------------

def _shared(docs: DataFrame, definition_path: str, model_path: str):
    """Both vocabulary files (fixed size), read once and sent to the executors."""
    with open(definition_path, "rb") as f, open(model_path, "rb") as g:
        return docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))


def links(docs: DataFrame, definition_path: str, model_path: str, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Per row the tokens and links of the text: ``a_ids``, ``b_ids``, their groups
    ``a_group``, ``b_group``, and for every link the positions ``link_a``, ``link_b`` of its
    tokens and the number ``overlap`` of bytes they share."""
    tk.small_batches(docs.sparkSession)
    shared = _shared(docs, definition_path, model_path)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    names = ["a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b", "overlap"]
    schema = T.StructType([rows.schema["doc_id"], *(
        T.StructField(c, T.ArrayType(T.IntegerType(), False)) for c in names)])

    def run(batches):
        a, b = sides(*shared.value)
        for batch in batches:
            for lo, hi, buf, off in tk.text_blocks(spaced(batch.column("text"))):
                x = align_block(buf, off, a, b)

                def lists(values, bounds, base=None):
                    less = 0 if base is None else np.repeat(base[:-1], np.diff(bounds))
                    return pa.ListArray.from_arrays(
                        pa.array(bounds.astype(np.int32)),
                        pa.array((values - less).astype(np.int32)))

                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo),
                     lists(x.ids_a, x.bounds_a), lists(x.ids_b, x.bounds_b),
                     lists(x.group_a, x.bounds_a, x.bounds_groups),
                     lists(x.group_b, x.bounds_b, x.bounds_groups),
                     lists(x.link_a, x.bounds_links, x.bounds_a),
                     lists(x.link_b, x.bounds_links, x.bounds_b),
                     lists(x.overlap, x.bounds_links)], names=["doc_id", *names])

    return rows.mapInArrow(run, schema)


_DOC_COLUMNS = ("n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
                "groups_sha256 string, links binary")


class _Block:
    """Rows of one block: the documents, and their links as numbers of distinct pairs."""

    def __init__(self):
        self.size = 0
        self.docs: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []

    def add(self, keys: pa.Array, n_bytes: int, x: Aligned, a: Side, b: Side) -> None:
        pair = x.ids_a[x.link_a].astype(np.int64) * b.size + x.ids_b[x.link_b]
        distinct, number = np.unique(pair, return_inverse=True)
        self.pairs.append(distinct)
        self.numbers.append(number.astype(np.int32))
        self.docs.append((keys, x.bounds_links, [
            pa.array(np.diff(x.bounds_a)), pa.array(np.diff(x.bounds_b)),
            pa.array(np.diff(x.bounds_groups)), pa.array(np.diff(x.bounds_links)),
            pa.array(x.shared_group_counts().astype(np.int64)),
            pa.array(group_digests(x, a, b), pa.string())]))
        self.size += n_bytes

    def rows(self, block: int, schema: pa.Schema, pairs_a_row: int
             ) -> Iterator[pa.RecordBatch]:
        pairs = np.unique(np.concatenate(self.pairs))
        places = [np.searchsorted(pairs, p) for p in self.pairs]
        count = np.zeros(len(pairs), np.int64)
        for place, number in zip(places, self.numbers, strict=True):
            count += np.bincount(place[number], minlength=len(pairs))
        order = np.argsort(-count, kind="stable")    # low numbers for frequent pairs
        rank = np.empty(len(pairs), np.int64)
        rank[order] = np.arange(len(pairs))
        pack = zstandard.ZstdCompressor(level=1).compress

        def batch(kind: int, n: int, columns: dict) -> pa.RecordBatch:
            columns = {"block": pa.array(np.full(n, block)), "kind": pa.array(
                np.full(n, kind, np.int8)), **columns}
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else pa.nulls(n, f.type)
                 for f in schema], schema=schema)

        for at in range(0, len(pairs), pairs_a_row):
            part = order[at:at + pairs_a_row]
            yield batch(_PAIRS, 1, {"first": pa.array([at]), "pairs": pa.array([pairs[part]]),
                                    "counts": pa.array([count[part]])})
        for (keys, bounds, made), place, number in zip(self.docs, places, self.numbers,
                                                       strict=True):
            links_ = rank[place[number]].astype("<u4")
            packed = pa.array([pack(links_[lo:hi].tobytes()) for lo, hi in
                               zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)],
                              pa.binary())
            names = [c.split()[0] for c in _DOC_COLUMNS.split(", ")]
            yield batch(_DOCS, len(keys), {"doc_id": keys, **dict(zip(names, [*made, packed],
                                                                     strict=True))})


_PAIRS, _DOCS = 0, 1


def _blocks(shared, schema: pa.Schema, block_text: int, pairs_a_row: int):
    """``mapInArrow`` function: documents aligned, links numbered by block."""
    def run(batches):
        a, b = sides(*shared.value)
        block, made = _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, buf, off in tk.text_blocks(spaced(batch.column("text"))):
                block.add(batch.column("doc_id").slice(lo, hi - lo), len(buf),
                          align_block(buf, off, a, b), a, b)
                if block.size >= block_text:
                    yield from block.rows(made, schema, pairs_a_row)
                    block, made = _Block(), made + 1
        if block.docs:
            yield from block.rows(made, schema, pairs_a_row)
    return run


def _counted(key_type: pa.DataType):
    """``mapInArrow`` function over rows sorted by block and kind: the (number, count, best)
    rows of a block's pairs, then its documents, whose links are looked up in them."""
    sums = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches):
        block, parts, table = None, [], None
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            place = np.asarray(batch.column("block")) * 2 + np.asarray(batch.column("kind"))
            cuts = np.r_[0, np.flatnonzero(place[1:] != place[:-1]) + 1, len(place)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                now, kind = divmod(int(place[lo]), 2)
                if now != block:
                    block, parts, table = now, [], None
                if kind == _PAIRS:
                    parts.append([np.asarray(part.column(c)) for c in ("number", "count")]
                                 + [part.column("best").to_numpy(zero_copy_only=False)])
                    continue
                if table is None:
                    number, count, best = (np.concatenate(c) for c in zip(*parts, strict=True)) \
                        if parts else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool))
                    table = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
                    table[0][number], table[1][number] = count, best
                    parts = []
                found = [np.frombuffer(unpack(x), "<u4") for x in
                         part.column("links").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(key_type), *(part.column(c) for c in sums),
                     pa.array([int(table[1][x].sum()) for x in found], pa.int64()),
                     pa.array([int(table[0][x].sum()) for x in found], pa.int64()),
                     part.column("groups_sha256"), part.column("n_group_links")],
                    names=["doc_id", *sums, "n_best", "count_sum", "groups_sha256",
                           "n_group_links"])
    return run


def align(docs: DataFrame, definition_path: str, model_path: str, key: str = "doc_id",
          text: str = "text", block_text: int = BLOCK_TEXT, pairs_a_row: int = PAIRS_A_ROW
          ) -> DataFrame:
    """Per row: ``n_a``, ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair is the commonest of its B id in the corpus, ties included), ``count_sum`` (corpus
    counts of the links' pairs, summed), ``groups_sha256``, ``n_group_links``."""
    spark = docs.sparkSession
    tk.small_batches(spark)
    shared = _shared(docs, definition_path, model_path)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    ddl = (f"block long, kind byte, doc_id {id_type.simpleString()}, {_DOC_COLUMNS}, "
           "first long, pairs array<long>, counts array<long>")
    arrow = tk.arrow_schema(ddl)
    aligned = staged(rows.mapInArrow(_blocks(shared, arrow, block_text, pairs_a_row), ddl), "alignment-blocks")
    tables = (aligned.filter(F.col("kind") == _PAIRS)
              .select("block", "first", F.posexplode(F.arrays_zip("pairs", "counts")))
              .select("block", (F.col("first") + F.col("pos")).alias("number"),
                      F.col("col.pairs").alias("pair"), F.col("col.counts").alias("n")))
    total = staged(tables.groupBy("pair").agg(F.sum("n").alias("count")), "alignment-counts")
    size_b = len(units.token_bytes_pieces(shared.value[1]))
    by_b = (F.col("pair") % size_b).cast("int").alias("b")
    highest = total.groupBy(by_b).agg(F.max("count").alias("top"))    # a row per id of B
    judged = total.withColumn("b", by_b).join(F.broadcast(highest), "b").select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = tables.select("block", "number", "pair").join(judged, "pair").select(
        "block", F.lit(_PAIRS).cast("byte").alias("kind"), "number", "count", "best")
    lined_up = answers.unionByName(
        aligned.filter(F.col("kind") == _DOCS).drop("first", "pairs", "counts"),
        allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    return lined_up.mapInArrow(
        _counted(tk.arrow_type(rows, "doc_id")),
        f"doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
        "n_best long, count_sum long, groups_sha256 string, n_group_links long")


def pair_counts(docs: DataFrame, definition_path: str, model_path: str, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Corpus-wide ``count`` of the links of every id pair (``a_id``, ``b_id``)."""
    found = links(docs, definition_path, model_path, key, text)
    pairs = found.select(F.explode(F.arrays_zip("link_a", "link_b")).alias("l"), "a_ids", "b_ids")
    return (pairs.groupBy(F.get("a_ids", F.col("l.link_a")).alias("a_id"),
                          F.get("b_ids", F.col("l.link_b")).alias("b_id"))
            .agg(F.count("*").alias("count")))
