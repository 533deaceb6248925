"""Prediction by partial matching: code length of texts under a byte-context model.

The model is the trie of all byte contexts up to ``ORDER`` bytes in the training texts,
held as tables: per context the counts of the symbols that follow it.  A symbol is coded in
the longest context that was seen; where it never followed there, an escape (method D: half a
count for each distinct symbol of the context, taken from that symbol's own count) leads
to the context one byte shorter, where the symbols just ruled out are excluded from the
counts; below the empty context all
symbols not yet excluded are equally likely.  A text is followed by an end symbol.

The code length of a symbol depends on itself and the ``ORDER`` bytes before it only.  So
texts are hashed to blocks of bounded size, each block lists its distinct byte n-grams,
their code lengths are worked out once over the whole corpus by joins, and each block gets
back the lengths of its own n-grams.  No task or broadcast holds the whole model, and what
is exchanged grows with the input.

Words travel the same way (by 64-bit hash) for the unigram baseline.

Defined cases: a null text is empty, an empty text is one end symbol; repeated rows and ids
are each scored (and each counted in training); a null id is training data; without
training data every symbol is equally likely; an empty table gives no rows.  Only id and
text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .labelled import id_remainder
from .scratch import staged, workspace

ORDER = 5
BLOCK_TEXT = 80 << 20
PAD, END = 0xFE, 0xFF  # bytes that UTF-8 never uses
SYMBOLS = 256

_GRAM, _WORD, _TEXT = 0, 1, 2
_MAX_ROWS = 1 << 15


def _pieces(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of lower-cased bytes of at most _MAX_ROWS rows."""
    for at in range(0, len(col), _MAX_ROWS):
        for lo, _, buf, off in tk.text_blocks(col.slice(at, _MAX_ROWS)):
            yield at + lo, tk.lower_ascii(buf), off


def grams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER bytes before each symbol and the symbol, packed, and the row of each."""
    n = len(off) - 1
    rows = np.repeat(np.arange(n), np.diff(off))
    line = np.full(len(buf) + n * (ORDER + 1), PAD, np.uint8)
    at = np.arange(len(buf)) + (rows + 1) * ORDER + rows
    line[at] = buf
    ends = off[1:] + (np.arange(n) + 1) * ORDER + np.arange(n)
    line[ends] = END
    packed = np.zeros(len(line), tk.U64)
    for back in range(ORDER, 0, -1):
        packed[back:] |= line[:len(line) - back].astype(tk.U64) << tk.U64(8 * back)
    packed |= line
    return np.concatenate([packed[at], packed[ends]]), np.concatenate([rows, np.arange(n)])


def _tally(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal keys."""
    order = np.argsort(keys, kind="stable")  # quick on the concatenation of sorted parts
    keys, counts = keys[order], counts[order]
    lead = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[lead], np.add.reduceat(counts, lead) if len(lead) else counts


class _Tally:
    """Distinct keys with summed counts; little more than the distinct keys is held."""

    def __init__(self):
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._held, self._settled = 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._parts.append(_tally(keys, counts))
        self._held += len(self._parts[-1][0])
        if self._held > 1.25 * self._settled + (1 << 19):
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if self._parts:
            self._parts = [_tally(*(np.concatenate(x) for x in
                                    zip(*self._parts, strict=True)))]
            self._held = self._settled = len(self._parts[0][0])
            return self._parts[0]
        return np.zeros(0, tk.U64), np.zeros(0, np.int64)


def _block_keys(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams and words of a block with their counts in its training texts."""
    block = key[0].as_py()
    tallies = (_Tally(), _Tally())
    for batch in batches:
        learn = np.asarray(batch.column("learn"), bool)
        for lo, buf, off in _pieces(batch.column("text")):
            train = learn[lo:lo + len(off) - 1].astype(np.int64)
            gram, rows = grams(buf, off)
            # one sort of (n-gram, training?) pairs instead of a sort with its permutation
            pair = np.sort(gram << tk.U64(1) | train[rows].astype(tk.U64))
            lead = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            times = np.diff(np.r_[lead, len(pair)])
            tallies[_GRAM].add(pair[lead] >> tk.U64(1),
                               times * (pair[lead] & tk.U64(1)).astype(np.int64))
            starts, ends = tk.words(buf, off)
            tallies[_WORD].add(tk.hash_spans(buf, starts, ends), train[tk.rows_of(starts, off)])
    for kind, tally in enumerate(tallies):
        keys, counts = tally.result()
        for lo in range(0, len(keys), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            n = len(keys[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block, np.int32)), pa.array(np.full(n, kind, np.int8)),
                 pa.array(keys[part].view(np.int64)), pa.array(counts[part])],
                names=["block", "kind", "key", "n"])


def _trie(seen: DataFrame, stage: Callable) -> list[DataFrame]:
    """Tables of the contexts of order 0 to ORDER from the counts of full n-grams.

    A row is (ctx, total, kinds, below, below_kinds, next): how often the context occurs,
    with how many symbols, the same two of the context one byte shorter after excluding
    this one's symbols, and its symbols' counts (at most 257)."""
    pairs = [None] * (ORDER + 1)
    pairs[ORDER] = seen.select(F.col("key").alias("pair"), "n")
    for k in range(ORDER - 1, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        pairs[k] = stage(pairs[k + 1].groupBy(F.col("pair").bitwiseAND(F.lit(mask)).alias("pair"))
                          .agg(F.sum("n").alias("n")), f"pairs{k}")
    tables: list[DataFrame] = []
    for k in range(ORDER + 1):
        symbol = F.struct(F.col("pair").bitwiseAND(F.lit(255)).alias("symbol"), "n")
        ctx = F.shiftright("pair", 8).alias("ctx")
        if k:
            mask = (1 << 8 * k) - 1
            shorter = pairs[k - 1].select(F.col("pair").alias("_pair"), F.col("n").alias("_n"))
            nodes = (pairs[k].join(shorter, F.col("pair").bitwiseAND(F.lit(mask)) == F.col("_pair"))
                     .groupBy(ctx).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"),
                                       F.sum("_n").alias("excluded"),
                                       F.map_from_entries(F.collect_list(symbol)).alias("next")))
            parent = tables[k - 1].select(F.col("ctx").alias("_ctx"),
                                          F.col("total").alias("_total"),
                                          F.col("kinds").alias("_kinds"))
            short = F.col("ctx").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            nodes = nodes.join(parent, short == F.col("_ctx")).select(
                "ctx", "total", "kinds", (F.col("_total") - F.col("excluded")).alias("below"),
                (F.col("_kinds") - F.col("kinds")).alias("below_kinds"), "next")
        else:
            nodes = pairs[0].groupBy(ctx).agg(
                F.sum("n").alias("total"), F.count("*").alias("kinds"),
                F.map_from_entries(F.collect_list(symbol)).alias("next")).select(
                "ctx", "total", "kinds", F.lit(0).cast("long").alias("below"),
                (F.lit(SYMBOLS) - F.col("kinds")).cast("long").alias("below_kinds"), "next")
        tables.append(stage(nodes, f"order{k}"))
    return tables


def code_lengths(counted: DataFrame) -> DataFrame:
    """(key, value): log10 probability of the last symbol of every n-gram after the bytes
    before it, from (key, n) with the n-grams' counts in the training texts."""
    with workspace(counted.sparkSession, "trie") as stage:
        seen = counted.filter("n > 0")
        tables = _trie(seen, stage)
        # n-grams of the training texts: their context is known and holds the symbol
        nodes = tables[ORDER].select("ctx", "total")
        done = [seen.join(nodes, F.shiftright("key", 8) == F.col("ctx")).select(
            "key", F.log10((F.col("n") - 0.5) / F.col("total")).alias("value"))]
        open_ = counted.filter("n = 0").select(
            "key", F.lit(0.0).alias("value"), F.lit(None).cast("long").alias("total"),
            F.lit(None).cast("long").alias("kinds"))
        for k in range(ORDER, -1, -1):
            mask = (1 << 8 * (k + 1)) - 1
            node = tables[k].select(F.col("ctx").alias("_ctx"), F.col("total").alias("_total"),
                                    F.col("kinds").alias("_kinds"), "below", "below_kinds", "next")
            ctx = F.shiftright(F.col("key").bitwiseAND(F.lit(mask)), 8)
            # counts left after what the longer context excluded, or all if that was unknown
            total, kinds = F.coalesce("total", "_total"), F.coalesce("kinds", "_kinds")
            n = F.try_element_at("next", F.col("key").bitwiseAND(F.lit(255)))
            step = (F.when(F.col("_ctx").isNull() | (total == 0), 0.0)
                    .when(n.isNotNull(), F.log10((n - 0.5) / total))
                    .otherwise(F.log10(0.5 * kinds / total)))
            walked = stage(open_.join(node, ctx == F.col("_ctx"), "left").select(
                "key", (F.col("value") + step).alias("value"), n.isNotNull().alias("found"),
                F.col("below").alias("total"), F.col("below_kinds").alias("kinds")), f"walk{k}")
            done.append(walked.filter("found").select("key", "value"))
            open_ = walked.filter("NOT found").drop("found")
        # below the empty context: every symbol that no context holds
        left = F.greatest(F.coalesce("kinds", F.lit(SYMBOLS)), F.lit(1))
        done.append(open_.select("key", (F.col("value") - F.log10(left)).alias("value")))
        out = done[0]
        for part in done[1:]:
            out = out.unionByName(part)
        return staged(out, "ppm-lengths")


def _sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.zeros(0, tk.U64), *(k for k, _ in parts)])
    values = np.concatenate([np.zeros(0), *(v for _, v in parts)])
    order = np.argsort(keys)
    return keys[order], values[order]


def _scorer(n_words: int, vocabulary: int, end_count: int, key_type: pa.DataType):
    """``mapInArrow`` function over rows sorted by block and kind: the (key, value) rows of
    a block, then its texts, which are scored batch by batch."""
    floor = math.log10(n_words + vocabulary + 1)
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, block, lookup = ([], []), None, None
        for batch in batches:
            place = np.asarray(batch.column("place"))
            cuts = np.r_[0, np.flatnonzero(place[1:] != place[:-1]) + 1, len(place)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if lo == hi:
                    continue
                now, kind = divmod(int(place[lo]), 4)
                if now != block:
                    parts, block, lookup = ([], []), now, None
                part = batch.slice(lo, hi - lo)
                if kind != _TEXT:
                    parts[kind].append((np.array(part.column("key")).view(tk.U64),
                                        np.array(part.column("value"))))
                    continue
                if lookup is None:
                    lookup = [_sorted(p) for p in parts]
                    parts = ([], [])
                for at, buf, off in _pieces(part.column("text")):
                    found = score_piece(buf, off, lookup)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").slice(at, len(off) - 1).cast(key_type),
                         *(pa.array(x, t) for x, t in zip(
                             found, [pa.int64()] * 2 + [pa.float64()] * 2, strict=True))],
                        names=names)

    def score_piece(buf, off, lookup):
        n = len(off) - 1
        gram, rows = grams(buf, off)
        pair = np.sort(gram << tk.U64(15) | rows.astype(tk.U64))
        gram, rows = pair >> tk.U64(15), (pair & tk.U64(_MAX_ROWS - 1)).astype(np.int64)
        lead = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        keys, values = lookup[_GRAM]
        each = np.repeat(values[np.searchsorted(keys, gram[lead])],
                         np.diff(np.r_[lead, len(gram)]))
        score = np.bincount(rows, weights=each, minlength=n)
        starts, ends = tk.words(buf, off)
        rows = tk.rows_of(starts, off)
        keys, values = lookup[_WORD]
        count = values[np.searchsorted(keys, tk.hash_spans(buf, starts, ends))] \
            if len(starts) else np.zeros(0)
        words = np.bincount(rows, minlength=n)
        known = np.bincount(rows, weights=count > 0, minlength=n) + (end_count > 0)
        base = np.bincount(rows, weights=np.log10(count + 1), minlength=n) \
            + math.log10(end_count + 1) - (words + 1) * floor
        return words + 1, known.astype(np.int64), base, score

    return run


def score(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every row under the model of the rows for which ``learn`` holds.

    Returns ``doc_id`` (the key), ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (unigram words) and ``score`` (log10 probability of the text)."""
    tk.small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))
    size, n_learn = rows.agg(F.sum(F.octet_length("text")), F.count_if("learn")).first()
    n_blocks = max(1, math.ceil((size or 0) / BLOCK_TEXT))
    rows = rows.withColumn("block", F.pmod(
        F.xxhash64("doc_id", F.length("text")), F.lit(n_blocks)).cast("int"))
    listed = staged(rows.groupBy("block").applyInArrow(
        _block_keys, "block int, kind byte, key long, n long"), "ppm-blocks")
    counted = staged(listed.groupBy("kind", "key").agg(F.sum("n").alias("n")), "ppm-counts")
    words = counted.filter(F.col("kind") == _WORD)
    n_words, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    lengths = code_lengths(counted.filter(F.col("kind") == _GRAM).select("key", "n"))
    model = (lengths.select(F.lit(_GRAM).cast("byte").alias("kind"), "key", "value")
             .unionByName(words.select("kind", "key", F.col("n").cast("double").alias("value"))))
    asked = listed.select("block", "kind", "key").join(model, ["kind", "key"])
    id_type = rows.schema["doc_id"].dataType
    place = F.col("block").cast("long") * 4
    lined_up = (asked.select((place + F.col("kind")).alias("place"), "block", "key", "value",
                             F.lit(None).cast(id_type).alias("doc_id"),
                             F.lit(None).cast("string").alias("text"))
                .unionByName(rows.select((place + _TEXT).alias("place"), "block", "doc_id", "text"),
                             allowMissingColumns=True)
                .repartitionById(n_blocks, "block").drop("block").sortWithinPartitions("place"))
    scored = lined_up.mapInArrow(
        _scorer(n_words + n_learn, vocabulary + (n_learn > 0), n_learn,
                tk.arrow_type(rows, "doc_id")),
        f"doc_id {id_type.simpleString()}, n_tokens long, n_known long, base_score double, "
        "score double")
    return scored.withColumn("train_tokens", F.lit(n_words + n_learn).cast("long"))


def score_held_out(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7,
                   fold: int = 2) -> DataFrame:
    """Train on all ids outside one fold of their crc32 and score every row."""
    held_out = id_remainder(key, folds) == fold
    return score(docs, ~held_out, key, text).withColumn(
        "held_out", id_remainder("doc_id", folds) == fold)
