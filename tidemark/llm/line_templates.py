"""Line deduplication with a log-template tree.

Lines are parsed into a tree of fixed depth: the number of tokens, then the leading tokens,
a token with a digit standing for any other; a line of mostly such tokens (numbers, table
rows) is compared as it is and fits no template.  Equal lines (with such fields masked) are
counted first, so the tree sees each distinct line once.  In a leaf, positions where most
of its lines agree on a word are constants and the others variable fields; lines that keep
to enough of the constants, and of the whole width, are instances of that template.  What a leaf leaves over is parsed once
more with more leading tokens; what is left then is split by the most frequent (position,
token) of its leaf, again and again until no two lines of a leaf share one, so a leaf gives
several templates.  Templates and lines that recur across documents are dropped from all
documents but the first that has them.

Leaves are never gathered: a template comes from counts per (leaf, position, token), and
its width is that of a line.

Scripts without spaces have long tokens: two of their characters count as a token more.
Lines of fewer tokens than a leaf needs are compared as they are.

Defined cases: a line ends at \\n; blank lines and lines of under MIN_TOKENS tokens stay,
unless they have MIN_BYTES bytes of letters (they count as MIN_TOKENS tokens then); lines of under
LONG_TOKENS tokens recur by chance and must be in SHORT_DOCS documents;
repeats within one document stay; the first document is the one with the smallest id
(rows without an id come last); rows that agree in id and text are one document; a null
text stays null; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import staged, unused, workspace
from .skew import join_groups

MIN_TOKENS, LONG_TOKENS = 4, 8
LONG_DOCS, SHORT_DOCS = 2, 5
MIN_BYTES = 24
#: Leading tokens that make a leaf, one number per pass.
DEPTHS = (4, 8)
#: Share of tokens that must be constant, and share of the constants a line must have.
SIMILARITY = 0.7
#: Tokens without a digit, in number and as a share of the line, for digits to be masked.
MIN_WORDS, WORD_SHARE = 3, 0.5

_ANY = tk.U64(0x2A)
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
#: First bytes of characters of three bytes and more (Thai, Chinese, Japanese, Korean and
#: others), without those of general punctuation and symbols.
_WIDE = np.isin(np.arange(256), [0xE0, 0xE1, *range(0xE3, 0xF5)])


def parse(buf: np.ndarray, off: np.ndarray):
    """Lines that are long enough: (row, line number, first token, end token, size, whether
    it has the words for a template) and all tokens."""
    starts, ends = tk.words(buf, off)
    token = tk.hash_spans(buf, starts, ends)
    l_start, l_end = tk.runs(buf != 10, off)
    row = tk.rows_of(l_start, off)
    breaks = np.r_[0, np.cumsum(buf == 10, dtype=np.int64)]
    number = breaks[l_start] - breaks[off[:-1]][row]
    first, last = np.searchsorted(starts, l_start), np.searchsorted(starts, l_end)
    digits = np.r_[0, np.cumsum(_DIGIT[buf], dtype=np.int64)]
    field = digits[ends] > digits[starts]
    fields = np.r_[0, np.cumsum(field, dtype=np.int64)]
    n_words = last - first - (fields[last] - fields[first])
    worded = (last - first >= MIN_TOKENS) & (
        n_words >= np.maximum(MIN_WORDS, WORD_SHARE * (last - first)))
    token[field & np.repeat(worded, last - first)] = _ANY
    wide = np.r_[0, np.cumsum(_WIDE[buf], dtype=np.int64)]
    size = last - first + (wide[l_end] - wide[l_start]) // 2
    letters = np.r_[0, np.cumsum(_LETTER[buf], dtype=np.int64)]
    size = np.where(letters[l_end] - letters[l_start] >= MIN_BYTES, np.maximum(size, MIN_TOKENS), size)
    keep = size >= MIN_TOKENS
    return row[keep], number[keep], first[keep], last[keep], size[keep], worded[keep], token


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _lines(rows: DataFrame) -> DataFrame:
    """(row_key, doc_id, leaf, line, tokens, numbers): each distinct line of each row."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([
        ("row_key", pa.int64()), ("doc_id", tk.arrow_type(rows, "doc_id")),
        ("leaf", pa.int64()), ("line", pa.int64()), ("tokens", pa.int32()),
        ("numbers", pa.list_(pa.int32()))])

    def run(batch, buf, off):
        row, number, first, last, size, worded, token = parse(buf, off)
        line = tk.hash_sequences(token, first, last)
        # a line of mostly numbers or of few tokens is alone in its leaf
        lead = tk.hash_sequences(token, first, np.minimum(first + DEPTHS[0], last))
        leaf = np.where(worded, tk.mix(lead + (last - first).astype(tk.U64)), line)
        order = np.lexsort((number, line, row))
        row, number, line, leaf, size = (x[order] for x in (row, number, line, leaf, size))
        lead = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (row[1:] != row[:-1])]) \
            if len(line) else np.zeros(0, np.int64)
        numbers = pa.ListArray.from_arrays(pa.array(np.r_[lead, len(line)].astype(np.int32)),
                                           pa.array(number.astype(np.int32)))
        at = pa.array(row[lead])
        return [batch.column("row_key").take(at), batch.column("doc_id").take(at),
                leaf[lead].view(np.int64), line[lead].view(np.int64),
                size[lead].astype(np.int32), numbers]

    return rows.select(_row_key().alias("row_key"), "doc_id", "text").mapInArrow(
        tk.map_blocks(run, schema), f"row_key long, doc_id {kind}, leaf long, line long, "
        "tokens int, numbers array<int>")


def _with_tokens(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(leaf, line, sequence) of the wanted (row_key, leaf, line): the lines' tokens."""
    asked = wanted.groupBy("row_key").agg(F.collect_set("line").alias("asked"))
    schema = pa.schema([("line", pa.int64()), ("sequence", pa.list_(pa.int64()))])

    def run(batch, buf, off):
        row, _, first, last, _, _, token = parse(buf, off)
        line = tk.hash_sequences(token, first, last).view(np.int64)
        lists = batch.column("asked")
        owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        # a wanted line counts in the rows that asked for it
        pairs = {(r, x) for r, x in zip(owner.tolist(), lists.flatten().to_pylist(), strict=True)}
        lines, sequences = [], []
        for r, x, a, b in zip(row.tolist(), line.tolist(), first.tolist(), last.tolist(),
                              strict=True):
            if (r, x) in pairs:
                pairs.discard((r, x))
                lines.append(x), sequences.append(token[a:b].view(np.int64))
        return [lines, sequences]

    texts = rows.select(_row_key().alias("row_key"), "text").join(asked, "row_key")
    found = texts.mapInArrow(tk.map_blocks(run, schema), "line long, sequence array<long>")
    return found.groupBy("line").agg(F.first("sequence").alias("sequence")).join(
        wanted.select("leaf", "line"), "line")


def _templates(lines: DataFrame, similarity: float) -> DataFrame:
    """(line, template) of the lines (leaf, line, sequence) that fit their leaf's template,
    for templates with two lines or more.  A masked field is no constant: it only counts
    where a line is compared over its whole width."""
    votes = (lines.select("leaf", F.posexplode("sequence").alias("at", "token"))
             .groupBy("leaf", "at", "token").agg(F.count("*").alias("n")))
    positions = votes.groupBy("leaf", "at").agg(
        F.max_by("token", F.struct("n", "token")).alias("token"),
        (2 * F.max("n") > F.sum("n")).alias("fixed"), F.sum("n").alias("lines"))
    positions = positions.withColumn("word", F.col("fixed") & (F.col("token") != int(_ANY)))
    shape = (positions.groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct("at", "token", "fixed", "word"))).alias("shape"),
        F.count_if("word").alias("n_words"), F.count_if("fixed").alias("n_fixed"),
        F.count("*").alias("width"), F.max("lines").alias("lines"))
        .filter((F.col("lines") > 1) & (F.col("n_words") >= F.greatest(
            F.lit(MIN_WORDS), WORD_SHARE * F.col("width"),
            similarity * (F.col("width") - F.col("n_fixed") + F.col("n_words"))))))

    def agreed(kind: str) -> Column:
        return F.size(F.filter(
            F.zip_with("sequence", "shape", lambda t, s: s[kind] & (t == s["token"])),
            lambda hit: hit))

    fits = lines.join(shape, "leaf").filter(
        (agreed("word") >= similarity * F.col("n_words"))
        & (agreed("fixed") >= similarity * F.col("width"))).select(
        "line", F.col("leaf").alias("template"))
    pairs = fits.groupBy("template").count().filter("count > 1").select("template")
    return fits.join(pairs, "template").select("line", "template")


def _leaf(depth: int) -> Column:
    return F.xxhash64(F.lit(depth), F.size("sequence"), F.slice("sequence", 1, depth))


def _split(lines: DataFrame) -> DataFrame:
    """The lines (leaf, line, sequence) in smaller leaves: each goes by the most frequent
    (position, token) of its leaf that it has and other lines of the leaf have not.  Lines
    that share no such token with another are left out: nothing of them recurs."""
    at = lines.select("leaf", "line", F.posexplode("sequence").alias("at", "token"))
    total = lines.groupBy("leaf").agg(F.count("*").alias("total")).filter("total > 2")
    votes = (at.groupBy("leaf", "at", "token").agg(F.count("*").alias("n")).filter("n > 1")
             .join(total, "leaf").filter("n < total"))
    best = at.join(votes, ["leaf", "at", "token"]).groupBy("leaf", "line").agg(
        F.max(F.struct("n", "at", "token")).alias("best"))
    return lines.join(best, ["leaf", "line"]).select(
        F.xxhash64("leaf", "best.at", "best.token").alias("leaf"), "line", "sequence")


def recurring(rows: DataFrame, lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(line, keeper, docs): lines of recurring templates, the row that keeps them and in
    how many documents the line itself is."""
    holder = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    with workspace(rows.sparkSession, "templates") as stage:
        distinct = stage(lines.groupBy("leaf", "line").agg(
            F.min(holder).alias("first"), F.count("*").alias("docs"), F.first("tokens").alias("tokens")),
            "lines")
        shared = distinct.groupBy("leaf").count().filter("count > 1").select("leaf")
        rest = stage(_with_tokens(rows, distinct.join(shared, "leaf").select(
            F.col("first.row_key").alias("row_key"), "leaf", "line")), "tokens")
        named = None
        for i, depth in enumerate(DEPTHS):
            leaves = rest.withColumn("leaf", _leaf(depth)) if i else rest
            fits = stage(_templates(leaves, similarity), "fits")
            rest = rest.join(fits.select("line"), "line", "left_anti")
            named = fits if named is None else named.unionByName(fits)
        # each split adds a token that all lines of a leaf have, so this ends
        while not (rest := stage(_split(rest), "split")).isEmpty():
            fits = stage(_templates(rest, similarity), "fits")
            rest = rest.join(fits.select("line"), "line", "left_anti")
            named = named.unionByName(fits)
        group = distinct.join(named, "line", "left").withColumn(
            "group", F.coalesce("template", "line"))
        whole = group.groupBy("group").agg(F.min("first").alias("keeper"),
                                           F.sum("docs").alias("group_docs"),
                                           F.max("tokens").alias("width"))
        enough = F.when(F.col("width") >= LONG_TOKENS, LONG_DOCS).otherwise(SHORT_DOCS)
        return staged(group.join(whole.filter(F.col("group_docs") >= enough), "group").select(
            "line", F.col("keeper.row_key").alias("keeper"), "docs"), "template-recurring")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                similarity: float = SIMILARITY, out: str = "text") -> DataFrame:
    """Every row with its columns; ``out`` holds the text without the dropped lines, and
    ``dropped_lines`` their numbers (from 0, null if none); columns of those names are
    replaced."""
    tk.small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    lines = staged(_lines(rows), "template-rows")
    again = recurring(rows, lines, similarity)
    n_lines = lines.count()
    row, drop = unused(docs, "_row_key"), unused(docs, "_dropped")
    dropped = (join_groups(lines.select("line", "row_key", "numbers"), again, "line", "docs", n_lines)
               .filter("row_key != keeper").groupBy(F.col("row_key").alias(row))
               .agg(F.array_distinct(F.flatten(F.collect_list("numbers"))).alias(drop)))
    names = [c for c in docs.columns if c not in (out, "dropped_lines")]
    kept = F.array_join(F.filter(
        F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains(drop, i)), "\n")
    joined = docs.withColumn(row, F.xxhash64(F.col(key), F.col(text))).join(dropped, row, "left")
    return joined.select(*names, F.when(F.col(drop).isNull(), F.col(text)).otherwise(kept)
                         .alias(out), F.array_sort(drop).alias("dropped_lines"))
