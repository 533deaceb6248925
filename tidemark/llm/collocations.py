"""Phrase collocations from count transducers.

Every task lists the word sequences of its texts, sorted, by shards of bounded text, and
builds each shard's automaton of counts (see ``transducer``), cut into ranges of sequences.
The automata of a range meet in one task, which unites them and adds the weights.  Sequences
below the least count cannot be a candidate or a part of one and are pruned there.  Each
range then asks the ranges that own the parts of its candidates: what is asked is an
automaton itself, the owner composes it with its counts, and the answer travels back.  The
same question tells the owner the largest count of a longer candidate that holds a sequence.
So no task holds more than a range, a frequent word is asked for at most once by a range, and
no part is joined by a key that many candidates share.

Ranges are cut at sequences sampled from the texts (64 a range, as many ranges as shuffle
partitions), which only decides who counts what.

Defined cases: a null language is ``und``; null and empty texts have no words; repeated rows
count each; letters are lowered for A-Z only; equal scores and counts rank by the phrase's
bytes; an empty table gives no rows; columns other than text and language are not read, so
their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import staged
from .transducer import (
    INT,
    Automaton,
    Level,
    Trie,
    compose,
    pruned,
    sequences,
    sorted_symbols,
    split,
    union,
)

#: Text whose sequences are sorted together.
SHARD_TEXT = 10 << 20
#: Nodes of tries that are united in one go.
UNION_NODES = 3_000_000
KEYS_A_RANGE = 64

#: Bytes that end a piece.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_IS_END = np.isin(np.arange(256), list(PIECE_ENDS))
_IS_GAP = _IS_END | np.isin(np.arange(256), list(b" \t"))

_COUNTS, _ASKED, _LONGER, _ANSWER = 0, 1, 2, 3
_MESSAGE = "range int, kind byte, origin int, data binary"


def _words(batches: list[tuple[pa.Array, pa.Array]]) -> tuple[np.ndarray, ...]:
    """Words of some rows: (language numbers, word numbers, piece numbers, languages, words)."""
    langs, found, pieces, made = [], [], [], 0
    for text, lang in batches:
        for lo, hi, buf, off in tk.text_blocks(text):
            buf = tk.lower_ascii(buf)
            starts, ends = tk.runs(~_IS_GAP[buf], off)
            rows = tk.rows_of(starts, off)
            ended = np.cumsum(_IS_END[buf])
            pieces.append(ended[starts] + rows + made)
            made += (int(ended[-1]) if len(ended) else 0) + hi - lo + 1
            offsets = np.r_[0, np.cumsum(ends - starts)].astype(INT)
            inside = np.zeros(len(buf) + 1, np.int8)
            inside[starts] += 1
            inside[ends] -= 1
            data = buf[np.cumsum(inside[:-1]).astype(bool)]
            found.append(pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(starts),
                [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
            ).dictionary_encode())
            langs.append(lang.slice(lo, hi - lo).take(pa.array(rows)))
    heads, head = sorted_symbols(pa.concat_arrays([x.cast(pa.large_binary()) for x in langs]))
    tables = [x.dictionary for x in found]
    words, rank = sorted_symbols(pa.concat_arrays(tables))
    at = np.cumsum([0, *(len(t) for t in tables)])
    word = np.concatenate([rank[a + x.indices.to_numpy()] for a, x in
                           zip(at, found, strict=False)])
    return head, word, np.concatenate(pieces), heads, words


def counted(batches: list[tuple[pa.Array, pa.Array]], longest: int) -> Trie | None:
    """Trie of all sequences of up to ``longest`` words inside pieces, by language, with
    their counts; the count of a language is its words."""
    if not any(len(t) for t, _ in batches):
        return None
    head, word, piece, heads, words = _words(batches)
    if not len(word):
        return None
    key, node = np.unique(head, return_inverse=True)
    levels = [Level(key, np.bincount(node, minlength=len(key)), np.zeros(len(key), INT))]
    at = np.arange(len(word))
    for k in range(longest):
        if k:
            at = at[:-1] if len(at) and at[-1] + k >= len(word) else at
            inside = piece[at + k] == piece[at]
            at, node = at[inside], node[:len(inside)][inside]
        key, place, count = np.unique(node * len(words) + word[at + k], return_inverse=True,
                                      return_counts=True)
        levels.append(Level(key % len(words), count, key // len(words)))
        node = place
    return Trie(heads, words, levels)


def _message(range_: int, kind: int, origin: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([range_], pa.int32()), pa.array([kind], pa.int8()),
         pa.array([origin], pa.int32()), pa.array([data], pa.binary())],
        names=["range", "kind", "origin", "data"])


def _shards(bounds, longest: int, shard_text: int):
    """``mapInArrow`` function: automata of counts by shard and range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            trie = counted(held, longest)
            if trie is not None:
                for r, part in split(trie, bounds.value):
                    yield _message(r, _COUNTS, 0, Automaton.build(part).dump())

        for batch in batches:
            for lo, hi, buf, _ in tk.text_blocks(batch.column("text")):
                held.append((batch.column("text").slice(lo, hi - lo),
                             batch.column("lang").slice(lo, hi - lo)))
                size += len(buf)
                if size >= shard_text:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()
    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in
                         ("range", "kind", "origin", "data")), strict=True)


class _Union:
    """Tries united as they come: when those held outgrow a bound and the united one, so
    that a node takes part in few unions."""

    def __init__(self, how=np.add):
        self.how, self.held, self.size, self.united = how, [], 0, 0

    def add(self, trie: Trie) -> None:
        self.held.append(trie)
        self.size += trie.size
        if self.size > max(UNION_NODES, 2 * self.united):
            self.result()

    def result(self) -> Trie | None:
        if len(self.held) > 1:
            self.held = [union(self.held, self.how)]
        self.size = self.united = self.held[0].size if self.held else 0
        return self.held[0] if self.held else None


def _parts(trie: Trie, least: int):
    """The candidates of a range by number of words, ``(length, nodes)``, the trie of their
    parts, and the part's node of each ``(length, first word, end word)`` of the candidates.
    A part's weight is the largest count of a candidate that holds it, if it could itself be
    one."""
    found = [(m, np.flatnonzero(trie.levels[m].weight >= least))
             for m in range(2, len(trie.levels))]
    columns, lengths, weights, index = [], [], [], {}
    depth, total = len(trie.levels), 0
    for m, nodes in found:
        path = trie.path(m, nodes)
        for a in range(1, m + 1):
            for b in range(a + 1, m + 2):
                if (a, b) == (1, m + 1) or (a > 1 and b <= m and b - a < 2):
                    continue
                block = np.zeros((depth, len(nodes)), INT)
                block[:b - a + 1] = [path[0], *path[a:b]]
                columns.append(block)
                lengths.append(np.full(len(nodes), b - a + 1))
                weights.append(trie.levels[m].weight[nodes] * (b - a >= 2))
                index[m, a, b] = slice(total, total + len(nodes))
                total += len(nodes)
    if not total:
        return found, None, {}
    parts, node = sequences(list(np.concatenate(columns, axis=1)), np.concatenate(lengths),
                            np.concatenate(weights), trie.heads, trie.words, np.maximum)
    return found, parts, {k: node[s] for k, s in index.items()}


def _united(bounds, least: int):
    """``mapInArrow`` function over the automata of one range: their union, pruned, what its
    candidates ask of other ranges, and the words of each language."""
    def run(batches):
        total, at = _Union(), None
        for r, _, _, data in _rows(batches):
            total.add(Automaton.load(data).expand())
            at = r
        trie = total.result()
        if trie is None:
            return
        langs, heads = trie.levels[0], trie.heads.to_pylist()
        totals = [(heads[i], n) for i, n in zip(langs.label.tolist(), langs.weight.tolist(),
                                               strict=True) if n]
        trie = pruned(trie, least)
        yield from _with_words(_message(at, _COUNTS, at, Automaton.build(trie).dump()), totals)
        parts = _parts(trie, least)[1]
        if parts is not None:
            for r, asked in split(parts, bounds.value):
                yield from _with_words(_message(r, _ASKED, at, Automaton.build(asked).dump()))
    return run


def _with_words(message: pa.RecordBatch, totals=()) -> Iterator[pa.RecordBatch]:
    """The message with the words of languages beside it."""
    yield pa.RecordBatch.from_arrays(
        [*message.columns, pa.array([[{"lang": h.decode(), "n": n} for h, n in totals]],
                                    pa.list_(pa.struct([("lang", pa.string()),
                                                        ("n", pa.int64())])))],
        names=[*message.schema.names, "totals"])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` function over the automaton of a range, then the questions to it: the
    counts of what is asked, and at the end the largest counts of longer candidates."""
    counts, longer, at = None, _Union(np.maximum), None
    for r, kind, origin, data in _rows(batches):
        at, automaton = r, Automaton.load(data)
        if kind == _COUNTS:
            counts = automaton
            continue
        longer.add(automaton.expand())
        answer = compose(automaton, counts)
        yield _message(origin, _ANSWER, r, Automaton.build(answer).dump())
    found = longer.result()
    if found is not None:
        yield _message(at, _LONGER, at, Automaton.build(found).dump())


def _scored(least: int, share: int):
    """``mapInArrow`` function over the automaton of a range, the longer candidates and the
    answers to its questions: its candidates that stay, with their scores."""
    def rows(trie: Trie, longer: Trie | None, answers: Trie | None):
        found, parts, node = _parts(trie, least)
        if parts is None:
            return
        counts = compose(Automaton.build(parts), Automaton.build(answers))
        for m, nodes in found:
            path = trie.path(m, nodes)
            a = trie.levels[m].weight[nodes]
            stays = np.ones(len(nodes), bool)
            if longer is not None and len(nodes):
                own, place = sequences(path, np.full(len(nodes), m + 1), a, trie.heads,
                                       trie.words)
                over = compose(Automaton.build(own), Automaton.build(longer)).levels[m].weight
                stays = 100 * over[place] < share * a
            at = np.flatnonzero(stays)
            if not len(at):
                continue
            a = a[at].astype(object)    # exact integers of any size
            best = None
            for k in range(1, m):
                left = counts.levels[k].weight[node[m, 1, k + 1]][at].astype(object)
                right = counts.levels[m - k].weight[node[m, k + 1, m + 1]][at].astype(object)
                score = 1_000_000 * a * a // (left * right)
                if best is None:
                    best = [score, left, right]
                else:
                    lower = (score < best[0]).astype(bool)
                    best = [np.where(lower, new, old)
                            for new, old in zip((score, left, right), best, strict=True)]
            words = [trie.words.take(pa.array(p[at])) for p in path[1:]]
            phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))
            for lo in range(0, len(at), 8192):
                part = slice(lo, lo + 8192)
                yield pa.RecordBatch.from_arrays(
                    [trie.heads.take(pa.array(path[0][at][part])).cast(pa.large_string())
                     .cast(pa.string()),
                     phrase[part].cast(pa.large_string()).cast(pa.string()),
                     *(pa.array(x[part].astype(INT)) for x in (a, best[1], best[2], best[0]))],
                    names=["lang", "phrase", "a", "l", "r", "score"])

    def run(batches):
        trie, longer, answers = None, None, _Union()
        for _, kind, _, data in _rows(batches):
            part = Automaton.load(data).expand()
            if kind == _COUNTS:
                trie = part
            elif kind == _LONGER:
                longer = part
            else:
                answers.add(part)
        if trie is not None:
            yield from rows(trie, longer, answers.result())
    return run


def _sampled_bounds(rows: DataFrame, ranges: int) -> list[tuple[bytes, ...]]:
    """Sequences that cut the corpus into about equal ranges: some documents are drawn, and
    of each a word and its two followers every so many bytes."""
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not n or not size or ranges < 2:
        return []
    share = min(1.0, max(1000, 8 * ranges) / n)
    step = max(1, int(size * share / (ranges * KEYS_A_RANGE)))
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))

    def keys(batches):
        for batch in batches:
            trie_words = []
            for lo, hi, buf, off in tk.text_blocks(batch.column("text")):
                buf = tk.lower_ascii(buf)
                starts, ends = tk.runs(~_IS_GAP[buf], off)
                rows_ = tk.rows_of(starts, off)
                take = np.flatnonzero(np.diff(starts // step, prepend=-1) > 0)
                raw = buf.tobytes()
                for i in take.tolist():
                    last = min(i + 3, len(starts))
                    trie_words.append((batch.column("lang")[lo + int(rows_[i])].as_py().encode(),
                                       *(raw[starts[j]:ends[j]] for j in range(i, last)
                                         if rows_[j] == rows_[i])))
            yield pa.RecordBatch.from_arrays([pa.array(trie_words, pa.list_(pa.binary()))],
                                             names=["key"])

    found = rows.filter(drawn < int(share * (1 << 30))).mapInArrow(keys, "key array<binary>")
    distinct = sorted({tuple(map(bytes, r.key)) for r in found.toLocalIterator()})
    cuts = [distinct[len(distinct) * k // ranges] for k in range(1, ranges)] if distinct else []
    return [c for c, before in zip(cuts, [None, *cuts], strict=False) if c != before]


def find(docs: DataFrame, least: int = 10, longest: int = 3, share: int = 50, top: int = 2000,
         text: str = "text", lang: str = "lang", shard_text: int = SHARD_TEXT,
         ranges: int | None = None) -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words of every language: ``lang``,
    ``rank``, ``phrase``, its count ``a`` (at least ``least``), the counts ``l`` and ``r`` of
    the two sides of its weakest cut, ``n`` words of the language, ``score``.  A phrase inside
    a longer one goes if the longer has ``share`` percent of its count."""
    spark = docs.sparkSession
    tk.small_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).alias("text")).filter(F.length("text") > 0)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = spark.sparkContext.broadcast(_sampled_bounds(rows, ranges))
    n = len(bounds.value) + 1

    def by_range(messages: DataFrame) -> DataFrame:
        return messages.repartitionById(n, "range").sortWithinPartitions("range", "kind", "origin")

    shards = rows.mapInArrow(_shards(bounds, longest, shard_text), _MESSAGE)
    united = staged(by_range(shards).mapInArrow(
        _united(bounds, least), f"{_MESSAGE}, totals array<struct<lang: string, n: bigint>>"),
        "phrase-counts")
    messages = united.select("range", "kind", "origin", "data")
    answers = staged(by_range(messages).mapInArrow(_answered, _MESSAGE), "phrase-answers")
    scored = staged(by_range(messages.filter(F.col("kind") == _COUNTS).unionByName(answers))
                    .mapInArrow(_scored(least, share), "lang string, phrase string, a long, "
                                "l long, r long, score long"), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = F.pmod(F.xxhash64("phrase"), F.lit(64))    # a language's best of each 64th first
    best = scored.withColumn("part", some).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = united.select(F.explode("totals").alias("t")).groupBy("t.lang").agg(
        F.sum("t.n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n",
                                              "score")
