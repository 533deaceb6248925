"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

``encode`` cuts every text with the tokenizer's pattern and collects the distinct
pieces of a bounded block of documents.  All pieces of the block are merged
together: an inverted index maps each mergeable pair (named by the id it merges to)
to the positions where it stands, the lowest id present is replayed over all of its
positions at once, and only the two neighbours of a merged position get new pairs.
Positions live in flat arrays with previous / next links, so a piece of any length
costs its own merges and nothing quadratic.

Ids equal the public ``tiktoken`` library's ``encode_ordinary``: a piece that is a
token itself is that token; otherwise the pair with the lowest id merges first, the
leftmost of equals.

Defined cases: null text = empty = no ids; white space and control characters are
ordinary text; null ids decode to null; an id outside the vocabulary raises; rows
are independent, so repeated rows and ids, ties and extra columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textkit import small_batches

#: Text of the documents whose distinct pieces are merged together.
REPLAY_BYTES = 12 << 20
#: Pairs that are looked up at once when a replay begins.
LOOKUPS = 1 << 17


class Vocabulary:
    """Ranks of a byte-level BPE vocabulary, and what the replay looks up in them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * self.size
        for token, i in ranks.items():
            self.tokens[i] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs: dict[int, int] = {}
        #: ids after whose merge a pair with a lower id may stand beside them
        self.rewinds = np.zeros(self.size, bool)
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = i
                    if i < left:
                        self.rewinds[left] = True
                    if i < right:
                        self.rewinds[right] = True
        self._keys = np.array(sorted(pairs), np.int64)
        self._ids = np.array([pairs[k] for k in self._keys.tolist()], np.int32)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id that each pair merges to, or -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ids[at], -1)


@lru_cache(maxsize=2)
def vocabulary(data: bytes, pattern: str) -> Vocabulary:
    """Vocabulary from the bytes of a ranks file (base64 token, space, rank per line)."""
    return Vocabulary({base64.b64decode(t): int(r) for t, r in
                       (line.split() for line in data.splitlines() if line)}, pattern)


class _PairIndex:
    """Pending positions by the id their pair merges to, lowest id first."""

    def __init__(self):
        self._at: dict[int, list[np.ndarray]] = {}
        self._heap: list[int] = []

    def add(self, ids: np.ndarray, positions: np.ndarray) -> None:
        found = ids >= 0
        ids, positions = ids[found], positions[found]
        if not len(ids):
            return
        order = np.argsort(ids, kind="stable")
        ids, positions = ids[order], positions[order]
        cuts = np.flatnonzero(ids[1:] != ids[:-1]) + 1
        for i, part in zip(ids[np.r_[0, cuts]].tolist(), np.split(positions, cuts),
                           strict=True):
            if i not in self._at:
                self._at[i] = []
                heapq.heappush(self._heap, i)
            self._at[i].append(part)

    def pop(self) -> tuple[int, np.ndarray] | None:
        if not self._heap:
            return None
        i = heapq.heappop(self._heap)
        return i, np.unique(np.concatenate(self._at.pop(i)))


def replay(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces in one flat array, and the bounds of each piece in it."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    symbol = vocab.byte_id[data]
    n = len(symbol)    # under 2^31: a block's distinct pieces
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    starts = np.cumsum(lengths) - lengths
    filled = lengths > 0
    after[(starts + lengths - 1)[filled]] = -1
    before[starts[filled]] = -1
    pending = np.full(n, -1, np.int32)
    alive = np.ones(n, bool)
    index = _PairIndex()

    def renew(at: np.ndarray) -> None:
        """Look up the pairs that now start at these positions."""
        nxt = after[at]
        ids = np.where(nxt >= 0, vocab.joined(symbol[at], symbol[nxt]), -1)
        pending[at] = ids
        index.add(ids, at)

    for lo in range(0, n, LOOKUPS):
        renew(np.arange(lo, min(n, lo + LOOKUPS), dtype=np.int32))
    while (entry := index.pop()) is not None:
        i, at = entry
        at = at[alive[at] & (pending[at] == i)]
        if not len(at):
            continue
        if vocab.rewinds[i]:  # a lower pair may arise: one merge per piece, then look again
            lead = np.r_[True, piece[at[1:]] != piece[at[:-1]]]
            index.add(np.full(int((~lead).sum()), i, np.int32), at[~lead])
            at = at[lead]
        elif len(at) > 1:  # of overlapping pairs in a run, every other one from the left
            chained = np.r_[False, after[at[:-1]] == at[1:]]
            order = np.arange(len(at))
            run_start = np.maximum.accumulate(np.where(chained, 0, order))
            at = at[(order - run_start) % 2 == 0]
        gone = after[at]
        symbol[at] = i
        alive[gone] = False
        pending[gone] = -1
        nxt = after[gone]
        after[at] = nxt
        before[nxt[nxt >= 0]] = at[nxt >= 0]
        left = before[at]
        renew(np.unique(np.concatenate([at, left[left >= 0]])))
    per_piece = np.bincount(piece[alive], minlength=len(pieces))
    return symbol[alive].astype(np.uint32), np.r_[0, np.cumsum(per_piece)]


class _Numbers(dict):
    """Numbers keys in the order of their first lookup."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def encode_texts(texts: Iterable[str | None], vocab: Vocabulary) -> Iterator[np.ndarray]:
    """Ids (``uint32``) of each text; the distinct pieces are merged together.  The texts are
    taken one by one and not kept."""
    number = _Numbers()
    cut = vocab.pattern.findall
    docs = [np.fromiter(map(number.__getitem__, cut(t)), np.int32) if t else
            np.zeros(0, np.int32) for t in texts]
    whole = np.full(len(number), -1, np.int64)
    rest = []
    for k, word in enumerate(number):
        word = word.encode()
        i = vocab.ranks.get(word)
        if i is None:
            rest.append(word)
        else:
            whole[k] = i
    number.clear()
    flat, bounds = replay(rest, vocab)
    del rest
    # one pool: the merged pieces' ids, then every piece that is a token itself
    known = whole >= 0
    starts = np.empty(len(whole), np.int64)
    lengths = np.ones(len(whole), np.int64)
    starts[~known], lengths[~known] = bounds[:-1], np.diff(bounds)
    starts[known] = len(flat) + np.arange(int(known.sum()))
    pool = np.concatenate([flat, whole[known].astype(np.uint32)])
    for pieces in docs:
        n = lengths[pieces]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        yield pool[np.repeat(starts[pieces] - ends + n, n) + np.arange(total)]


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> bytes:
    """Bytes of the ids; an unknown id raises."""
    tokens = vocab.tokens
    try:
        return b"".join([tokens[i] for i in ids.tolist()])
    except (IndexError, TypeError):
        raise ValueError("id outside the vocabulary") from None


def _blocks(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= REPLAY_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def encoded_batches(batches: Iterable[pa.RecordBatch], vocab: Vocabulary, text: str = "text"
                    ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch with the ids of its rows."""
    for held in _blocks(batches, text):
        ids = encode_texts((t for b in held for t in b.column(text).to_pylist()), vocab)
        for batch in held:
            yield batch, list(islice(ids, batch.num_rows))


def _shared(docs: DataFrame, ranks_path: str):
    """The ranks file's bytes (under 1 MB), read once and sent to the executors."""
    with open(ranks_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
           ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """Add ``ids`` (``array<int>``) to the rows, and with ``decoded`` a column (binary) of
    what the ids decode to, in the same pass; columns of those names are replaced."""
    small_batches(docs.sparkSession)
    data = _shared(docs, ranks_path)
    kept = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    made = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded:
        made.append(T.StructField(decoded, T.BinaryType()))

    def run(batches):
        vocab = vocabulary(data.value, pattern)
        for batch, found in encoded_batches(batches, vocab, text):
            bounds = np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.int32)
            new = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))]
            if decoded:
                new.append(pa.array([decode_ids(x, vocab) for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), *new],
                names=[*(f.name for f in kept), *(f.name for f in made)])

    return docs.mapInArrow(run, T.StructType([*kept, *made]))


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "token_ids",
           out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary): the bytes of the ids."""
    data = _shared(encoded, ranks_path)
    kept = [f for f in encoded.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])

    def run(batches):
        vocab = vocabulary(data.value, pattern)
        for batch in batches:
            decoded = [None if x is None else decode_ids(np.asarray(x, np.int64), vocab)
                       for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(decoded, pa.binary())],
                names=[*(f.name for f in kept), out])

    return encoded.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Per row: ``key``, number of ids, digest of the ids (little-endian 32-bit) and of
    the bytes decoded from them.  Encoding and decoding run in one pass, so ids do not
    travel back to the JVM."""
    small_batches(docs.sparkSession)
    data = _shared(docs, ranks_path)
    rows = docs.select(key, text)
    schema = T.StructType([rows.schema[key], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        vocab = vocabulary(data.value, pattern)
        for batch, found in encoded_batches(batches, vocab, text):
            yield pa.RecordBatch.from_arrays([
                batch.column(key),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest()
                          for x in found], pa.string()),
                pa.array([hashlib.sha256(decode_ids(x, vocab)).hexdigest()
                          for x in found], pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, schema)
