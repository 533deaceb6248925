"""Quality classifier: logistic regression on hashed word n-grams, FTRL-proximal.

Tokens are runs of letters and digits, and runs of other visible characters.  Two
streams of n-grams are hashed into one weight vector: the lower-cased tokens and their
shapes (capitals, digits, the mark itself, or "same as the token before"), as single
tokens and as pairs.  A feature's value is its share of the text's tokens, so scoring a
text is one sparse dot product: the sum of its n-grams' weights over their number.

Defined cases: a null text scores as an empty one, and a text without tokens scores the
bias alone; without any labelled row of both classes every score is 0.5; repeated rows
score alike; a null id is held out; labels without a document are ignored.  Only id and
text are read, so other columns and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .labelled import TRAIN_ROWS, VISITS, id_remainder, training_rows

BITS = 18
SCALE = 10.0

_BYTES = np.arange(256)
_UPPER = np.isin(_BYTES, np.arange(65, 91))
_DIGIT = np.isin(_BYTES, np.arange(48, 58))
_WORD = _UPPER | _DIGIT | np.isin(_BYTES, np.arange(97, 123)) | (_BYTES >= 0x80)
_MARK = ~_WORD & ~tk.IS_SPACE
_SAME = tk.U64(0x51ED270B35F1A7C9)


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams of a block, and the row of each (ascending)."""
    low = tk.lower_ascii(buf)
    spans = [tk.runs(member[buf], off) for member in (_WORD, _MARK)]
    starts = np.concatenate([s for s, _ in spans])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.concatenate([e for _, e in spans])[order]
    rows = tk.rows_of(starts, off)
    token = tk.hash_spans(low, starts, ends)
    is_word = _WORD[buf[starts]] if len(starts) else np.zeros(0, bool)
    length = ends - starts

    def count(member: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(member[buf], dtype=np.int64)]
        return total[ends] - total[starts]

    upper, digit = count(_UPPER), count(_DIGIT)
    kind = np.where(digit > 0, 5, np.where(upper == 0, 1, np.where(
        (upper == 1) & (length > 1), 2, np.where(2 * upper > length, 3, 4))))
    shape = np.where(is_word, tk.mix(kind.astype(tk.U64)), token)
    if len(token) > 1:
        again = (token[1:] == token[:-1]) & (rows[1:] == rows[:-1])
        shape[1:][again] = _SAME
    pair = rows[1:] == rows[:-1]
    grams = [tk.mix(token), tk.hash_runs(token, 2)[pair] if len(token) > 1 else token[:0],
             tk.mix(shape + tk.U64(7)),
             tk.hash_runs(shape + tk.U64(9), 2)[pair] if len(token) > 1 else token[:0]]
    gram_rows = np.concatenate([rows, rows[1:][pair], rows, rows[1:][pair]])
    order = np.argsort(gram_rows, kind="stable")
    number = (np.concatenate(grams) >> tk.U64(64 - BITS)).astype(np.int64)
    return number[order], gram_rows[order]


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # float32, 2 ** BITS

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        number, rows = features(buf, off)
        dot = np.bincount(rows, weights=self.weights[number], minlength=n)
        size = np.maximum(np.bincount(rows, minlength=n), 1)
        return 1 / (1 + np.exp(-np.clip(self.bias + SCALE * dot / size, -35, 35)))


def ftrl(examples: list[tuple[float, np.ndarray, np.ndarray]], visits: int = VISITS,
         alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> Model:
    """FTRL-proximal over (y, feature numbers, values), in the given order.  The bias is a
    feature without penalty."""
    n_weights = 1 << BITS
    z, n = np.zeros(n_weights + 1), np.zeros(n_weights + 1)
    penalty1 = np.full(n_weights + 1, l1)
    penalty1[-1] = 0.0

    def weight(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        free = np.sign(zi) * penalty1[at] - zi
        return np.where(np.abs(zi) <= penalty1[at], 0.0,
                        free / ((beta + np.sqrt(n[at])) / alpha + l2))

    if len({y for y, _, _ in examples}) == 2:
        for _ in range(max(1, round(visits / len(examples)))):
            for y, at, value in examples:
                w = weight(at)
                p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
                g = (p - y) * value
                g2 = g * g
                z[at] += g - (np.sqrt(n[at] + g2) - np.sqrt(n[at])) / alpha * w
                n[at] += g2
    w = weight(np.arange(n_weights + 1))
    return Model(float(w[-1]), w[:-1].astype(np.float32))


def _sparse(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    number, rows = features(buf, off)
    cuts = tk.group_bounds(rows, len(off) - 1)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        at, times = np.unique(number[lo:hi], return_counts=True)
        yield (np.r_[at, 1 << BITS],
               np.r_[SCALE * times / max(1, hi - lo), 1.0])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
          text: str = "text", max_rows: int = TRAIN_ROWS) -> Model:
    """Fit on a hash sample of at most about ``max_rows`` labelled documents.

    Features are made where the texts lie; one task streams the bounded sample through
    FTRL; the driver gets the weights (1 MB)."""
    tk.small_batches(docs.sparkSession)
    rows = training_rows(docs, labels, label, key, text, max_rows)

    def featurise(batches):
        for batch in batches:
            for lo, hi, buf, off in tk.text_blocks(batch.column("text")):
                at, value = zip(*_sparse(buf, off), strict=True)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), part.column("order"),
                     pa.array([x.astype(np.int32).tobytes() for x in at], pa.binary()),
                     pa.array([x.astype(np.float32).tobytes() for x in value], pa.binary())],
                    names=["y", "order", "at", "value"])

    def fit(batches):
        examples = [(y, np.frombuffer(at, np.int32), np.frombuffer(value, np.float32))
                    for b in batches for y, _, at, value in
                    zip(*(c.to_pylist() for c in b.columns), strict=True)]
        model = ftrl(examples)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.bias]), pa.array([model.weights.tobytes()], pa.binary())],
            names=["bias", "weights"])

    found = (rows.mapInArrow(featurise, "y double, order long, at binary, value binary")
             .repartition(1).sortWithinPartitions("order")
             .mapInArrow(fit, "bias double, weights binary").collect())
    if not found:
        return ftrl([])
    return Model(found[0]["bias"], np.frombuffer(found[0]["weights"], np.float32))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """``key``, ``score`` (probability of label 1) and ``predicted`` of every row."""
    tk.small_batches(docs.sparkSession)
    rows = docs.select(key, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema[key].dataType.simpleString()
    schema = pa.schema([(key, tk.arrow_type(rows, key)),
                        ("score", pa.float64())])
    scored = rows.mapInArrow(tk.map_blocks(
        lambda batch, buf, off: [batch.column(key), shared.value.scores(buf, off)], schema, text),
        f"`{key}` {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows that are not rejected, with all their columns; scored where they lie."""
    tk.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for lo, hi, buf, off in tk.text_blocks(batch.column(text)):
                good = shared.value.scores(buf, off) >= threshold
                yield batch.slice(lo, hi - lo).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
             ) -> DataFrame:
    """Train on the labelled rows outside the held-out fold and score every row."""
    scored = score(docs, train(docs, labels, key=key, text=text), key, text)
    return scored.withColumn("held_out", id_remainder(key, 5) == 0)
