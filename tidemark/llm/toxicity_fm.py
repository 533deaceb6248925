"""Toxicity: factorization machine over hashed terms.

A text is the set of its lower-cased words (runs of letters), each a 64-bit hash.  The
machine adds a weight per term and the dot product of the factor vectors of every pair of
terms that occur together, so an insult beside a group's name can weigh more than either.
It is trained online on a bounded sample; only terms that enough training texts contain
and that bear on the label enter it, so the model is smaller than that sample.

Defined cases: a null or empty text, or one without a known term, scores the bias alone;
without labelled rows of both classes every score is 0.5; repeated rows score alike; a
null id is held out; labels without a document are ignored; only id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .labelled import TRAIN_ROWS, VISITS, id_remainder, training_rows

FACTORS = 8
#: Training texts that must contain a term.
MIN_TEXTS = 3

_BYTES = np.arange(256)
_LETTER = (np.isin(_BYTES, np.arange(65, 91)) | np.isin(_BYTES, np.arange(97, 123))
           | (_BYTES >= 0x80))


def terms(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of a block and the row of each."""
    starts, ends = tk.runs(_LETTER[buf], off)
    return tk.hash_spans(tk.lower_ascii(buf), starts, ends), tk.rows_of(starts, off)


@dataclass(frozen=True)
class Machine:
    bias: float
    terms: np.ndarray    # uint64, ascending
    weights: np.ndarray  # float32, per term
    factors: np.ndarray  # float32, (terms, FACTORS)

    def known(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, term number) pairs of the terms that the machine knows."""
        term, rows = terms(buf, off)
        if not len(self.terms) or not len(term):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        hit = self.terms[at] == term
        pair = np.unique(rows[hit] * len(self.terms) + at[hit])
        return np.divmod(pair, len(self.terms))

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        rows, at = self.known(buf, off)
        total = self.bias + np.bincount(rows, weights=self.weights[at], minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f].astype(float)
            total += 0.5 * (np.bincount(rows, weights=v, minlength=n) ** 2
                            - np.bincount(rows, weights=v * v, minlength=n))
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def fit(examples: list[tuple[float, np.ndarray]], visits: int = VISITS, alpha: float = 1.0,
        beta: float = 1.0, l1: float = 10.0, l2: float = 0.1, rate: float = 0.05,
        seed: int = 5) -> Machine:
    """Weights by FTRL-proximal, factors by AdaGrad, over (y, distinct term hashes) in the
    given order.  A term's factors take part while its weight is not zero, so the many
    terms without a bearing on the label stay out of every pair."""
    found, texts = np.unique(np.concatenate([np.zeros(0, tk.U64), *(t for _, t in examples)]),
                             return_counts=True)
    found = found[texts >= MIN_TEXTS]
    rng = np.random.default_rng(seed)
    z, n = np.zeros(len(found)), np.zeros(len(found))
    v, v_sq = rng.normal(0, 0.02, (len(found), FACTORS)), np.full((len(found), FACTORS), 1e-2)

    def weight(at: np.ndarray | slice) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi)
                        / ((beta + np.sqrt(n[at])) / alpha + l2))

    bias, bias_sq = 0.0, 1.0
    share = np.mean([y for y, _ in examples]) if examples else 0.0
    if 0 < share < 1:
        bias = float(np.log(share / (1 - share)))
        rows = []
        for y, t in examples:
            at = np.minimum(np.searchsorted(found, t), max(0, len(found) - 1))
            rows.append((y, at[found[at] == t] if len(found) else at[:0]))
        for _ in range(max(1, round(visits / len(rows)))):
            for y, at in rows:
                w = weight(at)
                on = at[w != 0]
                von = v[on]
                total = von.sum(axis=0)
                score = bias + w.sum() + 0.5 * (total @ total - (von * von).sum())
                g = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - y
                bias_sq += g * g
                bias -= rate * g / np.sqrt(bias_sq)
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
                n[at] += g * g
                gv = g * (total - von) + 1e-3 * von
                v_sq[on] += gv * gv
                v[on] -= rate * gv / np.sqrt(v_sq[on])
    w = weight(slice(None))
    on = w != 0
    return Machine(bias, found[on], w[on].astype(np.float32), v[on].astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
          text: str = "text", max_rows: int = 2 * TRAIN_ROWS) -> Machine:
    """Fit on a hash sample of at most about ``max_rows`` labelled documents, in one task
    that gets their term sets; the driver gets the machine's arrays."""
    tk.small_batches(docs.sparkSession)
    rows = training_rows(docs, labels, label, key, text, max_rows)

    def term_sets(batches):
        for batch in batches:
            for lo, hi, buf, off in tk.text_blocks(batch.column("text")):
                term, row = terms(buf, off)
                cuts = tk.group_bounds(row, len(off) - 1)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), part.column("order"),
                     pa.array([np.unique(term[a:b]).tobytes()
                               for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                    names=["y", "order", "terms"])

    def fit_all(batches):
        m = fit([(y, np.frombuffer(t, tk.U64)) for b in batches for y, _, t in
                 zip(*(c.to_pylist() for c in b.columns), strict=True)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.bias]), *(pa.array([a.tobytes()], pa.binary())
                                   for a in (m.terms, m.weights, m.factors))],
            names=["bias", "terms", "weights", "factors"])

    found = (rows.mapInArrow(term_sets, "y double, order long, terms binary")
             .repartition(1).sortWithinPartitions("order")
             .mapInArrow(fit_all, "bias double, terms binary, weights binary, factors binary")
             .collect())
    if not found:
        return fit([])
    r = found[0]
    return Machine(r["bias"], np.frombuffer(r["terms"], tk.U64),
                   np.frombuffer(r["weights"], np.float32),
                   np.frombuffer(r["factors"], np.float32).reshape(-1, FACTORS))


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """``key``, ``score`` (probability of toxic) and ``predicted`` of every row."""
    tk.small_batches(docs.sparkSession)
    rows = docs.select(key, text)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kind = rows.schema[key].dataType.simpleString()
    schema = pa.schema([(key, tk.arrow_type(rows, key)),
                        ("score", pa.float64())])
    scored = rows.mapInArrow(tk.map_blocks(
        lambda batch, buf, off: [batch.column(key), shared.value.scores(buf, off)], schema, text),
        f"`{key}` {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
             ) -> DataFrame:
    """Train on the labelled rows outside the held-out fold and score every row."""
    scored = score(docs, train(docs, labels, key=key, text=text), key, text)
    return scored.withColumn("held_out", id_remainder(key, 5) == 0)
