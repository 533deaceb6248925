"""Quality rules under weak supervision.

Every rule votes good or bad or abstains on a document's whole-text statistics.
Expectation-maximisation over the table of vote patterns (at most 3 ^ rules rows,
counted over all documents) estimates the share of good documents, the share of each
rule's fault and, per class, how often every rule votes bad.  The posterior probability of
good, not all-must-pass, decides: the lone vote of a rule that also votes at random on
documents with other faults is outvoted.  ``fit`` is the plainer form with one bad class.

Defined cases: null and empty texts have no words and all counts 0; a text without
words gets only the length rule's vote and fails the base checks; an empty table gives
an empty result (the model is then its prior); repeated rows and ids are scored row by
row; a null id is carried along; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import textkit as tk

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "n_lines", "n_upper", "n_letters", "n_distinct"]
WINDOW = 5

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(97, 123)) | (np.arange(256) >= 0xC3)
_POINT = (np.arange(256) & 0xC0) != 0x80  # the first byte of a code point


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""
    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 5", "n_words >= 40"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2.5 * n_words OR word_chars > 12 * n_words)",
         "word_chars BETWEEN 3.5 * n_words AND 9 * n_words AND n_words > 0"),
    Rule("symbols", "10 * n_symbols > n_words", "n_words >= 5 AND 50 * n_symbols <= n_words"),
    Rule("line_repeats", "n_dup_lines >= 2 AND 10 * n_dup_lines > 3 * n_lines",
         "n_lines >= 2 AND 10 * n_dup_lines <= n_lines"),
    Rule("word_windows", "100 * n_repeat_words > 20 * n_words",
         "n_words >= 10 AND 100 * n_repeat_words <= 5 * n_words"),
    Rule("capitals", "2 * n_upper > n_letters", "n_letters > 0 AND 10 * n_upper <= 2 * n_letters"),
    Rule("variety", "n_words >= 30 AND 5 * n_distinct < n_words AND 2 * n_repeat_words > n_words",
         "n_words >= 10 AND 5 * n_distinct >= n_words"),
)


def _in_duplicates(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _distinct_per_row(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each row; ``keys`` already tell rows apart."""
    _, first = np.unique(keys, return_index=True)
    return np.bincount(rows[first], minlength=n)


def block_metrics(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The METRICS of every row of a block."""
    n = len(off) - 1
    space = tk.IS_SPACE[buf]

    def per_row(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flag, dtype=np.int64)][off])

    starts, ends = tk.words(buf, off)
    rows = tk.rows_of(starts, off)
    word = tk.hash_spans(buf, starts, ends)
    row_key = tk.mix(np.arange(n, dtype=tk.U64) + tk.U64(1))
    own_word = tk.mix(word ^ row_key[rows])

    repeated = np.zeros(len(word), bool)
    if len(word) >= WINDOW:
        inside = rows[:-WINDOW + 1] == rows[WINDOW - 1:]
        window = tk.hash_runs(own_word, WINDOW)[inside]
        hit = np.flatnonzero(inside)[_in_duplicates(window)]
        edge = np.zeros(len(word) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + WINDOW, -1)
        repeated = np.cumsum(edge)[:-1] > 0

    l_start, l_end = tk.runs(buf != 10, off)
    solid = np.r_[0, np.cumsum(~space, dtype=np.int64)]
    with_word = solid[l_end] > solid[l_start]
    l_start, l_end = l_start[with_word], l_end[with_word]
    l_row = tk.rows_of(l_start, off)
    line = tk.mix(tk.hash_spans(buf, l_start, l_end) ^ row_key[l_row])
    n_lines = np.bincount(l_row, minlength=n)

    return [np.bincount(rows, minlength=n), per_row(_POINT[buf] & ~space), per_row(_SYMBOL[buf]),
            n_lines - _distinct_per_row(line, l_row, n),
            np.bincount(rows[repeated], minlength=n), n_lines,
            per_row(_UPPER[buf]), per_row(_LETTER[buf]),
            _distinct_per_row(own_word, rows, n)]


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and METRICS of every whole text."""
    tk.small_batches(docs.sparkSession)
    rows = docs.select(key, text)
    fields = [pa.field(m, pa.int64()) for m in METRICS]
    schema = pa.schema([pa.field(key, tk.arrow_type(rows, key)), *fields])
    ddl = ", ".join([f"`{key}` {rows.schema[key].dataType.simpleString()}",
                     *(f"{m} bigint" for m in METRICS)])
    return rows.mapInArrow(tk.map_blocks(
        lambda batch, buf, off: [batch.column(key), *block_metrics(buf, off)], schema, text), ddl)


def votes(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """A column per rule: 1 good, 0 bad, -1 abstains."""
    return [F.when(F.expr(r.bad), 0).when(F.expr(r.good), 1).otherwise(-1).alias(f"vote_{r.name}")
            for r in rules]


@dataclass(frozen=True)
class VoteModel:
    """``good`` = P(good); ``right[c, r]`` = P(rule r votes c | class c, r votes)."""
    good: float
    right: np.ndarray


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200,
        false_alarms: float = 0.001, trust: float = 20.0) -> VoteModel:
    """EM over distinct vote patterns (``-1`` abstains) and how many documents have each.

    Bad documents are bad in one way each, so a rule may miss most of them, but it is
    written to spare good ones: ``false_alarms`` is the prior mean of its bad votes on good
    documents, weighed as ``trust`` votes per document.  Without it EM takes the commonest
    fault for the whole bad class and the votes on all other faults for errors."""
    n_rules = patterns.shape[1]
    model = VoteModel(0.8, np.stack([np.full(n_rules, 0.3), np.full(n_rules, 1 - false_alarms)]))
    if not len(patterns):
        return model
    counts = counts.astype(float)
    prior = trust * counts.sum()
    for _ in range(rounds):
        p = posterior(model, patterns)
        right = np.empty((2, n_rules))
        for cls, weight, said, seen in ((0, counts * (1 - p), 0.6, 2.0),
                                        (1, counts * p, prior * (1 - false_alarms) + 1.6, prior + 2.0)):
            agree = weight @ (patterns == cls)
            cast = weight @ (patterns >= 0)
            right[cls] = (agree + said) / (cast + seen)
        new = VoteModel(float((counts @ p + 8) / (counts.sum() + 10)),
                        np.clip(right, [[0.05], [0.5]], 0.9999))
        moved = abs(new.good - model.good) + np.abs(new.right - model.right).max()
        model = new
        if moved < 1e-9:
            break
    return model


def log_odds(model: VoteModel) -> tuple[float, np.ndarray]:
    """Prior log odds of good, and each rule's addition for a bad and for a good vote."""
    bad, good = model.right
    return float(np.log(model.good / (1 - model.good))), np.log(
        np.stack([(1 - good) / bad, good / (1 - bad)]))


def posterior(model: VoteModel, patterns: np.ndarray) -> np.ndarray:
    prior, weight = log_odds(model)
    odds = prior + ((patterns == 0) * weight[0] + (patterns == 1) * weight[1]).sum(axis=1)
    return 1 / (1 + np.exp(-odds))


#: Prior mean of a rule's bad votes outside its own fault, and how many votes it weighs.
NOISE, NOISE_VOTES = 0.01, 20.0


@dataclass(frozen=True)
class FaultModel:
    """``share[k]``: of class 0, the good documents, and of class r + 1, those with the fault
    that rule r is written for.  ``bad[k, r]``: how often rule r votes bad when it votes on a
    document of class k."""
    share: np.ndarray
    bad: np.ndarray


def _class_odds(model: FaultModel, patterns: np.ndarray) -> np.ndarray:
    """Log of share times likelihood of the votes, by pattern and class."""
    said_bad, said_good = (patterns == 0).astype(float), (patterns == 1).astype(float)
    return (np.log(model.share) + said_bad @ np.log(model.bad).T
            + said_good @ np.log(1 - model.bad).T)


def fault_posterior(model: FaultModel, patterns: np.ndarray) -> np.ndarray:
    """P(class | votes), by pattern and class; column 0 is the probability of good."""
    odds = _class_odds(model, patterns)
    p = np.exp(odds - odds.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit_faults(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> FaultModel:
    """EM over distinct vote patterns (``-1`` abstains) and how many documents have each.

    Bad documents are mostly bad in one way, so there is a class per rule besides the good
    one, and within a fault the other rules' rates are free: faults may go together.  All
    priors are a fixed number of votes, however many documents there are.

    From documents on which one rule alone votes bad the data cannot tell a fault from the
    rule's noise.  What tells them apart are documents with *other* faults: noise strikes
    these as often as good ones, a fault that excludes them does not.  A rule's false alarms
    on good documents are therefore its rate in that other fault's class which bounds it
    lowest (least rate plus two standard errors; classes with few votes bound nothing)."""
    n_rules = patterns.shape[1]
    own = np.arange(n_rules), np.arange(n_rules)
    share = np.r_[0.8, np.full(n_rules, 0.2 / n_rules)]
    bad = np.full((n_rules + 1, n_rules), NOISE)
    bad[1:][own] = 0.7
    model = FaultModel(share, bad)
    if not len(patterns):
        return model
    counts = counts.astype(float)
    said_bad, voted = (patterns == 0).astype(float), (patterns >= 0).astype(float)
    for _ in range(rounds):
        weight = fault_posterior(model, patterns) * counts[:, None]
        hits, votes_cast = weight.T @ said_bad, weight.T @ voted
        rate = (hits + NOISE * NOISE_VOTES) / (votes_cast + NOISE_VOTES)
        error = np.sqrt((rate * (1 - rate) + 1 / (votes_cast + 1)) / (votes_cast + 1))
        bound = (rate + 2 * error)[1:]
        bound[own] = np.inf
        bad = rate.copy()
        bad[1:][own] = np.clip((hits[1:][own] + 1.4) / (votes_cast[1:][own] + 2), 0.5, None)
        if n_rules > 1:
            bad[0] = rate[1:][bound.argmin(axis=0), np.arange(n_rules)]
        new = FaultModel((weight.sum(axis=0) + np.r_[8.0, np.full(n_rules, 2.0 / n_rules)])
                         / (counts.sum() + 10), np.clip(bad, 1e-4, 1 - 1e-4))
        moved = np.abs(new.share - model.share).max() + np.abs(new.bad - model.bad).max()
        model = new
        if moved < 1e-9:
            break
    return model


def good_probability(model: FaultModel, names: list[str]) -> Column:
    """``fault_posterior`` of good as a column over the vote columns ``names``."""
    prior, on_bad, on_good = np.log(model.share), np.log(model.bad), np.log(1 - model.bad)
    others = F.lit(0.0)
    for k in range(1, len(prior)):
        odds = F.lit(float(prior[k] - prior[0]))    # of the class against good
        for r, c in enumerate(names):
            odds = odds + (F.when(F.col(c) == 0, float(on_bad[k, r] - on_bad[0, r]))
                           .when(F.col(c) == 1, float(on_good[k, r] - on_good[0, r]))
                           .otherwise(0.0))
        others = others + F.exp(odds)
    return 1 / (1 + others)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``key``, METRICS, votes, ``posterior``, ``base_failed`` and ``kept`` of every row.

    The statistics are written once to the shared scratch folder: the vote table and the
    result both read them, not the texts."""
    spark = docs.sparkSession
    path = scratch_path(spark, "rule-metrics")
    measure(docs, key, text).select("*", *votes(rules)).write.parquet(path)
    measured = spark.read.parquet(path)
    names = [f"vote_{r.name}" for r in rules]
    table = measured.groupBy(*names).agg(F.count("*").alias("n")).collect()
    model = fit_faults(np.array([[r[c] for c in names] for r in table]).reshape(
        len(table), len(names)), np.array([r["n"] for r in table]))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (measured.withColumn("posterior", good_probability(model, names))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)))
