"""Operator 5, quality rules: an isolation forest over rule statistics.

Per text, simple rule counts are taken in one pass over the whole text.
An isolation forest (random splits of random statistics) gives each text a
mean path length; texts that few splits isolate are anomalous.  Signs,
repetition and length have a forest each, so that an unusual text of one
kind does not hide the other kinds.

The trees are fitted on a bounded sample: the ``max_labelled`` labelled
documents with the smallest hash of their id, and ``sample`` rows per tree.
The rejection thresholds are calibrated on all labelled rows that pass the
base rule: Spark counts their scores (in steps of 1 / ``GRID``) for good and
poor, and of the limits that reject at most ``max_false`` of the good rows
(rounded up to a row) the one is taken that leaves most between the rejected
shares of poor and of good rows; none if no limit rejects more of the poor.

Defined results: a null or empty text has zero counts, fails the base rule
(fewer than 20 words) and is not kept.  Null and repeated ids are kept as
they are (each row is judged alone).  Label rows with a null id or null
quality, and ids with contradicting qualities, do not take part in the
fit.  Without both good and bad labelled rows the forests reject nothing
and only the base rule acts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least_hashed, ship, slices

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_marks", "n_same")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
_UPPER = bytes(range(65, 91))


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a ``width``-word window found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + codes[j:j + n]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return 0
    at = np.flatnonzero(np.isin(key, twice)).tolist()
    # the hash only proposes windows; equality of the words decides
    seen = Counter(tuple(words[i:i + width]) for i in at)
    edge = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if seen[tuple(words[i:i + width])] > 1:
            edge[i] += 1
            edge[i + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def rule_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS + EXTRA of one whole text."""
    if not text:
        return (0,) * (len(COUNTS) + len(EXTRA))
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - sum(map(text.count, "\x20\x09\x0a\x0b\x0c\x0d"))
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_window_words(words), len(data) - len(data.translate(None, _UPPER)), text.count("!"),
            sum(map(eq, words, words[1:])))


def base_failed(n_words, n_repeat_words):
    """Fewer than 20 words, or more than 30 % of the words in repeated windows."""
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


#: Columns of ``features`` by group; each group has a forest and a threshold.
GROUPS = {"signs": slice(0, 3), "repetition": slice(3, 6), "length": slice(6, 8)}
#: Scores are compared with limits, and counted, in steps of 1 / GRID.
GRID = 4096


def features(counts: np.ndarray) -> np.ndarray:
    """Statistics the forests split on, from rows of COUNTS + EXTRA.

    Shares are taken on a logarithmic scale, so that a random split between
    "none" and "some" is as likely as one between "some" and "all"; so are
    the number of words and their mean length.
    """
    words, chars, symbols, dup, repeat, upper, marks, same = np.asarray(counts, np.float64).reshape(-1, 8).T
    w, c = np.maximum(words, 1), np.maximum(chars, 1)
    shares = np.column_stack([symbols / c, upper / c, marks / w, same / w, repeat / w, dup / w])
    return np.log1p(np.column_stack([100 * shares, words, chars / w]))


# ---------------------------------------------------------------- forest --
def _expected_depth(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


class IsolationForest:
    """Trees as flat arrays, so that a batch walks all of them at once."""

    def __init__(self, rows: np.ndarray, trees: int = 200, sample: int = 64, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.size = min(sample, len(rows))
        depth_limit = max(1, int(np.ceil(np.log2(max(2, self.size)))))
        nodes: list[list[float]] = []  # feature (-1: leaf), split, left, right, path length

        def grow(part: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, depth + _expected_depth(len(part))])
            varied = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else []
            if depth < depth_limit and len(varied):
                f = int(rng.choice(varied))
                split = float(rng.uniform(part[:, f].min(), part[:, f].max()))
                less = part[:, f] < split
                nodes[at][:4] = [f, split, grow(part[less], depth + 1), grow(part[~less], depth + 1)]
            return at

        self.roots = np.array([grow(rows[rng.choice(len(rows), self.size, replace=False)], 0) for _ in range(trees)])
        flat = np.array(nodes)
        self.feature, self.left, self.right = (flat[:, i].astype(np.int32) for i in (0, 2, 3))
        self.split, self.path, self.depth = flat[:, 1], flat[:, 4], depth_limit

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; the nearer to 1, the fewer splits isolate the row."""
        if not len(rows):
            return np.zeros(0)
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        for _ in range(self.depth):
            f = self.feature[at]
            value = np.take_along_axis(rows, np.maximum(f, 0), axis=1)
            at = np.where(value < self.split[at], self.left[at], self.right[at])
        return 2.0 ** (-self.path[at].mean(axis=1) / max(_expected_depth(self.size), 1e-9))


def limit(values: np.ndarray, good: np.ndarray, poor: np.ndarray, max_false: float) -> float:
    """The score above which rows are rejected, from the counts of good and poor rows of each value (ascending)."""
    if not good.sum() or not poor.sum():
        return float("inf")
    seen = good + poor > 0
    values, good, poor = values[seen], good[seen], poor[seen]
    over = [n.sum() - np.cumsum(n) for n in (good, poor)]      # rows above each value
    gain = np.where(over[0] <= np.ceil(max_false * good.sum() - 1e-9), over[1] / poor.sum() - over[0] / good.sum(), 0)
    best = np.flatnonzero(gain == gain.max())[-1] if gain.max() > 0 else -1
    return float(values[best]) if best >= 0 else float("inf")


def threshold(scores: np.ndarray, good: np.ndarray, max_false: float) -> float:
    """``limit`` of single rows."""
    values, at = np.unique(scores, return_inverse=True)
    return limit(values, np.bincount(at, good, len(values)), np.bincount(at, ~good, len(values)), max_false)


class Rules:
    """One forest and one calibrated threshold per group of statistics."""

    def __init__(self, counts: np.ndarray, trees: int, sample: int):
        x = features(counts)
        self.forests = {name: IsolationForest(x[:, cols], trees, sample) for name, cols in GROUPS.items()}
        self.limits = dict.fromkeys(GROUPS, float("inf"))

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Anomaly scores of each row, one column a group."""
        x = features(counts)
        return np.column_stack([self.forests[name].score(x[:, cols]) for name, cols in GROUPS.items()])

    def judge(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``base_failed``, ``kept`` and the largest anomaly score of each row."""
        failed, scores = base_failed(counts[:, 0], counts[:, 4]), self.scores(counts)
        kept = ~failed & (steps(scores) <= np.array([self.limits[name] for name in GROUPS])).all(axis=1)
        return failed, kept, scores.max(axis=1, initial=0)


def steps(scores: np.ndarray) -> np.ndarray:
    return np.floor(scores * GRID).astype(np.int64)


class BaseOnly:
    """Verdicts where no labelled row is to be had."""

    def judge(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        failed = base_failed(counts[:, 0], counts[:, 4])
        return failed, ~failed, np.zeros(len(counts))


# ---------------------------------------------------------------- Spark ---
def count_rules(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the rule counts of every row."""
    ship(docs.sparkSession)
    names = [*COUNTS, *EXTRA]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = np.array([rule_counts(t) for t in part.column(1).to_pylist()], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, got.T)], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names))


def consistent(labels: DataFrame, column: str) -> DataFrame:
    """``doc_id`` and label of the ids with one label."""
    return (labels.select("doc_id", F.col(column).alias("_label")).dropna()
            .groupBy("doc_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most"))
            .filter("_label = _most").drop("_most"))


def labelled_sample(labels: DataFrame, column: str, max_labelled: int) -> DataFrame:
    """``doc_id`` and label of a bounded sample of consistently labelled ids."""
    return least_hashed(consistent(labels, column), "doc_id", max_labelled)


def score_counts(docs: DataFrame, labels: DataFrame, rules: Rules) -> DataFrame:
    """``group, step, good, n``: counts of the scores of all labelled rows that pass the base rule."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = np.array([rule_counts(t) for t in part.column(1).to_pylist()], np.int64)
            judged = ~base_failed(got[:, 0], got[:, 4])
            ids = part.column(0).filter(pa.array(judged))
            yield pa.RecordBatch.from_arrays([ids, pa.array(list(steps(rules.scores(got[judged]))), pa.list_(pa.int64()))], names=["doc_id", "steps"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, steps array<long>").join(consistent(labels, "quality"), "doc_id")
    return (rows.select((F.col("_label") > 0).alias("good"), F.posexplode("steps").alias("group", "step"))
            .groupBy("group", "step", "good").agg(F.count("*").alias("n")))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000, max_false: float = 0.001,
        trees: int = 100, sample: int = 64) -> Rules | BaseOnly:
    """Forests from at most ``max_labelled`` labelled documents, thresholds from all of them."""
    chosen = labelled_sample(labels, "quality", max_labelled)
    # bounded by max_labelled rows, so this side may be broadcast
    rows = count_rules(docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"))
    rows = rows.groupBy("doc_id").agg(F.max(F.struct(*COUNTS, *EXTRA)).alias("c"))
    got = rows.orderBy("doc_id").select("c.*").collect()
    if not got:
        return BaseOnly()
    rules = Rules(np.array(got, np.float64), trees, sample)
    # bounded by groups, steps and two labels
    counts = np.array(score_counts(docs, labels, rules).select("group", "step", F.col("good").cast("long"), "n").collect(), np.int64).reshape(-1, 4)
    for k, name in enumerate(GROUPS):
        n = [np.bincount(c[:, 1], c[:, 3], GRID + 1) for c in (counts[(counts[:, 0] == k) & (counts[:, 2] == g)] for g in (1, 0))]
        rules.limits[name] = limit(np.arange(GRID + 1), *n, max_false)
    return rules


def quality_rules(docs: DataFrame, labels: DataFrame, **fit_options) -> DataFrame:
    """Counts, ``base_failed``, ``anomaly`` (0 to 1) and ``kept`` of every row."""
    ship(docs.sparkSession)
    rules = fit(docs, labels, **fit_options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = np.array([rule_counts(t) for t in part.column(1).to_pylist()], np.int64)
            failed, kept, score = rules.judge(got)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, got.T[:5]), pa.array(failed), pa.array(kept), pa.array(score)],
                names=["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_quality(docs: DataFrame, labels: DataFrame, **fit_options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    ship(docs.sparkSession)
    rules = fit(docs, labels, **fit_options)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = np.array([rule_counts(t) for t in part.column(text).to_pylist()], np.int64)
            yield part.filter(pa.array(rules.judge(got)[1]))

    return docs.mapInArrow(run, docs.schema)
