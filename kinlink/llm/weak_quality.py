"""Operator 1, quality classifier from weak labels.

Overlapping heuristic labellers vote good (1), poor (-1) or abstain (0) on
each text; a fault labeller never votes good, as a text may have another
fault.  Expectation-maximisation over the counts of all vote patterns
in the corpus estimates how each labeller votes on good and on poor texts,
without any true label, and gives every pattern its posterior of being
good.  These posteriors then train a linear scorer over hashed features
(word shapes, repeats, size), which also grades texts on which the
labellers are silent or split.

The patterns are at most 3 to the number of labellers, so their counts go
to the driver whatever the corpus.  They cover all rows.  The scorer is
fitted on a bounded sample: the ``max_train`` rows with the smallest hash
of their id.

Defined results: null and empty texts vote as texts without words: poor for
shortness, silence for all else.  Rows with null or repeated ids are rows of
their own.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import least_hashed, ship, slices
from .iforest_rules import rule_counts

BUCKETS = 1 << 12

#: Fault labellers: a share of the text; poor from the second number on, up to
#: the first the text counts as free of the fault.
FAULTS = {
    "symbols": (0.002, 0.02),
    "capitals": (0.12, 0.3),
    "marks": (0.01, 0.1),
    "bars": (0.005, 0.1),
    "same_word": (0.03, 0.12),
    "repeated_windows": (0.1, 0.5),
    "repeated_lines": (0.05, 0.5),
}
MIN_WORDS, ENOUGH_WORDS = 20, 60

_SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 57 if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"a+|A+|9+")


def shares(text: str | None) -> tuple[int, list[float]]:
    """Number of words, and the share that each labeller looks at."""
    words, chars, symbols, dup, repeat, upper, marks, same = rule_counts(text)
    w, c = max(words, 1), max(chars, 1)
    lines = max(1, (text or "").count("\n") + 1)
    return words, [symbols / c, upper / c, marks / w, (text or "").count("|") / w, same / w, repeat / w, dup / lines]


def votes(words: int, values: list[float]) -> list[int]:
    """Votes of all labellers: each fault, shortness, then the ones that see good."""
    if not words:
        return [0] * len(FAULTS) + [-1, 0, 0]
    faults = [-1 if v >= poor else 0 for v, (_, poor) in zip(values, FAULTS.values())]
    free = [v <= good for v, (good, _) in zip(values, FAULTS.values())]
    return [*faults, -1 if words < MIN_WORDS else 1 if words >= ENOUGH_WORDS else 0,
            int(all(free[:4])),     # plain signs
            int(all(free[4:]))]     # no repetition


def hashed_features(text: str | None, words: int, values: list[float]) -> tuple[list[int], list[float]]:
    """Bucket and value of each feature: shape shares, steps of the shares, size."""
    shaped = _RUNS.sub(lambda m: m[0][:1], (text or "").encode("utf-8", "surrogatepass").translate(_SHAPE)).split()
    found = {b"shape " + k: (v / len(shaped)) ** 0.5 for k, v in Counter(shaped).items()}
    found[b"words %d" % min(12, words.bit_length())] = 1.0
    for name, v in zip(FAULTS, values):
        found[b"%s %d" % (name.encode(), int(min(8, np.ceil(np.log2(1 + 256 * v)))))] = 1.0
    out: dict[int, float] = {}
    for k, v in found.items():
        b = zlib.crc32(k) % BUCKETS
        out[b] = out.get(b, 0.0) + v
    return list(out), list(out.values())


# -------------------------------------------------------------------- EM --
class VoteModel:
    """Two classes, independent labellers: P(vote | class) and the share of good texts."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0):
        onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)    # pattern, labeller, vote
        # start: a pattern without a fault is good
        good = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
        for _ in range(rounds):
            weight = np.stack([1 - good, good]) * counts                                # class, pattern
            self.prior = (weight.sum(axis=1) + smooth) / (weight.sum() + 2 * smooth)
            seen = np.einsum("cp,pjv->cjv", weight, onehot) + smooth
            self.table = seen / seen.sum(axis=2, keepdims=True)                         # class, labeller, vote
            new = self.posterior(patterns)
            done = np.abs(new - good).max(initial=0) < 1e-9
            good = new
            if done:
                break

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that each pattern's text is good."""
        at = np.asarray(patterns, int) + 1
        logs = np.log(self.prior)[:, None] + np.log(self.table)[:, np.arange(at.shape[1]), at].sum(axis=2)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))

    @property
    def accuracies(self) -> np.ndarray:
        """How often each labeller is right when it votes."""
        right = self.prior[0] * self.table[0, :, 0] + self.prior[1] * self.table[1, :, 2]
        return right / np.maximum(right + self.prior[0] * self.table[0, :, 2] + self.prior[1] * self.table[1, :, 0], 1e-12)


def fit_scorer(rows: list[tuple], target: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Weights of the buckets and a constant, by logistic regression on soft labels; zeros without rows."""
    if not rows:
        return np.zeros(BUCKETS + 1)
    at = np.concatenate([np.asarray(r[0], np.int64) for r in rows])
    value = np.concatenate([np.asarray(r[1], float) for r in rows])
    of = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    w, ahead = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    pace = 4 / (1 + max(np.bincount(of, value ** 2, len(rows)).max(), 1e-9))
    for k in range(rounds):     # accelerated gradient descent
        z = np.bincount(of, value * ahead[at], len(rows)) + ahead[-1]
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - target) / len(rows)
        grad = np.append(np.bincount(at, value * off[of], BUCKETS), off.sum()) + ridge * ahead
        new = ahead - pace * grad
        w, ahead = new, new + k / (k + 3) * (new - w)
    return w


# ---------------------------------------------------------------- Spark ---
def quality_scores(docs: DataFrame, max_train: int = 8000) -> DataFrame:
    """``doc_id, votes, weak_label, score, kept`` of every row.

    ``votes``: one character a labeller (``+``, ``-`` or ``0``);
    ``weak_label``: the pattern's posterior of good; ``score``: the
    scorer's; ``kept``: score of one half or more.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            marks, at, value = [], [], []
            for text in part.column(1).to_pylist():
                words, values = shares(text)
                marks.append("".join("-0+"[v + 1] for v in votes(words, values)))
                a, v = hashed_features(text, words, values)
                at.append(a)
                value.append(v)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(marks, pa.string()), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(value, pa.list_(pa.float32()))], names=["doc_id", "votes", "buckets", "shares"])

    rows, _ = materialize(docs.select("doc_id", "text").mapInArrow(
        look, f"doc_id {kind}, votes string, buckets array<int>, shares array<float>"), "votes")
    pattern_counts = rows.groupBy("votes").count().orderBy("votes").collect()   # bounded by the number of patterns

    def numbers(marks: list[str]) -> np.ndarray:
        return np.array([["-0+".index(c) - 1 for c in m] for m in marks], int).reshape(len(marks), -1)

    if not pattern_counts:
        return rows.select("doc_id", "votes", F.lit(0.0).alias("weak_label"), F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    model = VoteModel(numbers([r[0] for r in pattern_counts]), np.array([r[1] for r in pattern_counts], float))
    label = {r[0]: float(p) for r, p in zip(pattern_counts, model.posterior(numbers([r[0] for r in pattern_counts])))}
    # ids may be null or repeated: rows are told apart by what they hold as well
    keyed = rows.withColumn("_key", F.xxhash64("doc_id", "votes", "buckets", "shares"))
    sample = least_hashed(keyed, "_key", max_train).select("buckets", "shares", "votes").collect()
    weights = fit_scorer([(r[0], r[1]) for r in sample], np.array([label[r[2]] for r in sample]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            marks = part.column(1).to_pylist()
            z = np.array([weights[-1] + np.dot(weights[np.asarray(a, np.int64)], v)
                          for a, v in zip(part.column(2).to_pylist(), part.column(3).to_pylist())])
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([label[m] for m in marks], pa.float64()),
                                              pa.array(p), pa.array(p >= 0.5)], names=["doc_id", "votes", "weak_label", "score", "kept"])

    return rows.mapInArrow(score, f"doc_id {kind}, votes string, weak_label double, score double, kept boolean")
