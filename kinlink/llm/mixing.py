"""Operator 10, mixing to target weights by soft membership.

A softmax classifier, fitted on the labelled table, gives every document a
posterior over domains.  Document rates ``r >= 0`` are then sought so that
the expected tokens of domain ``d``, the sum of ``r * tokens * p_d`` over
all documents, match ``target_d``.  This is least squares, each residual
weighted by the domain's tokens at rate 1, solved by projected gradients from
``r = 1`` in their lazy form: the steps ``s`` are summed up, and the sum is
projected once,

    r = max(0, 1 - sum_d p_d * s_d)

so that a document's rate follows from its own posterior and one number a
domain, whatever the number of rounds.  Of all rates that reach the least
squares these are the ones nearest to 1, token by token.  A round is one
aggregation over all documents: it sums the expected totals (the gradient)
and the joint posterior tokens of the documents whose rate is above 0, in
whose metric the next step is taken; a step that does not lower the convex
function whose gradient this is, is shortened, with several lengths tried in the
same round, and damped if none helps.  A small pull towards rate 1, lowered
as rounds go on, keeps the steps unique.

Rounds end when the duality gap, which bounds how far the squares are from
those of the best nonnegative rates, is at most ``close`` of all tokens (an
expected share is then off by at most the root of twice that).  If it cannot
be brought there, that is an error; no rates are returned that fall short.

The classifier is fitted on a bounded sample: the ``max_labelled`` labelled
documents with the smallest hash of their id.  It sees the ``max_features``
hashed words that tell the domains apart best in that sample, and shares of
signs.  Tokens, expected totals and rates cover all documents.

Defined results: null and empty texts have no tokens, the posterior of a
text without words, and a rate like others.  Null and repeated ids are rows
of their own; equal ids round alike.  Ids with contradicting labels, and
null labels, do not take part in the fit.  Targets of domains that no
labelled document has are shared out over the others; without any labelled
document there is one domain, ``all``, and every rate is the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import materialize
from .common import free_name, ship, slices
from .iforest_rules import labelled_sample

BUCKETS = 1 << 16
_UPPER = bytes(range(65, 91))


# ------------------------------------------------------------ classifier --
def buckets_of(data: bytes) -> np.ndarray:
    """Hashed distinct words of a text, sorted."""
    words = set(data.lower().split())
    return np.unique(np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % BUCKETS)


def signs_of(data: bytes) -> list[float]:
    """Shares of symbols, capitals and exclamation marks, on a logarithmic scale."""
    n = max(1, len(data))
    symbols = sum(map(data.count, b"#*$%&|<>"))
    return np.log1p(100 * np.array([symbols, n - len(data.translate(None, _UPPER)) if data else 0, data.count(b"!")]) / n).tolist()


class DomainModel:
    """Softmax regression on chosen hashed words and sign shares."""

    def __init__(self, domains: list[str], chosen: np.ndarray):
        self.domains, self.chosen = domains, np.sort(chosen)
        self.weights = np.zeros((len(chosen) + 4, len(domains)))
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[self.chosen] = np.arange(len(chosen))

    def row(self, data: bytes) -> np.ndarray:
        x = np.zeros(len(self.chosen) + 4)
        at = self.place[buckets_of(data)]
        x[at[at >= 0]] = 1
        x[-4:] = [*signs_of(data), 1]
        return x

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 300, ridge: float = 1e-3) -> None:
        onehot = np.eye(len(self.domains))[y]
        pace = 4 * len(x) / max(1e-9, np.linalg.norm(x, 2) ** 2)
        w = ahead = self.weights
        for k in range(rounds):  # accelerated gradient descent
            new = ahead - pace * (x.T @ (_softmax(x @ ahead) - onehot) / len(x) + ridge * ahead)
            w, ahead = new, new + k / (k + 3) * (new - w)
        self.weights = w

    def posteriors(self, texts: list[str | None]) -> np.ndarray:
        rows = [self.row((t or "").encode("utf-8", "surrogatepass")) for t in texts]
        return _softmax(np.array(rows) @ self.weights)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, labelled: DataFrame, max_labelled: int = 6000, max_features: int = 256) -> DomainModel:
    """Model from ``labelled`` (``doc_id``, ``domain``)."""
    spark = docs.sparkSession
    ship(spark)
    chosen = labelled_sample(labelled, "domain", max_labelled)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([buckets_of(d).astype(np.int32) for d in data], pa.list_(pa.int32())),
                 pa.array([signs_of(d) for d in data], pa.list_(pa.float64()))], names=["doc_id", "buckets", "signs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # bounded by max_labelled rows, so this side may be broadcast
    seen = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "text").mapInArrow(words, f"doc_id {kind}, buckets array<int>, signs array<double>")
            .join(F.broadcast(chosen), "doc_id"))
    one = F.max(F.struct(F.col("_label").alias("domain"), "buckets", "signs")).alias("one")     # of rows with the same id
    seen, _ = materialize(seen.groupBy("doc_id").agg(one).select("doc_id", "one.*"), "domains")
    sizes = {r[0]: r[1] for r in seen.groupBy("domain").count().collect()}  # one row a domain
    domains = sorted(sizes)
    if not domains:
        return DomainModel(["all"], np.zeros(0, np.int64))
    # at most BUCKETS rows a domain
    counts = np.zeros((len(domains), BUCKETS))
    for bucket, domain, n in seen.select("domain", F.explode("buckets").alias("b")).groupBy("b", "domain").count().collect():
        counts[domains.index(domain), bucket] = n
    of = np.array([sizes[d] for d in domains], float)
    total, share = counts.sum(axis=0), of[:, None] / of.sum()
    surprise = (counts - share * total) / np.sqrt(np.maximum(share * (1 - share) * total, 1))
    best = np.argsort(-np.abs(surprise).max(axis=0), kind="stable")[:max_features]
    model = DomainModel(domains, best)
    place = F.array_sort(F.array_intersect("buckets", F.array(*map(F.lit, model.chosen.astype(int).tolist()))))
    rows = seen.orderBy("doc_id").select(place.alias("b"), "signs", "domain").collect()  # max_labelled short rows
    x = np.zeros((len(rows), len(best) + 4))
    for i, (b, signs, _) in enumerate(rows):
        x[i, model.place[b]] = 1
        x[i, -4:] = [*signs, 1]
    model.fit(x, np.array([domains.index(r[2]) for r in rows]))
    return model


# ----------------------------------------------------------------- rates --
def _added(docs: DataFrame, model: DomainModel, tokens: str, names: list[str]) -> DataFrame:
    """``docs`` with word counts and one posterior column a domain."""
    ship(docs.sparkSession)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(text).to_pylist()
            n = [len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), *map(pa.array, model.posteriors(texts).T.copy())],
                                             names=[*part.schema.names, tokens, *names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(tokens, LongType()),
                                            *(StructField(n, DoubleType()) for n in names)]))


def rate(steps: list[float], names: list[str]) -> Column:
    """A document's rate after the summed steps, from its posteriors."""
    down = sum((F.col(n) * F.lit(float(s)) for n, s in zip(names, steps)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - down)


#: Lengths of a step that one round tries.
LENGTHS = 0.5 ** np.arange(12)


def _round(at: np.ndarray, step: np.ndarray, total: float):
    """Arrow helper: a task's part of what a round sums, one row a number, for each length of the step.

    Per length: half the squared rates, smallest ``p . s``, expected totals,
    joint tokens of documents with a rate above 0 (all by tokens).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(at)
        sums, least = np.zeros((len(LENGTHS), 1 + k + k * k)), np.full(len(LENGTHS), np.inf)
        for batch in batches:
            t = batch.column(0).to_numpy(zero_copy_only=False) / total
            p = np.stack([batch.column(1 + d).to_numpy(zero_copy_only=False) for d in range(k)], axis=1)[t > 0]
            t = t[t > 0]
            if not len(t):
                continue
            for i, length in enumerate(LENGTHS if step.any() else LENGTHS[:1]):
                down = p @ (at + length * step)
                r = np.maximum(0, 1 - down)
                held = p * np.where(r > 0, t, 0)[:, None]
                sums[i] += np.concatenate([[t @ r ** 2 / 2], p.T @ (t * r), (held.T @ p).ravel()])
                least[i] = min(least[i], down.min())
        n = sums.size
        yield pa.RecordBatch.from_arrays([pa.array(range(n + len(LENGTHS)), pa.int32()), pa.array(np.concatenate([sums.ravel(), least]))],
                                         names=["i", "x"])

    return run


def solve(rows: DataFrame, tokens: str, names: list[str], weights: list[float], close: float = 1e-8) -> list[float]:
    """Summed steps, one a domain, that lead to the best rates.

    ArithmeticError if the duality gap does not come down to ``close``.
    """
    k = len(names)
    first = rows.agg(*(F.coalesce(F.sum(F.col(tokens) * F.col(n)), F.lit(0.0)) for n in names)).first()
    at_one = np.array(first, float)
    total = at_one.sum()
    if not total:
        return [0.0] * k
    want, w = np.array(weights), np.maximum(at_one / total, 1e-6)
    narrow = rows.select(F.col(tokens).cast("double").alias("t"), *names)

    def look(at, step):
        """Per length: half squares, smallest ``p . s``, totals, joint tokens."""
        run = _round(at, step, total)
        both = F.struct(F.sum("x").alias("sum"), F.min("x").alias("least"))
        got = {r["i"]: r["x"] for r in narrow.mapInArrow(run, "i int, x double").groupBy("i").agg(both.alias("x")).collect()}
        size, n = 1 + k + k * k, len(LENGTHS)
        for i in range(n if step.any() else 1):
            x = np.array([got[i * size + j]["sum"] for j in range(size)])
            yield x[0], got[n * size + i]["least"], x[1:1 + k], x[1 + k:].reshape(k, k)

    def value(at, half):
        """The convex function whose slope is target minus total, with the pull."""
        return half + at @ want + pull / 2 * (w @ at ** 2)

    pull, damp, at, step = 1e-2, 0.0, np.zeros(k), np.zeros(k)
    seen = None
    while True:
        tried = [(value(at + length * step, x[0]), length, x) for length, x in zip(LENGTHS, look(at, step))]
        new, length, x = min(tried, key=lambda y: y[0])
        better = seen is None or new < value(at, seen[0])
        if better:
            at, seen = at + length * step, x
            damp = damp / 16 if length == 1 else damp
        half, least, totals, joint = seen
        off = totals - want
        feasible = pull * at + max(0.0, -pull * least)          # a point of the dual problem: its value is a lower bound
        gap = ((off ** 2 / w).sum() + w @ feasible ** 2) / 2 + want @ feasible
        if gap <= close:
            return at.tolist()
        slope, metric = want + pull * w * at - totals, joint + pull * np.diag(w)
        if slope @ np.linalg.solve(metric, slope) < 1e-4 * abs(close) or not better and damp > 1e6:
            if pull < 1e-13:
                raise ArithmeticError(f"the squares may be {gap} above the least, {close} was asked for")
            pull, damp = pull / 100, 0.0                        # the best rates under this pull are found
            slope, metric = want + pull * w * at - totals, joint + pull * np.diag(w)
        elif not better:
            damp = max(16 * damp, 1e-3 * pull)                  # shorter and more like a plain gradient
        step = -np.linalg.solve(metric + damp * np.diag(w), slope)


def _weights(model: DomainModel, targets: Mapping[str, float]) -> list[float]:
    known = [max(0.0, float(targets.get(d, 0.0))) for d in model.domains]
    return [k / sum(known) for k in known] if sum(known) else [1 / len(known)] * len(known)


def copies(rates: Column) -> Column:
    """Whole copies whose mean over ids is the rate."""
    share = F.pmod(F.xxhash64(F.lit("copies"), F.col("doc_id")), F.lit(1 << 32)) / F.lit(float(1 << 32))
    return F.floor(rates + share).cast("long")


def domain_rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], **fit_options) -> DataFrame:
    """``doc_id, n_tokens, domain, posterior, rate, copies`` of every row.

    ``posterior`` follows the domains' names in order.
    """
    model = fit(docs, labelled, **fit_options)
    names = [f"p{i}" for i in range(len(model.domains))]
    rows, _ = materialize(_added(docs.select("doc_id", "text"), model, "n_tokens", names).drop("text"), "posteriors")
    steps = solve(rows, "n_tokens", names, _weights(model, targets))
    best = F.array(*names)
    return (rows.withColumn("rate", rate(steps, names))
            .select("doc_id", "n_tokens",
                    F.element_at(F.array(*map(F.lit, model.domains)), F.array_position(best, F.array_max(best)).cast("int")).alias("domain"),
                    best.alias("posterior"), "rate", copies(F.col("rate")).alias("copies")))


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], **fit_options) -> DataFrame:
    """``docs`` with each row as often as its copies say; columns unchanged."""
    model = fit(docs, labelled, **fit_options)
    tokens = free_name(docs, "_tokens")
    names = [free_name(docs, f"_p{i}") for i in range(len(model.domains))]
    rows, _ = materialize(_added(docs, model, tokens, names), "mixed")
    steps = solve(rows, tokens, names, _weights(model, targets))
    # array_repeat of zero copies is empty, and explode then drops the row
    many = F.array_repeat(F.lit(True), copies(rate(steps, names)).cast("int"))
    mark = free_name(docs, "_copy")
    return rows.select(*docs.columns, F.explode(many).alias(mark)).drop(mark)
