"""Operator 4, language identification by Kneser-Ney character models.

Each language has an interpolated Kneser-Ney model over characters
(lower-cased letters and apostrophes; everything else is one space), of
``order`` characters.  All models share sorted arrays of n-gram hashes, one
array an order, with a row of log-probabilities beside each hash, one
column a language, so a single binary search serves every language.  A text
gets the language with the lowest cross-entropy a character; the score is
the posterior of that language under a calibrated temperature.  A text whose
cross-entropy lies beyond the limit of its language is ``rejected``: its score
is the posterior times half the limit over the cross-entropy, so below 0.5.

The models are fitted on a bounded sample of labelled rows: of each
language the ``per_language`` documents with the smallest hash of their id
(whole texts).  Only rows with an id, a text and a language whose
``crc32(id) mod 5`` is not 0 are used.  Tasks count the n-grams; what the
driver gets are the counts of different n-grams.  Temperature and limits come
from all learnable rows that were not counted (a fifth of the ids is kept for
this, but in languages with fewer than ``FEW`` others): every text is scored
once and whole, the cross-entropies are written, and counts of them by
language and thousandth give the limits, the ``1 - beyond`` quantiles.

Defined results: a null text, and one without a letter, is ``und`` with
score 0, as is every text when nothing can be learned.  Rows with a null id
are scored and count as not held out.  Repeated ids are rows of their own; of
rows with equal id and language only the least text is counted.  Very long
texts are looked up in pieces, so memory does not grow with their number of
n-grams.  Ties go to the language first by name.  A language without a row to
calibrate on has no limit.  An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ship, slices

ORDER = 4
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)
_LETTER = re.compile(r"[^\W\d_]")
_CHUNK = 1 << 20                # characters looked up at a time
FEW = 8
_BINS = 1000                    # of cross-entropy, a nat
TEMPERATURES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point of each code point's lower case; space for all but letters and apostrophes."""
    table = np.full(0x110000, ord(" "), np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha() or s == "'":
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def symbols(text: str) -> np.ndarray:
    """Folded code points between single spaces, with a space at either end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    folded = np.concatenate([[32], _folded()[np.minimum(points, 0x10FFFF)], [32]]).astype(np.uint64)
    space = folded == 32
    return folded[~(space & np.concatenate([[False], space[:-1]]))]


def _keys(chars: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` symbols that end at each of the positions ``at``."""
    key = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            key = (key ^ (chars[at - (n - 1) + k] * np.uint64(_MIX[k]))) * np.uint64(_MIX[0])
            key ^= key >> np.uint64(29)
    return key


def _padded(parts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, ``pad`` spaces before each; the places of their symbols; where each text's places begin."""
    filled = [np.concatenate([np.full(pad, 32, np.uint64), p]) for p in parts]
    starts = np.cumsum([0, *(len(f) for f in filled)])[:-1]
    at = np.concatenate([np.arange(s + pad, s + len(f)) for s, f in zip(starts, filled)])
    return np.concatenate(filled), at, np.cumsum([0, *(len(p) for p in parts)])


# ------------------------------------------------------------- training ---
def counted(texts: list[str], order: int = ORDER) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A table for each n: different n-grams (hash), counts, hashes of their contexts and suffixes."""
    chars, at, _ = _padded([symbols(t) for t in texts], order - 1)
    tables: list[list[np.ndarray]] = [[] for _ in range(order)]
    for n in range(1, order + 1):
        pieces = []
        for a in range(0, len(at), _CHUNK):     # a long text's n-grams are counted piece by piece
            found, first, count = np.unique(_keys(chars, at[a:a + _CHUNK], n), return_index=True, return_counts=True)
            here = at[a:a + _CHUNK][first]
            pieces.append((found, count, _keys(chars, here - 1, n - 1), _keys(chars, here, n - 1)))
        found, first, group = np.unique(np.concatenate([x[0] for x in pieces]), return_index=True, return_inverse=True)
        tables[n - 1] = (found, np.bincount(group, np.concatenate([x[1] for x in pieces])),
                         *(np.concatenate([x[i] for x in pieces])[first] for i in (2, 3)))
    return tables


def _at(sorted_hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in a sorted array, and which are there."""
    at = np.minimum(np.searchsorted(sorted_hashes, wanted), max(0, len(sorted_hashes) - 1))
    return at, sorted_hashes[at] == wanted if len(sorted_hashes) else np.zeros(len(wanted), bool)


class _Level:
    """Interpolated probabilities of one order and language."""

    def __init__(self, grams, lower: "_Level | None", alphabet: int):
        self.hash, count, context, suffix = grams
        singles, doubles = (count == 1).sum(), (count == 2).sum()
        discount = singles / (singles + 2 * doubles) if singles and doubles else 0.5
        self.context, group = np.unique(context, return_inverse=True)
        total = np.bincount(group, count)
        self.backoff = discount * np.bincount(group) / total
        below = lower.of(suffix) if lower else np.full(len(count), 1 / alphabet)
        self.prob = np.maximum(count - discount, 0) / total[group] + self.backoff[group] * below
        self.floor = 1 / alphabet

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """Probabilities of n-grams counted here, or single symbols that may not be."""
        at, there = _at(self.hash, wanted)
        return np.where(there, self.prob[at], self.backoff[0] * self.floor)


def _levels(tables: list, alphabet: int) -> list[_Level]:
    """Kneser-Ney levels of one language, from order 1 up."""
    levels: list[_Level] = []
    for n, grams in enumerate(tables, 1):
        if n < len(tables):  # how many different symbols come before, instead of how often
            suffix, seen = np.unique(tables[n][3], return_counts=True)
            grams = (grams[0], seen[_at(suffix, grams[0])[0]].astype(float), *grams[2:])
        levels.append(_Level(grams, levels[-1] if levels else None, alphabet))
    return levels


class LanguageModels:
    """Sorted n-gram hashes of all languages, with log-probabilities beside them."""

    def __init__(self, counts: dict[str, list]):
        """``counts``: tables like those of ``counted`` for each language."""
        self.names = sorted(counts)
        self.order = len(counts[self.names[0]])
        tables = [counts[k] for k in self.names]
        alphabet = 1 + len(np.unique(np.concatenate([t[0][0] for t in tables])))
        per = [_levels(t, alphabet) for t in tables]
        self.hashes, self.logs, self.backoffs = [], [], []
        # symbols that no language has share the place of one symbol, a thousand to it
        self.floor = float(np.log(1e-3 / alphabet))
        shorter: np.ndarray | None = None
        for n in range(1, self.order + 1):
            found, first = np.unique(np.concatenate([t[n - 1][0] for t in tables]), return_index=True)
            context, suffix = (np.concatenate([t[n - 1][i] for t in tables])[first] for i in (2, 3))
            if shorter is None:
                probs = np.stack([levels[0].of(found) for levels in per], axis=1)
            else:
                at, _ = _at(self.hashes[-1], suffix)
                below = shorter[at]     # the suffix of a counted n-gram is counted too
                probs = np.empty((len(found), len(per)))
                for i, levels in enumerate(per):
                    level = levels[n - 1]
                    at, there = _at(level.hash, found)
                    c, known = _at(level.context, context)
                    weight = np.where(known, level.backoff[c], 1.0)
                    probs[:, i] = np.where(there, level.prob[at], weight * below[:, i])
            self.hashes.append(found)
            self.logs.append(np.log(np.maximum(probs, 1e-12)).astype(np.float32))
            # weights of contexts, for n-grams that no language has
            contexts = np.unique(context) if n > 1 else np.zeros(1, np.uint64)
            weights = np.zeros((len(contexts), len(per)), np.float32)
            for i, levels in enumerate(per):
                c, known = _at(levels[n - 1].context, contexts)
                weights[:, i] = np.log(np.maximum(np.where(known, levels[n - 1].backoff[c], 1.0), 1e-12))
            self.backoffs.append((contexts, weights))
            shorter = probs
        self.temperature, self.limits = 1.0, np.full(len(self.names), np.inf)

    def _log_probs(self, chars: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
        """Log-probabilities of the symbols at positions ``at``, given up to ``n - 1`` before."""
        if n == 0:
            return np.full((len(at), len(self.names)), self.floor, np.float32)
        key = _keys(chars, at, n)
        place, there = _at(self.hashes[n - 1], key)
        out = self.logs[n - 1][place]
        if not there.all():
            gap = np.flatnonzero(~there)
            low = self._log_probs(chars, n - 1, at[gap])
            contexts, weights = self.backoffs[n - 1]
            c, known = _at(contexts, _keys(chars, at[gap] - 1, n - 1))
            low = low + np.where(known[:, None], weights[c], 0)
            out[gap] = low
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy a character of each text under each language."""
        parts = [symbols(t) for t in texts]
        out = np.zeros((len(texts), len(self.names)))
        pad = self.order - 1
        group: list[int] = []
        size = 0
        for i, chars in enumerate(parts):
            group.append(i)
            size += len(chars)
            if size >= _CHUNK or i == len(parts) - 1:
                # texts of a group are looked up together, spaces between them
                chars_, at, first = _padded([parts[g] for g in group], pad)
                sums = np.zeros((len(group), len(self.names)))
                for a in range(0, len(at), _CHUNK):
                    logs = self._log_probs(chars_, self.order, at[a:a + _CHUNK]).astype(np.float64)
                    cuts = np.clip(first - a, 0, len(logs))
                    run = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0)])
                    sums += run[cuts[1:]] - run[cuts[:-1]]
                out[group] = -sums / np.maximum(np.diff(first), 1)[:, None]
                group, size = [], 0
        return out

    def calibrate(self, bins: dict[int, dict[int, int]], losses: dict[int, int], beyond: float) -> None:
        """Limits by quantile from counts of cross-entropies, the temperature of the least loss."""
        for i, counts in bins.items():
            places = sorted(counts)
            reached = np.cumsum([counts[b] for b in places])
            self.limits[i] = (places[int(np.searchsorted(reached, (1 - beyond) * reached[-1]))] + 1) / _BINS
        if losses:
            self.temperature = TEMPERATURES[min(losses, key=lambda t: (losses[t], t))]

    def posteriors(self, entropies: np.ndarray, temperature: float | None = None) -> np.ndarray:
        z = -entropies / (temperature or self.temperature)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, entropies: np.ndarray) -> list[tuple[str, float, float, bool]]:
        """``(language, score, cross-entropy, rejected)`` of rows of cross-entropies."""
        best, p = entropies.argmin(axis=1), self.posteriors(entropies)
        out = []
        for row, b in enumerate(best.tolist()):
            h, score, limit = float(entropies[row, b]), float(p[row, b]), float(self.limits[b])
            out.append((self.names[b], score * limit / (2 * h) if h > limit else score, h, h > limit))
        return out


# ---------------------------------------------------------------- Spark ---
def fold(doc_id: Column) -> Column:
    """Remainder that decides whether a document may be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def _learnable() -> Column:
    return F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 0)


def fit(docs: DataFrame, per_language: int = 400, order: int = ORDER) -> tuple[LanguageModels | None, Column]:
    """Models from ``per_language`` documents of each language, and the condition of the rows that were counted."""
    h = F.xxhash64("doc_id")
    kept_back = F.pmod(F.shiftright(h, 8), F.lit(5)) == 0
    # a letter and no letter in Java are told apart nearly as in Python; texts without one add spaces only
    usable = docs.select("doc_id", "text", "lang").filter(_learnable() & F.col("text").rlike("\\p{L}"))
    # ranks are taken in 16 salted parts first, so no task ranks a whole language
    rank = usable.select("doc_id", "lang", kept_back.alias("_late"), h.alias("_h")).withColumn("_s", F.pmod("_h", F.lit(16)))
    for keys in (["lang", "_late", "_s"], ["lang", "_late"]):
        rank = (rank.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_h", "doc_id")))
                .filter(F.col("_n") <= per_language))
    late = F.col("_late")
    bounds = rank.groupBy("lang").agg(F.count(F.when(~late, 1)).alias("n"), F.max(F.when(~late, F.col("_h"))).alias("early"),
                                      F.max(F.when(late, F.col("_h"))).alias("late")).collect()     # a row a language
    if not bounds:
        return None, F.lit(False)

    def bound(values: dict[str, int | None]) -> Column:
        pairs = [F.lit(x) for k, v in values.items() for x in (k, v) if v is not None]
        return F.coalesce(h <= F.element_at(F.create_map(*pairs), F.col("lang")), F.lit(False)) if pairs else F.lit(False)

    was_counted = _learnable() & F.when(kept_back, bound({r["lang"]: r["late"] for r in bounds if r["n"] < FEW})).otherwise(
        bound({r["lang"]: r["early"] for r in bounds}))
    sample = usable.filter(was_counted).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            texts: dict[str, list[str]] = {}
            for lang, text in zip(*(part.column(c).to_pylist() for c in (0, 1))):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                for n, (found, times, context, suffix) in enumerate(counted(own, order), 1):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found)), pa.array(np.full(len(found), n, np.int32)),
                         *(pa.array(x.view(np.int64)) for x in (found, context, suffix)), pa.array(times.astype(np.int64))],
                        names=["lang", "n", "hash", "context", "suffix", "times"])

    grams = (sample.mapInArrow(count, "lang string, n int, hash long, context long, suffix long, times long")
             .groupBy("lang", "n", "hash").agg(F.sum("times").alias("times"), F.min("context").alias("context"), F.min("suffix").alias("suffix")))
    tables: dict[str, list] = {}
    got = grams.toArrow().to_pandas()       # different n-grams of the sample
    for (lang, n), part in got.groupby(["lang", "n"]):
        columns = {c: part[c].to_numpy() for c in ("hash", "times", "context", "suffix")}
        found = columns["hash"].astype(np.int64).view(np.uint64)
        by = np.argsort(found)
        tables.setdefault(lang, [None] * order)[n - 1] = (
            found[by], columns["times"].astype(float)[by], *(columns[c].astype(np.int64).view(np.uint64)[by] for c in ("context", "suffix")))
    return (LanguageModels(tables) if tables else None), was_counted


def identify(docs: DataFrame, beyond: float = 0.001, **fit_options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, cross_entropy, rejected`` of every row."""
    ship(docs.sparkSession)
    models, was_counted = fit(docs, **fit_options)
    kind = docs.schema["doc_id"].dataType.simpleString()
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    result = f"doc_id {kind}, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"
    if models is None:
        return docs.select("doc_id", held_out, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("rejected"))
    names = models.names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(3).to_pylist()
            with_letter = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
            found: list = [None] * len(texts)
            for i, h in zip(with_letter, models.entropies([texts[i] for i in with_letter]).tolist() if with_letter else ()):
                found[i] = h
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(found, pa.list_(pa.float64()))],
                                             names=["doc_id", "held_out", "lang", "h"])

    # the language goes along for calibration only
    lang = F.when(_learnable() & ~was_counted & F.col("lang").isin(names), F.col("lang")).alias("lang")
    scored, _ = materialize(docs.select("doc_id", held_out, lang, "text")
                            .mapInArrow(score, f"doc_id {kind}, held_out boolean, lang string, h array<double>"), "entropies")

    def matrix(column: pa.Array) -> np.ndarray:
        return column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = matrix(batch.column(1))
            own = np.array([names.index(x) for x in batch.column(0).to_pylist()], np.int64)
            rows = []
            if len(h):
                places = np.floor(h[np.arange(len(h)), own] * _BINS).astype(np.int64)
                pairs, times = np.unique(np.stack([own, places], axis=1), axis=0, return_counts=True)
                rows = [(int(a), int(b), int(n)) for (a, b), n in zip(pairs, times)]
                for t, temperature in enumerate(TEMPERATURES):      # losses in millionths, so sums are exact
                    p = models.posteriors(h, temperature)[np.arange(len(h)), own]
                    rows.append((-1, t, int(np.rint(-np.log(np.maximum(p, 1e-12)) * 1e6).sum())))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["a", "b", "n"])

    # at most a row a language and thousandth
    tallied = (scored.filter(F.col("lang").isNotNull() & F.col("h").isNotNull()).select("lang", "h")
               .mapInArrow(tally, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect())
    bins: dict[int, dict[int, int]] = {}
    for a, b, n in tallied:
        bins.setdefault(a, {})[b] = n
    models.calibrate({a: v for a, v in bins.items() if a >= 0}, bins.get(-1, {}), beyond)
    # only what the verdicts need goes along
    verdicts = LanguageModels.__new__(LanguageModels)
    verdicts.names, verdicts.limits, verdicts.temperature = names, models.limits, models.temperature

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            out: list = [("und", 0.0, None, False)] * batch.num_rows
            for i, x in zip(np.flatnonzero(known).tolist(), verdicts.predict(matrix(batch.column(2)))):
                out[i] = x
            got = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got[0], pa.string()), pa.array(got[1], pa.float64()),
                 pa.array(got[2], pa.float64()), pa.array(got[3], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"])

    return scored.select("doc_id", "held_out", "h").mapInArrow(decide, result)
