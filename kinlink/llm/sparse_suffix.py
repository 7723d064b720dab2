"""Operator 6, repeated passages by sparse suffix arrays.

A passage is a run of ``min_words`` words or more that also stands in
another document (``spans``), or at another place of the same text only
(``own_spans``).  The steps:

1. Of each text's suffixes only those at minimisers are retained: of every
   ``min_words - seed + 1`` neighbouring runs of ``seed`` words the one with
   the least hash, so a passage keeps the same suffixes wherever it stands,
   about one in thirteen.  Suffixes whose first words no other suffix
   has (by a 64-bit hash, which at worst keeps too many) go.
2. Each suffix that is left is written with the words that its windows of
   ``min_words`` words can reach: the *context*, from the seed to the right
   and from the seed to the left.  Equal contexts become one row.
3. Contexts are sorted twice over ranges: by the words to the right and by
   those to the left, read backwards.  Neighbours are compared word by word;
   how many words they share gives, for each length, the first row
   of the run of rows that agree so far.  Ranges have equal numbers of rows
   (the id breaks ties), so a frequent seed or passage is split; a range's
   first row is compared with the last one of the range before.
4. A context is extended by ``d`` words to the left and the rest to the
   right wherever both orders have a neighbour that goes as far.  Contexts
   of the same run in both orders have the same window; where these stand in
   two texts, or at two places of one, the window is repeated.  Windows that
   touch are joined to spans.

Each window has one minimiser, which its words alone decide, so no shared
window is missed, and each belongs to one context.  Equal texts (by a 64-bit
hash) count as one in these comparisons; a text that several rows have is a
passage as a whole.

Words are runs of anything but ASCII white space, compared exactly; words
of more than 64 bytes are compared by their SHA-256 digest, so a context
takes at most some 5 kB, however long the text.  A range's two outer rows
go to the driver: a table of two rows a range.

Defined results: null texts, empty texts and texts of fewer words than
``min_words`` have no spans.  Very long texts are handled whole.  Rows with
null or repeated ids are rows of their own.  An empty table gives an empty
result.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from ..session import materialize
from .common import ship, slices

_BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


# ---------------------------------------------------------------- helpers --
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Windows:
    """Rolling hashes of one text's words."""

    def __init__(self, text: str | None):
        self.words = text.encode("utf-8", "surrogatepass").split() if text else []
        self.n = len(self.words)
        codes = np.fromiter(map(xxh3_64_intdigest, self.words), np.uint64, self.n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(_BASE, self.n))])
        self.back = _powers(_INVERSE, self.n)

    def hashes(self, width: int) -> np.ndarray:
        """Hash of the ``width`` words from each place on."""
        m = max(0, self.n - width + 1)
        out = (self.sums[width:width + m] - self.sums[:m]) * self.back[:m]
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return out ^ (out >> np.uint64(29))

    def minimisers(self, seed: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Seed hashes, and the place of the minimiser of each window of ``min_words`` words."""
        seeds, span = self.hashes(seed), min_words - seed + 1
        if len(seeds) < span:
            return seeds, np.zeros(0, np.int64)
        view = np.lib.stride_tricks.sliding_window_view(seeds, span)
        return seeds, np.concatenate([view[a:a + 65536].argmin(axis=1) + np.arange(a, min(a + 65536, len(view)))
                                      for a in range(0, len(view), 65536)])


def _lists(rows: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([np.zeros(0, np.uint64), *rows]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(flat))


def _spelled(starts: set[int], min_words: int) -> tuple[str, int]:
    """``start:end`` of the joined windows, comma-joined, and the words in them."""
    spans: list[list[int]] = []
    for s in sorted(starts):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = s + min_words
        else:
            spans.append([s, s + min_words])
    return ",".join(f"{a}:{b}" for a, b in spans), sum(b - a for a, b in spans)


def _word(word: bytes) -> bytes:
    """The word, or a digest of a long one behind a tab, which no word holds."""
    return word if len(word) <= 64 else b"\t" + hashlib.sha256(word).hexdigest().encode()


def _context(words: list[bytes]) -> bytes:
    """Words that each end in a space, so that equal words make equal beginnings."""
    return b"".join([_word(w) + b" " for w in words])


def _common(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


# ---------------------------------------------------------------- Spark ---
_PLACES = ["low", "high", "first", "last", "least", "most"]


def _split(context: bytes) -> list[bytes]:
    return context[:-1].split(b" ") if context else []


def _depths() -> Column:
    """Words to the left of the seed, for each window of a context."""
    return F.sequence(F.col("least").cast("int"), F.col("most").cast("int"))


def _runs(contexts: DataFrame, words: str, skip: int, carried: list[str]) -> DataFrame:
    """``cid, heads, *carried`` of the contexts that agree with a neighbour.

    Contexts are sorted by ``seed`` and ``words``.  ``heads[n]`` is the first
    context of the run whose first ``skip + n`` words are this one's, for
    each ``n`` up to the most that a neighbour shares.
    """
    spark, order = contexts.sparkSession, ["seed", words, "cid"]
    ranged = contexts.select(*order, *carried).repartitionByRange(*order).sortWithinPartitions(*order)
    edge = pa.struct([("first", pa.bool_()), ("seed", pa.int64()), ("words", pa.binary()), ("reach", pa.int32())])
    schema = pa.schema([("cid", pa.int64()), ("heads", pa.list_(pa.int64())), ("part", pa.int32()), ("edge", edge),
                        ("final", edge), *((c, pa.int64()) for c in carried)])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, first_cid = TaskContext.get().partitionId(), None, None

        def row(following: int, is_last: bool) -> tuple:
            cid, seed, text, _, heads, before, rest = last
            reach, is_first = max(before, following), cid == first_cid
            mark = {"first": is_first, "seed": seed, "words": text, "reach": reach}
            # the outer rows stay whole, as the range beside may share more
            return (cid, heads if is_first or is_last else heads[:reach + 1], part,
                    mark if is_first else None, mark if is_last else None, *rest)

        def spell(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in slices(batches, 4096):
            out = []
            for seed, text, cid, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                split, shared, heads = _split(text), -1, []
                if last is None:
                    first_cid = cid
                else:
                    if last[1] == seed:
                        shared = max(-1, _common(last[3], split) - skip)
                    heads = last[4][:shared + 1]
                    out.append(row(shared, False))
                last = (cid, seed, text, split, heads + [cid] * (len(split) - skip - shared), shared, rest)
            if out:
                yield spell(out)
        if last:
            yield spell([row(-1, True)])

    kind = "struct<first:boolean,seed:long,words:binary,reach:int>"
    found, _ = materialize(ranged.mapInArrow(compare, f"cid long, heads array<long>, part int, edge {kind}, final {kind}"
                                             + "".join(f", {c} long" for c in carried)), "runs")

    # two rows a range: what the run that a range begins with is called in the range before
    firsts = found.filter("edge is not null").select("cid", "part", "edge").collect()
    lasts = {e.part: e for e in found.filter("final is not null").select("cid", "part", "heads", "final").collect()}
    reach = {e.cid: e.edge.reach for e in firsts} | {e.cid: e.final.reach for e in lasts.values()}
    renamed, before, heads = [], None, []
    for e in sorted(firsts, key=lambda e: (e.edge.seed, bytes(e.edge.words), e.cid)):
        shared = -1
        if before and before.final.seed == e.edge.seed:
            shared = max(-1, _common(_split(bytes(before.final.words)), _split(bytes(e.edge.words))) - skip)
            reach[e.cid], reach[before.cid] = max(reach[e.cid], shared), max(reach[before.cid], shared)
        names = heads[:shared + 1]
        renamed.append((e.part, e.cid, names))
        before = lasts[e.part]
        heads = [names[n] if h == e.cid and n < len(names) else h for n, h in enumerate(before.heads)]

    names = spark.createDataFrame(renamed, "part int, first_cid long, names array<long>")
    limits = spark.createDataFrame(list(reach.items()), "cid long, reach int")
    head = F.transform("heads", lambda h, n: F.when((h == F.col("first_cid")) & (n < F.size("names")),
                                                    F.get("names", n)).otherwise(h))
    return (found.join(F.broadcast(names), "part").join(F.broadcast(limits), "cid", "left")
            .withColumn("heads", F.when(F.col("reach").isNull(), head)
                        .otherwise(F.slice(head, F.lit(1), F.col("reach") + 1)))
            .filter(F.size("heads") > 0).select("cid", "heads", *carried))


def _repeated(contexts: DataFrame, seed: int, over: int) -> DataFrame:
    """``cid, others, all``: by how many words to the left repeated windows of the context go.

    ``others``: windows that two texts have; ``all``: also those that one
    text has at two places.  ``over``: words of a window beside the seed.
    """
    right = _runs(contexts, "words", seed, _PLACES).withColumnRenamed("heads", "right")
    left = _runs(contexts, "back", 0, []).withColumnRenamed("heads", "left")
    key, two_texts, two_places = ["d", "right_run", "left_run"], "low < high", "low < high or first < last"
    windows = (right.join(left, "cid").withColumn("d", F.explode(_depths()))
               .filter((over - F.col("d") < F.size("right")) & (F.col("d") < F.size("left")))
               .select("cid", "d", F.get("right", over - F.col("d")).alias("right_run"),
                       F.get("left", F.col("d")).alias("left_run"), *_PLACES[:4]))
    classes = (windows.groupBy(*key).agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                         F.min("first").alias("first"), F.max("last").alias("last"))
               .filter(two_places).select(*key, F.expr(two_texts).alias("other")))
    beside = windows.filter(f"not ({two_texts})").select("cid", *key).join(classes, key).select("cid", "d", "other")
    alone = contexts.filter(two_places).select("cid", F.explode(_depths()).alias("d"),
                                               F.expr(two_texts).alias("other"))
    return (beside.unionByName(alone).groupBy("cid")
            .agg(F.collect_set(F.when(F.col("other"), F.col("d"))).alias("others"), F.collect_set("d").alias("all")))


def repeated_passages(docs: DataFrame, min_words: int = 50, seed: int = 25) -> DataFrame:
    """``doc_id, n_words, copies, n_repeated, spans, n_own, own_spans`` of every row.

    ``copies``: rows with the same text; ``spans``: ``start:end`` in words
    (end exclusive) of passages that other documents have; ``own_spans``: of
    those that stand at another place of this text and in no other one;
    ``n_repeated``, ``n_own``: words in them.
    """
    ship(docs.sparkSession)
    over = min_words - seed
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes, kept, twice = [], [], []
            for text in part.column(1).to_pylist():
                w = Windows(text)
                seeds, at = w.minimisers(seed, min_words)
                different, times = np.unique(seeds[np.unique(at)], return_counts=True)
                sizes.append(w.n)
                kept.append(different)
                twice.append(different[times > 1])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(sizes, pa.int64()), _lists(kept), _lists(twice)],
                names=["doc_id", "text_hash", "n_words", "seeds", "twice"])

    rows, _ = materialize(texts.mapInArrow(suffixes, f"doc_id {kind}, text_hash long, n_words long, "
                                                     "seeds array<long>, twice array<long>"), "suffixes")
    different = (rows.filter(F.size("seeds") > 0).groupBy("text_hash")       # one row a text
                 .agg(F.min("doc_id").alias("doc_id"), F.first("seeds").alias("seeds"), F.first("twice").alias("twice")))
    retained = different.select("text_hash", "doc_id", F.explode("seeds").alias("seed"))
    shared = retained.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed")
    agreeing = (retained.join(shared, "seed", "left_semi")
                .unionByName(different.select("text_hash", "doc_id", F.explode("twice").alias("seed")))
                .groupBy("text_hash", "doc_id").agg(F.collect_set("seed").alias("seeds")))       # seeds of one text

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text_hash", "at", "digest", "seed", "words", "back", "last", "least", "most"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        for part in slices(batches, 64):
            out = []
            for text, text_hash, wanted in zip(*(part.column(i).to_pylist() for i in range(3))):
                w = Windows(text)
                seeds, at = w.minimisers(seed, min_words)
                places, start, windows = np.unique(at, return_index=True, return_counts=True)
                chosen = np.isin(seeds[places], np.array(wanted, np.int64).view(np.uint64))
                known: dict[bytes, list] = {}
                codes = seeds.view(np.int64)
                for p, s, n in zip(places[chosen].tolist(), start[chosen].tolist(), windows[chosen].tolist()):
                    words, back = _context(w.words[p:s + n - 1 + min_words]), _context(w.words[s:p][::-1])
                    digest = xxh3_128_digest(words + b"\n" + back)
                    if digest in known:                      # its words are there; only the place is new
                        known[digest][6] = p
                        out.append([text_hash, p, digest] + [None] * 6)
                    else:
                        known[digest] = [text_hash, p, digest, int(codes[p]), words, back, p, p - (s + n - 1), p - s]
                        out.append(known[digest])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    places = (texts.join(agreeing.withColumnRenamed("doc_id", "of"),
                         (texts.text_hash == agreeing.text_hash) & F.col("doc_id").eqNullSafe(F.col("of")))
              .select("text", texts.text_hash, "seeds"))
    places, _ = materialize(places.mapInArrow(reach, "text_hash long, at long, digest binary, seed long, words binary, "
                                                     "back binary, last long, least long, most long"), "places")
    contexts = (places.filter("words is not null").groupBy("seed", "words", "back", "digest", "least", "most")
                .agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"),
                     F.min("at").alias("first"), F.max("last").alias("last"))
                .withColumn("cid", F.monotonically_increasing_id()))
    contexts, _ = materialize(contexts, "contexts")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            others, own = [], []
            for found in part.column(1).to_pylist():
                other = {f["at"] - d for f in found for d in f["others"]}
                others.append(_spelled(other, min_words))
                own.append(_spelled({f["at"] - d for f in found for d in f["all"]} - other, min_words))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array([x[i] for x in xs], k) for xs in (others, own)
                                   for i, k in enumerate((pa.string(), pa.int64())))],
                names=["text_hash", "spans", "n_repeated", "own_spans", "n_own"])

    spelled = (_repeated(contexts, seed, over).join(contexts.select("cid", "digest"), "cid")
               .join(places.select("text_hash", "at", "digest"), "digest")
               .groupBy("text_hash").agg(F.collect_list(F.struct("at", "others", "all")).alias("found"))
               .mapInArrow(spell, "text_hash long, spans string, n_repeated long, own_spans string, n_own long"))
    copied = rows.filter(F.col("n_words") >= min_words).groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies"))
    whole = F.col("copies") > 1
    return (rows.select("doc_id", "text_hash", "n_words")
            .join(copied.join(spelled, "text_hash", "left"), "text_hash", "left")
            .select("doc_id", "n_words", F.coalesce("copies", F.lit(1)).alias("copies"),
                    F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_repeated", F.lit(0))).alias("n_repeated"),
                    F.when(whole, F.concat(F.lit("0:"), F.col("n_words").cast("string")))
                    .otherwise(F.coalesce("spans", F.lit(""))).alias("spans"),
                    F.when(whole, F.lit(0)).otherwise(F.coalesce("n_own", F.lit(0))).alias("n_own"),
                    F.when(whole, F.lit("")).otherwise(F.coalesce("own_spans", F.lit(""))).alias("own_spans")))
