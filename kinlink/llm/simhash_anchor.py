"""Operator 2, SimHash near-duplicates by anchor-point covering.

Fingerprints have 64 bits; two texts link when at most ``max_bits`` differ.
The bits are cut into blocks, each covered by the words of a perfect code,
its anchors: two blocks of 23 bits (Golay code, covering radius 3), one of
15 (Hamming code, radius 1) and one of 3 (every word).  Each value of a
block has exactly one anchor within the covering radius, its home.

If two fingerprints differ in at most 4 bits, then they differ in at most 1
bit of the first block, or at most 1 of the second, or in none of the rest
(``thresholds``).  So a fingerprint is replicated, for each of these three,
to every anchor within the covering radius plus the threshold, where it
meets every linked fingerprint that has its home there: about 15 short rows
a fingerprint.  Each anchor compares homes with replicas on all 64 bits and
keeps a spanning forest of its links, never the list of pairs.  Anchors with
more than ``cell`` members are cut into cells of at most about ``cell``
homes and ``cell`` replicas, compared apart.

Comparisons grow with the square of the different fingerprints over 4096
anchors.  For more than some 10**8 of them, ``fine=True`` takes the blocks
in pairs (at most 2 of 4 bits differ in one of the three pairs): some 300
rows a fingerprint, and 400 times fewer comparisons.

Equal fingerprints are one node, so thousands of copies cost one row.
Components of the links are found over distinct linked fingerprints.

Defined results: a text without words (null, empty, blank) has fingerprint
zero and links like any other.  Rows with a null id take part; the
component's id is its smallest non-null id (null if it has none).
Repeated ids are separate rows.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_digest

from ..operators.graph import connected_components
from ..session import materialize
from .common import free_name, ship, slices, with_column

CELL = 4096
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


# ----------------------------------------------------------- fingerprint --
def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= shingle:
        return int.from_bytes(xxh64_digest(joined, 42), "big")
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n - shingle + 1].tolist()
    digests = b"".join([xxh64_digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist())])
    columns = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    set_in = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * set_in > len(columns)).tobytes(), "big")


def add_fingerprint(docs: DataFrame, shingle: int, name: str) -> DataFrame:
    """``docs`` with the fingerprint (a signed long) of each whole text."""
    ship(docs.sparkSession)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            prints = np.array([fingerprint(t, shingle) for t in part.column(text).to_pylist()], np.uint64)
            yield with_column(part, name, pa.array(prints.view(np.int64)))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


# --------------------------------------------------------------- anchors --
class Code:
    """A perfect cyclic code: where each word's near code words are."""

    def __init__(self, bits: int, generator: int, radius: int):
        self.bits, self.radius, self.generator = bits, radius, generator
        self.check = generator.bit_length() - 1         # bits of the remainder
        self.name_bits = bits - self.check              # a code word's first bits name it
        self.low = np.array([self._remainder(x) for x in range(1 << min(bits, 12))], np.int64)
        self.high = np.array([self._remainder(x << 12) for x in range(1 << max(0, bits - 12))], np.int64)

    def _remainder(self, word: int) -> int:
        for shift in range(word.bit_length() - 1, self.check - 1, -1):
            if word >> shift & 1:
                word ^= self.generator << (shift - self.check)
        return word if self.check else 0

    @lru_cache(maxsize=4)
    def patterns(self, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Error patterns of at most ``radius + reach`` bits by remainder: starts, patterns, excess weights."""
        words = [sum(1 << b for b in c) for w in range(min(self.bits, self.radius + reach) + 1) for c in combinations(range(self.bits), w)]
        words = np.array(words, np.int64)
        of = self.low[words & 4095] ^ self.high[words >> 12]
        order = np.argsort(of, kind="stable")
        excess = np.maximum(0, np.bitwise_count(words[order]).astype(np.int64) - self.radius)
        return np.searchsorted(of[order], np.arange((1 << self.check) + 1)), words[order], excess

    def near(self, values: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(place of the value, anchor, bits beyond the radius)`` of all anchors in reach."""
        starts, words, excess = self.patterns(reach)
        rest = self.low[values & 4095] ^ self.high[values >> 12]
        many = starts[rest + 1] - starts[rest]
        place = np.repeat(np.arange(len(values)), many)
        at = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many) + starts[rest][place]
        return place, (values[place] ^ words[at]) >> self.check, excess[at]


@lru_cache(maxsize=1)
def blocks() -> list[tuple[int, Code]]:
    """``(lowest bit, code)`` of the four blocks."""
    golay, hamming, every = Code(23, 0xC75, 3), Code(15, 0x13, 1), Code(3, 1, 0)   # generator polynomials
    return [(41, golay), (18, golay), (3, hamming), (0, every)]


def thresholds(max_bits: int, fine: bool = False) -> list[tuple[tuple[int, ...], int]]:
    """Groups of blocks and how many bits may differ in one of them."""
    groups = [(0,), (1,), (2, 3)]
    if fine and max_bits:
        pairs = [(0, 1), (0, 2, 3), (1, 2, 3)]
        # the pairs' differences add up to 2 * max_bits, so one is at most a third
        return [(g, 2 * max_bits // 3) for g in pairs]
    # if every group differed by more than its threshold, more than max_bits would differ
    spare = max_bits - 2
    if spare < 0:
        return [(g, 0) for g in groups[:max_bits + 1 if max_bits else 0]]
    return [(groups[0], spare - spare // 2), (groups[1], spare // 2), (groups[2], 0)]


def replicas(prints: np.ndarray, max_bits: int, fine: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, fingerprint, is home)`` rows of distinct fingerprints."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))]
    for number, (group, limit) in enumerate(thresholds(max_bits, fine)):
        place, name, used = np.arange(len(prints)), np.full(len(prints), number), np.zeros(len(prints), np.int64)
        for low, code in (blocks()[b] for b in group):
            values = ((prints >> np.uint64(low)) & np.uint64((1 << code.bits) - 1)).astype(np.int64)
            row, anchor, excess = code.near(values[place], limit)
            ok = used[row] + excess <= limit
            row, anchor, excess = row[ok], anchor[ok], excess[ok]
            place, name, used = place[row], (name[row] << code.name_bits) | anchor, used[row] + excess
        found.append((name, prints[place], used == 0))
    return tuple(np.concatenate(x) for x in zip(*found))


def spanning_links(homes: np.ndarray, members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join what ``homes x members`` joins, fewer than rows in number.

    ``members`` are sorted and distinct.
    """
    links: list[tuple[int, int]] = []
    label = np.full(len(members), -1)      # home that first reached the member
    parent = list(range(len(homes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    own = np.minimum(np.searchsorted(members, homes), max(0, len(members) - 1))
    is_member = members[own] == homes if len(members) else np.zeros(len(homes), bool)
    for first in range(0, len(homes), 64):
        close = np.bitwise_count(homes[first:first + 64, None] ^ members[None, :]) <= max_bits
        for i in np.flatnonzero(close.sum(axis=1) > 1) + first:
            hit = np.flatnonzero(close[i - first])
            if is_member[i] and label[own[i]] >= 0:     # reached before: that link is known
                parent[i] = root(label[own[i]])
            fresh = hit[label[hit] < 0]
            for other in {root(o) for o in np.unique(label[hit[label[hit] >= 0]]).tolist()}:
                if root(i) != other:
                    links.append((int(homes[i]), int(homes[other])))
                    parent[other] = root(i)
            label[fresh] = i
            links += [(int(homes[i]), int(m)) for m in members[fresh] if m != homes[i]]
    return links


def _compare(max_bits: int):
    """Arrow helper over rows sorted by cell: compares one cell at a time."""

    def flush(rows: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        prints, home = (np.concatenate(x) for x in zip(*rows))
        got = np.array(spanning_links(prints[home], np.unique(prints), max_bits), np.uint64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in np.ascontiguousarray(got.T)], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, i, j, prints, home = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(5))
            key = np.stack([anchor, i, j], axis=1).astype(np.int64)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)]):
                if held and tuple(key[a]) != now:
                    yield flush(held)
                    held = []
                now = tuple(key[a])
                held.append((prints[a:b].view(np.uint64), home[a:b]))
        if held:
            yield flush(held)

    return run


def links(prints: DataFrame, max_bits: int, cell: int = CELL, fine: bool = False) -> DataFrame:
    """``src, dst``: links whose components are those of all linked pairs.

    ``prints`` has one column of distinct fingerprints (long).
    """
    ship(prints.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            at, of, home = replicas(part.column(0).to_numpy().view(np.uint64), max_bits, fine)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(of.view(np.int64)), pa.array(home)], names=["anchor", "print", "home"])

    rows, _ = materialize(prints.mapInArrow(spread, "anchor long, print long, home boolean"), "anchors")
    # few anchors are that crowded; the planner decides how to join them
    crowded = (rows.groupBy("anchor").agg(F.count_if("home").alias("_h"), F.count(F.lit(1)).alias("_m"))
               .filter(F.col("_m") > cell))
    cells = lambda n: F.coalesce(F.ceil(F.col(n) / cell), F.lit(1)).cast("int")
    own = lambda n: F.pmod(F.xxhash64("print"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sized = (rows.join(crowded, "anchor", "left")
             .select("anchor", "print", "home", F.greatest(cells("_h"), F.lit(1)).alias("_nh"), cells("_m").alias("_nm")))
    homes = sized.filter("home").withColumn("_i", own("_nh")).withColumn("_j", every("_nm"))
    members = sized.withColumn("home", F.lit(False)).withColumn("_j", own("_nm")).withColumn("_i", every("_nh"))
    dealt = (homes.select("anchor", "_i", "_j", "print", "home")
             .unionByName(members.select("anchor", "_i", "_j", "print", "home"))
             .repartition("anchor", "_i", "_j").sortWithinPartitions("anchor", "_i", "_j"))
    return dealt.mapInArrow(_compare(max_bits), "src long, dst long")


def components(prints: DataFrame, max_bits: int, fine: bool = False) -> DataFrame:
    """``print, root`` for every fingerprint that links to a different one."""
    distinct = prints.distinct()
    return connected_components(links(distinct, max_bits, fine=fine)).select(F.col("id").alias("print"), F.col("component").alias("root"))


# -------------------------------------------------------------- operator --
def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, fine: bool = False) -> DataFrame:
    """``doc_id, fingerprint (16 hex digits), component_id`` of every row."""
    rows, _ = materialize(add_fingerprint(docs.select("doc_id", "text"), shingle, "print").select("doc_id", "print"), "prints")
    groups = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    linked = groups.join(components(rows.select("print"), max_bits, fine), "print")
    least = linked.groupBy("root").agg(F.min("least").alias("reached"))
    # few rows: only fingerprints with a link to another one
    reach = linked.join(least, "root").select("print", "reached")
    known = groups.join(reach, "print", "left").select("print", F.coalesce("reached", "least").alias("component_id"))
    return (rows.join(known, "print", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, fine: bool = False) -> DataFrame:
    """One row of each component: that with the smallest id (nulls last).

    Ties between rows with the same id go to the row read first.
    """
    row, mark, root = (free_name(docs, n) for n in ("_row", "_print", "_root"))
    tagged = add_fingerprint(docs, shingle, mark).withColumn(row, F.monotonically_increasing_id())
    rows, _ = materialize(tagged, "tagged")
    narrow = rows.select(F.col("doc_id"), F.col(row).alias("_row"), F.col(mark).alias("print"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    groups = narrow.groupBy("print").agg(best.alias("best"))
    found = components(narrow.select("print"), max_bits, fine)
    kept = (groups.join(found, "print", "left").withColumn("root", F.coalesce("root", "print"))
            .groupBy("root").agg(F.min("best").alias("best")).select(F.col("best._row").alias(row)))
    return rows.join(kept, row, "left_semi").select(*docs.columns)
