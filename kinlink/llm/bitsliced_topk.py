"""Operator 7, exact top-k search by a bit-sliced index.

Components are quantised to integers.  Rows are dealt into blocks; a block
keeps, for every component, one bitmap a binary digit of (value - smallest
value of the block), and the complements of these bitmaps.  The scores of
one query against a block are built as bitmaps too: the digits of the
query's component say at which weights a component's bitmaps count (the
complements where the query is negative), and bitmaps of equal weight are
added three to two by full adders until one bitmap a weight is left.  The
best rows are then selected from the most significant slice downward: rows
with the digit set beat rows without it, until ``k`` rows are separated.
Rows tied at the boundary are resolved exactly by the smaller id.  A row of
a block wins or loses on its exact integer score; the blocks' winners meet
in one ranking a query.

Blocks hold at most ``block_rows`` rows.  Their bitmaps are built once and
written, one row a block (about 2 bits a digit and component of its rows), and
the queries are sent to them: a task reads a block's bitmaps, then answers its
queries one after the other, so any number of queries passes through.  Where
there are fewer blocks than cores, a block's queries are dealt into
``stripes`` that have a copy of its bitmaps each; this lays out the same work
and changes no result.  Tasks are never more than ``MOST_TASKS``; beyond that a
task takes several blocks in turn.

Defined results: null vectors, and vectors with a null, NaN or infinite
component, take no part.  Shorter vectors count as padded with zeros.  Rows
with a null id take no part (they cannot be named).  Equal ids are
different rows: each is its own query and a candidate of the others; equal
scores and ids keep any order.  Scores must fit 62 bits.  An empty table, and
one without a query or with no row but the query's own, gives no rows.  Other
columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import dense_ids
from ..session import materialize
from .common import ship

SCALE = 256
MOST_TASKS = 16_384


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: components as ``floor(scale * x)``, rows that take no part left out."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale)))).alias("v")))


# ----------------------------------------------------------------- index --
def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as one integer matrix, short rows padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py():column.offsets[-1].as_py()]
    out = np.zeros((len(column), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


class SlicedBlock:
    """Bitmaps of one block: ``digits[c, b]`` has the rows whose component c has digit b."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, least: np.ndarray, plain: np.ndarray):
        self.ids, self.rows, self.least = ids, rows, least
        self.width, self.digits, words = plain.shape
        every = np.zeros(words * 64, np.uint8)
        every[:len(ids)] = 1
        self.all = np.packbits(every, bitorder="little").view(np.uint64)
        # [plain or complement, component, digit, word of 64 rows]
        self.maps = np.stack([plain, ~plain & self.all])

    @classmethod
    def of(cls, ids: np.ndarray, rows: np.ndarray, values: np.ndarray) -> "SlicedBlock":
        order = np.lexsort((rows, ids))     # ties go to the first row
        ids, rows, values = ids[order], rows[order], values[order]
        least = values.min(axis=0)
        above = (values - least).astype(np.uint64)
        digits, words = max(1, int(above.max(initial=0)).bit_length()), -(-len(ids) // 64)
        plain = np.zeros((values.shape[1], digits, words), np.uint64)
        for b in range(digits):
            bits = np.zeros((values.shape[1], words * 64), np.uint8)
            bits[:, :len(ids)] = ((above >> np.uint64(b)) & np.uint64(1)).T
            plain[:, b] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        return cls(ids, rows, least, plain)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.ids), self.width, self.digits], np.int64)
        return b"".join(x.tobytes() for x in (head, self.ids, self.rows, self.least, self.maps[0]))

    @classmethod
    def from_bytes(cls, blob: bytes) -> "SlicedBlock":
        n, width, digits = np.frombuffer(blob, np.int64, 3).tolist()
        ids, rows, least = np.split(np.frombuffer(blob, np.int64, 2 * n + width, 24), [n, 2 * n])
        plain = np.frombuffer(blob, np.uint64, offset=24 + 8 * (2 * n + width))
        return cls(ids, rows, least, plain.reshape(width, digits, -(-n // 64)))

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of (score - base) from the least significant on, and base."""
        width = min(self.width, len(query))
        q, least = query[:width], self.least[:width]
        top = (1 << self.digits) - 1
        base = int(sum(int(a) * (int(m) + (top if a < 0 else 0)) for a, m in zip(q.tolist(), least.tolist())))
        size, sign = np.abs(q).astype(np.uint64), (q < 0).astype(np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        for t in range(int(size.max(initial=0)).bit_length()):
            part = np.flatnonzero((size >> np.uint64(t)) & np.uint64(1))
            if part.size:
                for b in range(self.digits):
                    waiting.setdefault(t + b, []).append(self.maps[sign[part], part, b])
        slices, weight = [], 0
        while waiting:
            maps = np.concatenate(waiting.pop(weight)) if weight in waiting else np.zeros((0, len(self.all)), np.uint64)
            while len(maps) > 2:            # full adders: three bitmaps to a sum and a carry
                third = len(maps) // 3
                a, b, c = maps[:third], maps[third:2 * third], maps[2 * third:3 * third]
                half = a ^ b
                waiting.setdefault(weight + 1, []).append((a & b) | (half & c))
                maps = np.concatenate([half ^ c, maps[3 * third:]])
            if len(maps) == 2:              # half adder
                waiting.setdefault(weight + 1, []).append((maps[0] & maps[1])[None])
                maps = (maps[0] ^ maps[1])[None]
            slices.append(maps[0] if len(maps) else np.zeros_like(self.all))
            weight += 1
        return slices, base

    def top(self, query: np.ndarray, own_row: int, k: int) -> list[tuple[int, int]]:
        """``(id, score)`` of the ``k`` best rows but the query's own."""
        slices, base = self.score_slices(query)
        open_, sure = self.all.copy(), np.zeros_like(self.all)
        for at in np.flatnonzero(self.rows == own_row):
            open_[at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
        need = k
        for digit in reversed(slices):
            ahead = open_ & digit
            n = int(np.bitwise_count(ahead).sum())
            if n > need:
                open_ = ahead
            else:                           # all of them are in
                sure |= ahead
                need -= n
                open_ = open_ & ~digit
            if not need:
                break
        places = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
        won = np.concatenate([places(sure), places(open_)[:need]])      # rows are in order of id
        score = np.zeros(len(won), np.int64)
        for b, digit in enumerate(slices):
            score += ((digit[won // 64] >> (won % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
        return [(int(self.ids[w]), int(s) + base) for w, s in zip(won, score)]


# ---------------------------------------------------------------- search --
def _numbered(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with a row number and a block of at most ``size`` rows."""
    placed = dense_ids(rows.withColumn("_at", F.monotonically_increasing_id()), ["vec_id", "_at"], "_row", start=0).drop("_at")
    return placed.withColumn("_block", F.floor(F.col("_row") / size).cast("int"))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow helper over rows sorted by block: one row of bitmaps a block."""

    def built(block: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        width = max(v.shape[1] for _, _, v in parts)
        values = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for _, _, v in parts])
        ids, rows = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([SlicedBlock.of(ids, rows, values).to_bytes()], pa.binary())],
                                          names=["_block", "maps"])

    block, parts = None, []
    for batch in batches:
        key = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if parts and key[a] != block:
                yield built(block, parts)
                parts = []
            block, part = int(key[a]), batch.slice(a, b - a)
            parts.append((*(part.column(c).to_numpy().copy() for c in (1, 2)), _matrix(part.column(3))))
    if parts:
        yield built(block, parts)


def _search(k: int):
    """Arrow helper over sorted cells: a row of bitmaps, then the queries that they answer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            at = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False)).tolist()
            for a, b in zip([-1, *at], [*at, batch.num_rows]):
                if a >= 0:                  # the row of a cell's bitmaps
                    block = SlicedBlock.from_bytes(batch.column(2)[a].as_py())
                part = batch.slice(a + 1, b - a - 1)
                if not part.num_rows:
                    continue
                found = [(q, o, v, s) for q, o, query in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _matrix(part.column(3)))
                         for v, s in block.top(query, o, k)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*found)) or [()] * 4)],
                                                 names=["query_id", "own", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, block_rows: int = 32_768, stripes: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` for queries whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    rows, _ = materialize(_numbered(quantised(vectors), block_rows), "vectors")
    blocks = (rows.agg(F.max("_block")).first()[0] or 0) + 1
    stripes = stripes or max(1, -(-2 * spark.sparkContext.defaultParallelism // blocks))
    dealt = rows.select("_block", "vec_id", "_row", "v").repartition(min(blocks, MOST_TASKS), "_block").sortWithinPartitions("_block")
    index, _ = materialize(dealt.mapInArrow(_build, "_block int, maps binary"), "bitmaps")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    cells = (index.select("_block", every_of(stripes).alias("_part"), F.lit(None).cast("long").alias("vec_id"),
                          F.lit(None).cast("long").alias("_row"), "maps", F.lit(None).cast("array<bigint>").alias("v"))
             .unionByName(asked.select(every_of(blocks).alias("_block"), F.pmod(F.xxhash64("_row"), F.lit(stripes)).cast("int").alias("_part"),
                                       "vec_id", "_row", F.lit(None).cast("binary").alias("maps"), "v")))
    # nulls sort first: a cell's bitmaps come before its queries
    met = (cells.repartition(min(blocks * stripes, MOST_TASKS), "_block", "_part").sortWithinPartitions("_block", "_part", "_row")
           .select("vec_id", "_row", "maps", "v"))
    found = met.mapInArrow(_search(k), "query_id long, own long, vec_id long, score long")
    best = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
