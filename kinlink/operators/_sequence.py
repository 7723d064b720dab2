"""Rows of a sorted partition beside the next one, a batch at a time.

Each task goes through its sorted rows once and holds one batch and one
row, so no window has to move the rows again.
"""

from __future__ import annotations

import sys
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])    # executors need no installed package


def equal_values(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays agree; null equals null and NaN equals NaN."""
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return same.to_numpy(zero_copy_only=False)


def _as_next(rows: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Where a row agrees with the next one in ``names``."""
    same = np.ones(rows.num_rows - 1, dtype=bool)
    for name in names:
        c = rows.column(name)
        same &= equal_values(c.slice(0, rows.num_rows - 1), c.slice(1))
    return same


def followed(part: str, cols: Sequence[str], prefix: str, keys: Sequence[str], apart: Sequence[str],
             distinct: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with ``cols`` of the next row of the same ``part``, and where a partition ``_begins`` and ``_ends``.

    ``distinct`` leaves one of equal neighbours.  The columns ``apart``
    become null in rows that differ from both neighbours in ``keys``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, met, begins = None, True, True

        def out(rows: pa.RecordBatch, following: list, stays: np.ndarray, ends: bool) -> pa.RecordBatch:
            nonlocal begins
            n = rows.num_rows
            where = pa.array(np.arange(n), mask=~stays)
            values = [c.take(where) if name in apart else c for name, c in zip(rows.schema.names, rows.columns)]
            first = np.zeros(n, dtype=bool)
            first[0], begins = begins, False
            return pa.RecordBatch.from_arrays([*values, *following, pa.array(first), pa.array(np.full(n, ends))],
                                              [*rows.schema.names, *[prefix + c for c in cols], "_begins", "_ends"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            if distinct and rows.num_rows > 1:
                rows = rows.filter(pa.array(np.append(True, ~_as_next(rows, rows.schema.names))))
            n = rows.num_rows - 1
            if n:
                alike, after = _as_next(rows, keys), pa.array(np.arange(1, n + 1), mask=~_as_next(rows, [part]))
                following = [rows.column(c).take(after) for c in cols]
                yield out(rows.slice(0, n), following, alike | np.append(met, alike[:-1]), False)
                met = bool(alike[-1])
            held = rows.slice(n)
        if held is not None:
            yield out(held, [pa.nulls(1, held.column(c).type) for c in cols], np.array([True]), True)

    return run
