"""Exact order statistics of many columns at once, without a column's values in one place.

A radix select: doubles are read as integers in the same order, and histograms of their leading digits, summed over
tasks, tell which digit the wanted rank falls in; each further pass looks at the next digits of the values that begin
like that.  Once few values are left these are gathered.  Histograms of folds are kept apart, so what stands outside
a fold is the sum of the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of all histograms of a pass, as a power of two, and values that are gathered in the end.
CELLS, GATHER = 20, 1 << 16
SIGN = np.uint64(1 << 63)


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles; both zeros are one."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & SIGN, ~bits, bits | SIGN)


def from_bits(bits: np.ndarray) -> np.ndarray:
    return np.where(bits & SIGN, bits & ~SIGN, ~bits).view(np.float64)


class _Search:
    """One rank of one column (all of them, if that is -1), outside of a fold (None: everywhere)."""

    def __init__(self, column: int, outside: int | None, rank: int):
        self.column, self.outside, self.rank, self.prefix = column, outside, rank, 0


def _histograms(cells: DataFrame, wanted: dict[int, list[int]], used: int, bits: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of each (column, fold): the first ``used + bits`` bits of the values whose first ``used`` are
    wanted in their column."""
    drop = np.uint64(64 - used - bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            for j, prefixes in wanted.items():
                x = batch.column(f"c{j}").to_numpy(zero_copy_only=False)
                known = ~np.isnan(x)
                key = ordered_bits(x[known]) >> drop
                inside = np.isin(key >> np.uint64(bits), np.array(prefixes, np.uint64)) if used else np.ones(len(key), bool)
                for f in np.unique(fold[known][inside]):
                    keys, n = np.unique(key[inside & (fold[known] == f)], return_counts=True)
                    old = held.get((j, f))
                    if old is not None:
                        keys, back = np.unique(np.concatenate([old[0], keys]), return_inverse=True)
                        n = np.bincount(back, np.concatenate([old[1], n]), len(keys)).astype(np.int64)
                    held[j, f] = [keys, n]
        for (j, f), (keys, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), j, np.int32)), pa.array(np.full(len(keys), f, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["c", "fold", "key", "n"])

    # As many rows as the histograms have cells: 1 << CELLS, or what is left of the values in the end.
    table = cells.mapInArrow(count, "c int, fold int, key long, n long").groupBy("c", "fold", "key").agg(F.sum("n").alias("n")).toPandas()
    return {(int(c), int(f)): (g["key"].to_numpy(np.int64).view(np.uint64), g["n"].to_numpy(np.int64)) for (c, f), g in table.groupby(["c", "fold"])}


def _outside(found: dict, column: int, outside: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The keys in order, with the counts of all folds less the one left out."""
    parts = [v for (c, f), v in found.items() if (column < 0 or c == column) and f != outside]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def medians(rows: DataFrame, columns: Sequence[str], folds: int = 0, together: bool = False) -> list[dict[str, float | None]]:
    """The exact median of each column's known cells (not null, not NaN), the mean of the middle two of an even number.

    With ``folds`` one dictionary for each fold (column ``fold``): of the rows outside it.  With ``together`` all columns'
    cells are one set.  A median of nothing is None.
    """
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    cells = rows.select((F.coalesce(F.col("fold"), F.lit(-1)) if folds else F.lit(0)).cast("int").alias("fold"), *[value(c).alias(f"c{j}") for j, c in enumerate(columns)]).persist()
    try:
        sides: list[int | None] = list(range(folds)) if folds else [None]
        targets = [-1] if together else list(range(len(columns)))
        per_pass = max(1, len(columns) * max(folds, 1))
        bits = int(np.clip(CELLS - np.ceil(np.log2(per_pass)), 4, 16))
        found = _histograms(cells, {j: [0] for j in range(len(columns))}, 0, bits)
        searches: dict[tuple[int, int | None], list[_Search]] = {}
        for t in targets:
            for side in sides:
                n = int(_outside(found, t, side)[1].sum())
                searches[t, side] = [_Search(t, side, r) for r in sorted({(n - 1) // 2, n // 2})] if n else []
        every, used = [s for group in searches.values() for s in group], 0
        while True:
            left = {}
            for s in every:
                keys, n = _outside(found, s.column, s.outside)
                keys, n = (keys, n) if used == 0 else (keys[keys >> np.uint64(bits) == s.prefix], n[keys >> np.uint64(bits) == s.prefix])
                at = int(np.searchsorted(np.cumsum(n), s.rank, side="right"))
                s.rank -= int(n[:at].sum())
                s.prefix = keys[at]
                for j in range(len(columns)) if s.column < 0 else [s.column]:
                    left.setdefault(j, {})[int(s.prefix)] = sum(int(m[k == s.prefix].sum()) for (c, _), (k, m) in found.items() if c == j)
            used += bits
            if used == 64 or not every:
                break
            # The last digits at once if few values are left; else as many as the histograms have room for.
            few = sum(sum(x.values()) for x in left.values()) <= GATHER
            room = max(1, sum(len(x) for x in left.values()) * max(folds, 1))
            bits = 64 - used if few else min(64 - used, int(np.clip(CELLS - np.ceil(np.log2(room)), 4, 16)))
            found = _histograms(cells, {j: sorted(x) for j, x in left.items()}, used, bits)
        middle = lambda group: float(np.mean(from_bits(np.array([s.prefix for s in group], np.uint64)))) if group else None
        return [{c: middle(searches[-1 if together else j, side]) for j, c in enumerate(columns)} for side in sides]
    finally:
        cells.unpersist()
