"""Principal components of wide vectors: nothing as large as width times width anywhere.

Subspace iteration: each pass multiplies a thin matrix (width x a few more than the wanted components) by the rows' covariance,
summed over tasks by blocks of columns, until the shares of variance stand still.  Where there are fewer rows than
columns, as many columns as rows span all there is, and one pass is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of the thin matrix beyond the wanted components, passes at most, and change of a share that ends them.
EXTRA, PASSES, TOLERANCE = 10, 40, 1e-9
#: Columns of a block, and numbers in the thin matrix at most (512 MiB).
BLOCK, LARGEST = 1024, 1 << 26


def filled(column: str) -> Column:
    """Missing cells as 0."""
    return F.transform(column, lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(None)), F.lit(0.0)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _by_block(rows: DataFrame, of_task: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None]) -> np.ndarray:
    """The sum over tasks of an array whose first axis are columns; a block of it is added in one place."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = of_task(batches)
        for at in range(0, 0 if whole is None else len(whole), BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.ascontiguousarray(whole[at : at + BLOCK]).tobytes()], pa.binary())], ["at", "part"])

    def added(group: pd.DataFrame) -> pd.DataFrame:
        out = np.frombuffer(group["part"].iloc[0]).copy()
        for p in group["part"].iloc[1:]:
            out += np.frombuffer(p)
        return pd.DataFrame({"at": [group["at"].iloc[0]], "part": [out.tobytes()]})

    found = rows.mapInArrow(parts, "at int, part binary").groupBy("at").applyInPandas(added, "at int, part binary").collect()  # one thin matrix
    return np.concatenate([np.frombuffer(r["part"]) for r in sorted(found, key=lambda r: r["at"])]) if found else np.zeros(0)


@dataclass
class Components:
    """``vectors`` (width x k) of rows less ``mean``, over ``scale``; ``shares`` of the variance."""

    mean: np.ndarray
    scale: np.ndarray
    vectors: np.ndarray
    shares: list[float]
    passes: int

    def reduce(self, df: DataFrame, column: str) -> DataFrame:
        """Array ``column`` as its components."""
        sent = df.sparkSession.sparkContext.broadcast((self.mean, self.vectors / self.scale[:, None]))

        @F.pandas_udf("array<double>")
        def project(xs: pd.Series) -> pd.Series:
            if not len(xs):
                return pd.Series([], dtype=object)
            mean, vectors = sent.value
            return pd.Series(list((np.stack(xs.to_numpy()) - mean) @ vectors))

        return df.withColumn(column, project(filled(column)))


def fit_components(rows: DataFrame, column: str, k: int | str = "auto", scale: bool = True, seed: int = 42) -> Components:
    """The first k components; "auto" keeps min(rows, width).  Each one's largest weight is positive."""
    x = rows.select(filled(column).alias("x"), F.size(column).alias("w")).filter("w > 0").persist()
    try:
        n, width, widest = x.agg(F.count("*"), F.min("w"), F.max("w")).first()
        if not n:
            raise ValueError("nothing to fit a reducer on")
        if width != widest:
            raise ValueError(f"vectors of {width} and of {widest} numbers")
        kept = min(n, width) if k == "auto" else min(int(k), n, width)
        thin = min(kept + EXTRA, n, width)
        if thin * width > LARGEST:
            raise ValueError(f"{kept} components of {width} columns are too many to hold; ask for fewer")
        x = x.select("x")
        total = lambda batches: sum((_matrix(b).sum(0) for b in batches if b.num_rows), np.zeros(width))
        mean = _by_block(x, total) / n
        squares = lambda batches: sum((((_matrix(b) - mean) ** 2).sum(0) for b in batches if b.num_rows), np.zeros(width))
        variance = _by_block(x, squares) / n
        deviation = np.where(variance > 0, np.sqrt(variance), 1.0) if scale else np.ones(width)
        whole = float((variance / deviation**2).sum())
        basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, thin)))[0]
        values, before, passes = np.zeros(thin), None, 0
        while passes < PASSES:
            passes += 1
            sent = rows.sparkSession.sparkContext.broadcast((mean, deviation, basis))

            def product(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
                mean, deviation, basis = sent.value  # noqa: B023
                out = np.zeros_like(basis)
                for b in batches:
                    if b.num_rows:
                        z = (_matrix(b) - mean) / deviation
                        out += z.T @ (z @ basis)
                return out

            moved = _by_block(x, product).reshape(width, thin)
            sent.unpersist()
            values, turn = np.linalg.eigh(basis.T @ moved)
            values, turn = values[::-1] / n, turn[:, ::-1]
            vectors = basis @ turn[:, :kept]
            if before is not None and np.abs(values[:kept] - before).max() <= TOLERANCE * max(whole, 1e-300):
                break
            before, basis = values[:kept], np.linalg.qr(moved)[0]
        signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(kept)])
        return Components(mean, deviation, vectors * np.where(signs == 0, 1, signs), [float(max(v, 0) / whole) if whole else 0.0 for v in values[:kept]], passes)
    finally:
        x.unpersist()
