"""Support vector machines with a radial kernel and probabilities, on random Fourier features."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KERNELS = ("linear", "rbf")
#: Parts of the training rows that are held out in turn to see margins that the fit has not.
INNER = 3


@lru_cache(4)
def fourier_weights(width: int, features: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(features x width weights, features phases): their cosines' products approach exp(-gamma * distance ** 2)."""
    rng = np.random.default_rng(seed)
    return rng.normal(size=(features, width)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, features)


def fourier_features(x: Column, width: int, features: int, gamma: float, seed: int) -> Column:
    """Array ``x`` as an array of ``features`` cosines.  Tasks draw the weights from the seed; none are sent."""

    @F.pandas_udf("array<double>")
    def cosines(xs: pd.Series) -> pd.Series:
        weights, phases = fourier_weights(width, features, gamma, seed)
        if not len(xs):
            return pd.Series([], dtype=object)
        return pd.Series(list(np.cos(np.stack(xs.to_numpy()) @ weights.T + phases) * np.sqrt(2 / features)))

    return cosines(x)


def kernel_width(rows: DataFrame, column: str, gamma: float | str) -> tuple[int, float]:
    """(width of the vectors, gamma): "scale" is one over width times variance of all cells, "auto" one over width."""
    x = vector_to_array(column)
    sums = rows.select(F.size(x).alias("w"), F.aggregate(x, F.lit(0.0), lambda s, v: s + v).alias("s"), F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v).alias("q")).agg(F.max("w"), F.sum("w"), F.sum("s"), F.sum("q")).first()
    width, n, s, q = sums
    if not width:
        raise ValueError("nothing to fit a kernel on")
    if gamma == "auto":
        return width, 1 / width
    if gamma == "scale":
        variance = q / n - (s / n) ** 2
        return width, 1 / (width * variance) if variance > 0 else 1 / width
    return width, float(gamma)


class KernelSvm(Estimator):
    """Hinge loss and L2 penalty (1 / (C n)) on the features of a kernel; probabilities by Platt's scaling of margins that
    parts of the rows got from the other parts' fits."""

    def __init__(self, inputCol: str, labelCol: str = "label", C: float = 1.0, kernel: str = "rbf", gamma: float | str = "scale", features: int = 512, max_iter: int = 100, tol: float = 1e-4, seed: int = 42):
        super().__init__()
        if kernel not in KERNELS:
            raise ValueError(f"{kernel} is none of {', '.join(KERNELS)}")
        self.column, self.label = inputCol, labelCol
        self.penalty, self.kernel, self.gamma, self.features, self.seed = C, kernel, gamma, features, seed
        self.options = {"maxIter": max_iter, "tol": tol, "standardization": False, "featuresCol": "_r", "labelCol": labelCol, "rawPredictionCol": "_m", "predictionCol": "_p"}

    def _fit(self, dataset: DataFrame) -> KernelSvmModel:
        width, gamma = kernel_width(dataset, self.column, self.gamma)
        mapped = lambda df: df.withColumn("_r", F.col(self.column) if self.kernel == "linear" else array_to_vector(fourier_features(vector_to_array(self.column), width, self.features, gamma, self.seed)))
        part = F.pmod(F.xxhash64(vector_to_array(self.column), F.lit(self.seed)), F.lit(INNER)).cast("int")
        rows = mapped(dataset).select(self.label, "_r", part.alias("_part")).persist()
        try:
            counts = {(r["_part"], r[self.label]): r["count"] for r in rows.groupBy("_part", self.label).count().collect()}  # six rows
            n = sum(counts.values())
            svc = LinearSVC(regParam=1 / (self.penalty * n), **self.options)
            # A part is held out if the others have both classes; equal vectors are in one part.
            split = [i for i in range(INNER) if all(any(counts.get((k, y)) for k in range(INNER) if k != i) for y in (0, 1))]
            held = split if len(split) == INNER else []
            with ThreadPoolExecutor(INNER + 1) as pool:  # the fits don't wait for each other
                whole, *others = pool.map(svc.fit, [rows, *[rows.filter(F.col("_part") != i) for i in held]])
            margin = lambda fitted, df: fitted.transform(df).select(F.col(self.label).cast("double").alias("y"), vector_to_array("_m")[1].alias("m"))
            if held:
                margins = reduce(DataFrame.unionByName, [margin(fitted, rows.filter(F.col("_part") == i)) for i, fitted in zip(held, others, strict=True)])
            else:
                margins = margin(whole, rows)
            slope, offset = platt(margins)
        finally:
            rows.unpersist()
        return KernelSvmModel(mapped, whole, slope, offset, self.kernel == "linear")


def platt(margins: DataFrame) -> tuple[float, float]:
    """Slope and offset of the logistic function of a margin (y, m), fitted to targets that are a little off 0 and 1."""
    pos, neg = margins.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    target = F.when(F.col("y") == 1, (pos + 1) / (pos + 2)).otherwise(1 / (neg + 2))
    both = margins.select("m", F.explode(F.array(F.struct(F.lit(1.0).alias("y"), target.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w")))).alias("x"))
    rows = both.select(array_to_vector(F.array("m")).alias("m"), "x.y", "x.w")
    fitted = LogisticRegression(featuresCol="m", labelCol="y", weightCol="w", maxIter=25).fit(rows)
    return float(fitted.coefficients[0]), float(fitted.intercept)


class KernelSvmModel(Model):
    def __init__(self, mapped, svc, slope: float, offset: float, linear: bool):
        super().__init__()
        self.mapped, self.svc, self.slope, self.offset, self.linear = mapped, svc, slope, offset, linear

    @property
    def importances(self) -> list[float] | None:
        """Sizes of a linear kernel's weights; other kernels' features are no columns of the input."""
        return [abs(float(x)) for x in self.svc.coefficients] if self.linear else None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = vector_to_array("_m")[1]
        chance = 1 / (1 + F.exp(-(F.lit(self.slope) * margin + self.offset)))
        out = self.svc.transform(self.mapped(dataset))
        return out.withColumns({"probability": array_to_vector(F.array(1 - chance, chance)), "prediction": F.col("_p")}).drop("_r", "_m", "_p")
