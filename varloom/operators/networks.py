"""Multi-layer perceptrons for two classes: gradients are summed over tasks, steps are taken on the driver."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1 - a * a),
    "logistic": (lambda z: 1 / (1 + np.exp(-z)), lambda a: a * (1 - a)),
    "identity": (lambda z: z, lambda a: np.ones_like(a)),
}
SOLVERS = ("lbfgs", "adam")
#: Partial sums meet in so many tasks before the driver adds theirs.
MEET = 16
#: Steps that a quasi-Newton direction remembers; halvings of a step.
MEMORY, HALVINGS = 10, 12

Layers = list[tuple[np.ndarray, np.ndarray]]


def initial(sizes: Sequence[int], activation: str, seed: int) -> np.ndarray:
    """Weights and offsets of all layers in one vector, uniform within Glorot's bound."""
    rng, out = np.random.default_rng(seed), []
    for a, b in zip(sizes, sizes[1:]):
        bound = np.sqrt((2.0 if activation == "logistic" else 6.0) / (a + b))
        out += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(out)


def layers_of(theta: np.ndarray, sizes: Sequence[int]) -> Layers:
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((theta[at : at + a * b].reshape(a, b), theta[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(theta: np.ndarray, sizes: Sequence[int], activation: str, x: np.ndarray) -> list[np.ndarray]:
    """What each layer gives; the last is the log-odds."""
    f, out = ACTIVATIONS[activation][0], [x]
    layers = layers_of(theta, sizes)
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(f(z) if i + 1 < len(layers) else z)
    return out


def gradient(theta: np.ndarray, sizes: Sequence[int], activation: str, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """(summed log loss, its gradient), without the penalty."""
    given = forward(theta, sizes, activation, x)
    z = given[-1][:, 0]
    loss = float((np.logaddexp(0, z) - y * z).sum())
    delta, parts = (1 / (1 + np.exp(-z)) - y)[:, None], []
    layers = layers_of(theta, sizes)
    for i in range(len(layers) - 1, -1, -1):
        parts += [delta.sum(0), (given[i].T @ delta).ravel()]
        if i:
            delta = (delta @ layers[i][0].T) * ACTIVATIONS[activation][1](given[i])
    return loss, np.concatenate(parts[::-1])


def penalised(theta: np.ndarray, sizes: Sequence[int], alpha: float, n: int) -> tuple[float, np.ndarray]:
    """(penalty of the weights, its gradient): offsets are free."""
    out, at = np.zeros_like(theta), 0
    for a, b in zip(sizes, sizes[1:]):
        out[at : at + a * b] = theta[at : at + a * b]
        at += a * b + b
    return 0.5 * alpha * float(out @ out) / n, alpha * out / n


class Perceptron(Estimator):
    """``hidden`` layers of an activation, logistic loss, L2 penalty ``alpha``, by L-BFGS or Adam on all rows.

    With ``early_stopping`` a share of the rows, chosen by a hash, is kept out, and the fit ends when its accuracy has
    not grown by ``tol`` for ``n_iter_no_change`` steps; the best step's weights stay.  Else it ends when the
    loss does not fall any more.  A pass over the rows is one job; only sums of gradients come to the driver.
    """

    def __init__(
        self, inputCol: str, labelCol: str = "label", hidden: Sequence[int] = (100,), activation: str = "relu", alpha: float = 1e-4, max_iter: int = 200, solver: str = "lbfgs",
        learning_rate_init: float = 1e-2, tol: float = 1e-4, early_stopping: bool = False, validation_fraction: float = 0.1, n_iter_no_change: int = 10, seed: int = 42,
    ):
        super().__init__()
        if activation not in ACTIVATIONS:
            raise ValueError(f"{activation} is none of {', '.join(ACTIVATIONS)}")
        if solver not in SOLVERS:
            raise ValueError(f"{solver} is none of {', '.join(SOLVERS)}")
        self.column, self.label, self.hidden, self.activation, self.alpha, self.max_iter, self.solver = inputCol, labelCol, list(hidden), activation, alpha, max_iter, solver
        self.rate, self.tol, self.early, self.share, self.patience, self.seed = learning_rate_init, tol, early_stopping, validation_fraction, n_iter_no_change, seed

    def _fit(self, dataset: DataFrame) -> PerceptronModel:
        x = vector_to_array(self.column)
        held = F.pmod(F.xxhash64(x, F.lit(self.seed)), F.lit(10_000)) < int(10_000 * self.share) if self.early else F.lit(False)
        rows = dataset.select(x.alias("x"), F.col(self.label).cast("double").alias("y"), held.alias("held")).persist()
        try:
            width = rows.agg(F.max(F.size("x"))).first()[0]
            if not width:
                raise ValueError("nothing to fit a network on")
            self.sizes = [width, *self.hidden, 1]
            theta, self.steps = self._descend(rows, initial(self.sizes, self.activation, self.seed))
        finally:
            rows.unpersist()
        return PerceptronModel(self.column, theta, self.sizes, self.activation, self.steps)

    def passed(self, rows: DataFrame, theta: np.ndarray) -> tuple[float, np.ndarray, float]:
        """(loss with penalty, gradient, accuracy of the rows kept out) in one pass over the rows."""
        sizes, activation = self.sizes, self.activation
        sent = rows.sparkSession.sparkContext.broadcast(theta)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, numbers = np.zeros(len(sent.value)), np.zeros(4)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y, out = batch.column("y").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
                loss, part = gradient(sent.value, sizes, activation, x[~out], y[~out])
                total += part
                right = (forward(sent.value, sizes, activation, x[out])[-1][:, 0] > 0) == (y[out] > 0.5)
                numbers += [loss, (~out).sum(), right.sum(), out.sum()]
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([numbers, total]).tobytes()], pa.binary())], ["part"])

        def added(parts: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"part": [np.sum([np.frombuffer(p) for p in parts["part"]], axis=0).tobytes()]})

        parts = rows.mapInArrow(sums, "part binary").groupBy(F.pmod(F.spark_partition_id(), F.lit(MEET))).applyInPandas(added, "part binary").collect()  # MEET rows at most
        sent.unpersist()
        whole = np.sum([np.frombuffer(p["part"]) for p in parts], axis=0)
        loss, n, right, out = whole[:4]
        more, slope = penalised(theta, sizes, self.alpha, max(n, 1))
        return loss / max(n, 1) + more, whole[4:] / max(n, 1) + slope, right / out if out else 0.0

    def _descend(self, rows: DataFrame, theta: np.ndarray) -> tuple[np.ndarray, int]:
        loss, slope, accuracy = self.passed(rows, theta)
        best, kept, waited, steps = (accuracy if self.early else -loss), theta, 0, 0
        memory: list[tuple[np.ndarray, np.ndarray]] = []
        first, second = np.zeros_like(theta), np.zeros_like(theta)
        while steps < self.max_iter and waited < self.patience:
            steps += 1
            if self.solver == "adam":
                first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
                theta = theta - self.rate * (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.999**steps)) + 1e-8)
                loss, slope, accuracy = self.passed(rows, theta)
            else:
                direction = self._direction(slope, memory)
                rate = 1.0 if memory else min(1.0, 1 / max(float(np.abs(slope).sum()), 1e-12))
                for _ in range(HALVINGS):
                    found = self.passed(rows, theta + rate * direction)
                    if found[0] <= loss + 1e-4 * rate * float(slope @ direction):
                        break
                    rate /= 2
                else:
                    break  # no step goes down
                step, turn = rate * direction, found[1] - slope
                if float(step @ turn) > 1e-12:
                    memory = [*memory[1 - MEMORY :], (step, turn)]
                theta, (loss, slope, accuracy) = theta + step, found
            score = accuracy if self.early else -loss
            if score > best + self.tol:
                waited = 0
            else:
                waited += 1
            if score > best:
                best, kept = score, theta
        return kept, steps

    @staticmethod
    def _direction(slope: np.ndarray, memory: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Minus the slope times the inverse curvature that the remembered steps show."""
        q, factors = slope.copy(), []
        for step, turn in reversed(memory):
            a = float(step @ q) / float(step @ turn)
            q -= a * turn
            factors.append(a)
        if memory:
            step, turn = memory[-1]
            q *= float(step @ turn) / float(turn @ turn)
        for (step, turn), a in zip(memory, reversed(factors), strict=True):
            q += (a - float(turn @ q) / float(step @ turn)) * step
        return -q


class PerceptronModel(Model):
    def __init__(self, column: str, theta: np.ndarray, sizes: list[int], activation: str, steps: int):
        super().__init__()
        self.column, self.theta, self.sizes, self.activation, self.steps = column, theta, sizes, activation, steps

    importances = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes, activation, sent = self.sizes, self.activation, dataset.sparkSession.sparkContext.broadcast(self.theta)

        @F.pandas_udf("double")
        def chance(xs: pd.Series) -> pd.Series:
            if not len(xs):
                return pd.Series([], dtype=float)
            return pd.Series(1 / (1 + np.exp(-forward(sent.value, sizes, activation, np.stack(xs.to_numpy()))[-1][:, 0])))

        out = dataset.withColumn("_c", chance(vector_to_array(self.column)))
        return out.withColumns({"probability": array_to_vector(F.array(1 - F.col("_c"), F.col("_c"))), "prediction": (F.col("_c") > 0.5).cast("double")}).drop("_c")
