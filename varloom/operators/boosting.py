"""Second-order gradient boosting of trees for two classes.

Columns are cut at quantiles of a mergeable weighted sketch.  For each level of a tree one job sums the gradients and
hessians of every (node, column, bin) in the tasks, adds the tasks' histograms where a (node, column) meets, and finds
the best split there: the driver gets one row for each node.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.sources.scratch import kept

#: Entries of a column's sketch for each bin; trees after which the rows are written, so that none hangs on many others.
SKETCH, WRITTEN = 8, 10
#: Columns of a histogram that meet in one task.
TOGETHER = 16


def summary(values: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order with their weights; beyond ``size`` those nearest to equal shares of the weight, each with
    the weight up to it."""
    values, back = np.unique(values, return_inverse=True)
    weights = np.bincount(back, weights, len(values))
    if len(values) <= size:
        return values, weights
    total = np.cumsum(weights)
    at = np.unique(np.concatenate([[0], np.searchsorted(total, np.linspace(0, total[-1], size)).clip(0, len(values) - 1), [len(values) - 1]]))
    return values[at], np.diff(total[at], prepend=0)


def quantile_cuts(rows: DataFrame, column: str, bins: int) -> list[np.ndarray]:
    """Ascending cuts of each place of array ``column``: between all its values, if they are ``bins`` or fewer, else at
    quantiles of them.  A value is in the bin of the number of cuts that are less than or equal to it."""
    size = SKETCH * bins

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for j in range(x.shape[1]):
                if j == len(held):
                    held.append((np.zeros(0), np.zeros(0)))
                held[j] = summary(np.concatenate([held[j][0], x[:, j]]), np.concatenate([held[j][1], np.ones(len(x))]), size)
        for j, (v, w) in enumerate(held):
            yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([v.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], ["j", "v", "w"])

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        v, w = (np.concatenate([np.frombuffer(p) for p in parts[c]]) for c in ("v", "w"))
        v, w = summary(v, w, 1 << 62 if len(np.unique(v)) <= bins else size)
        if len(v) <= bins:
            cuts = (v[1:] + v[:-1]) / 2
        else:
            total = np.cumsum(w)
            cuts = np.unique(v[np.searchsorted(total, total[-1] * np.arange(1, bins) / bins).clip(1, len(v) - 1)])
        return pd.DataFrame({"j": [parts["j"].iloc[0]], "cuts": [cuts.tobytes()]})

    found = rows.select(F.col(column).alias("x")).mapInArrow(sketch, "j int, v binary, w binary").groupBy("j").applyInPandas(merge, "j int, cuts binary").collect()  # a row for each column
    return [np.frombuffer(r["cuts"]) for r in sorted(found, key=lambda r: r["j"])]


@dataclass
class Tree:
    """Nodes by number, 1 the root, 2k and 2k + 1 the children of k: (column, cut, gain) where it splits, else a weight."""

    splits: dict[int, tuple[int, float, float]] = field(default_factory=dict)
    weights: dict[int, float] = field(default_factory=dict)

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The node that each row of x ends in, of the nodes there are; a value below the cut goes to 2k."""
        at = np.ones(len(x), dtype=np.int64)
        for node in sorted(self.splits):
            mine = at == node
            if mine.any():
                column, cut, _ = self.splits[node]
                at[mine] = 2 * node + (x[mine, column] >= cut)
        return at

    def values(self, x: np.ndarray) -> np.ndarray:
        at = self.nodes(x)
        out = np.zeros(len(x))
        for node, weight in self.weights.items():
            out[at == node] = weight
        return out


@dataclass
class Rules:
    """What a split must reach: a node's score is G ** 2 / (H + reg_lambda)."""

    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0

    def gains(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gain, G, H of the left side) of a cut behind each bin but the last; -inf where a side is too light."""
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        all_g, all_h = g.sum(), h.sum()
        score = lambda a, b: a * a / (b + self.reg_lambda)
        gain = (score(left_g, left_h) + score(all_g - left_g, all_h - left_h) - score(all_g, all_h)) / 2 - self.gamma
        light = (left_h < self.min_child_weight) | (all_h - left_h < self.min_child_weight)
        return np.where(light, -np.inf, gain), left_g, left_h


class BoostedTrees(Estimator):
    """``n_estimators`` trees of ``max_depth`` on the logistic loss, each times ``learning_rate``.

    ``subsample`` takes a share of the rows and ``colsample_bytree`` a share of the columns for each tree, by hashes and
    draws of the seed.  Splits need a gain above 0 after ``gamma``, and hessians of ``min_child_weight`` on both sides.
    """

    def __init__(
        self, inputCol: str, labelCol: str = "label", n_estimators: int = 100, max_depth: int = 6, learning_rate: float = 0.3, subsample: float = 1.0, colsample_bytree: float = 1.0,
        min_child_weight: float = 1.0, gamma: float = 0.0, reg_lambda: float = 1.0, max_bin: int = 256, seed: int = 42,
    ):
        super().__init__()
        if not (0 < subsample <= 1 and 0 < colsample_bytree <= 1):
            raise ValueError("shares of rows and columns are above 0 and at most 1")
        self.column, self.label, self.trees, self.depth, self.rate = inputCol, labelCol, n_estimators, max_depth, learning_rate
        self.subsample, self.colsample, self.bins, self.seed = subsample, colsample_bytree, max_bin, seed
        self.rules = Rules(reg_lambda, gamma, min_child_weight)

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        x = vector_to_array(self.column)
        state = dataset.select(x.alias("x"), F.col(self.label).cast("double").alias("y"), F.lit(0.0).alias("m"), F.xxhash64(x, F.lit(self.seed)).alias("u")).persist()
        try:
            cuts, rng = quantile_cuts(state, "x", self.bins), np.random.default_rng(self.seed)
            if not cuts:
                raise ValueError("nothing to fit trees on")
            model = BoostedModel(self.column, [], len(cuts))
            for number in range(self.trees):
                usable = [j for j in range(len(cuts)) if len(cuts[j])]
                chosen = sorted(rng.choice(usable, max(1, round(self.colsample * len(usable))), replace=False).tolist()) if usable else []
                tree = self._grow(state, cuts, chosen, number)
                model.trees.append(tree)
                if number + 1 < self.trees:
                    after = self._moved(state, tree)
                    after = (kept(after) if (number + 1) % WRITTEN == 0 else after).persist()
                    after.count()  # before what it comes from goes
                    state.unpersist()
                    state = after
        finally:
            state.unpersist()
        return model

    def _moved(self, state: DataFrame, tree: Tree) -> DataFrame:
        """Margins after the tree."""

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    m = batch.column("m").to_numpy() + tree.values(x)
                    yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(m), batch.column("u")], ["x", "y", "m", "u"])

        return state.mapInArrow(moved, "x array<double>, y double, m double, u long")

    def _grow(self, state: DataFrame, cuts: list[np.ndarray], chosen: list[int], number: int) -> Tree:
        tree, open_nodes = Tree(), [1]
        for level in range(self.depth + 1):
            best = self.best_splits(state, tree, cuts, chosen, open_nodes, number)
            following = []
            for node in open_nodes:
                if node not in best:
                    tree.weights[node] = 0.0  # no row of the sample
                    continue
                column, cut, gain, g, h = best[node]
                if level < self.depth and gain > 0:
                    tree.splits[node] = column, cut, gain
                    following += [2 * node, 2 * node + 1]
                else:
                    tree.weights[node] = -self.rate * g / (h + self.rules.reg_lambda)
            open_nodes = following
            if not open_nodes:
                break
        return tree

    def best_splits(self, state: DataFrame, tree: Tree, cuts: list[np.ndarray], chosen: list[int], open_nodes: list[int], number: int) -> dict[int, tuple[int, float, float, float, float]]:
        """node: (column, cut, gain, G, H) of the best split, the first column's of equal ones; gain -inf where there
        is none."""
        each = self.column_splits(state, tree, cuts, chosen, open_nodes, number)
        best = each.groupBy("node").agg(F.max_by(F.struct("j", "cut", "gain", "g", "h"), F.struct("gain", -F.col("j"))).alias("b")).collect()  # a row for each node
        return {r["node"]: tuple(r["b"]) for r in best}

    def column_splits(self, state: DataFrame, tree: Tree, cuts: list[np.ndarray], chosen: list[int], open_nodes: list[int], number: int = 0) -> DataFrame:
        """(node, j, cut, gain, g, h): the best cut of each chosen column, the first of equal ones, with the node's sums.
        ``state`` has (x, y, the margin m so far, a number u of each row by which shares of rows are taken)."""
        share, rules = int(self.subsample * 10_000), self.rules
        seed, places = number * 7919 + self.seed, {node: i for i, node in enumerate(open_nodes)}
        widths = [len(cuts[j]) + 1 for j in chosen]

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [np.zeros((2, len(open_nodes), w)) for w in widths]
            some = np.zeros((2, len(open_nodes)))
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                inside = np.ones(len(x), bool) if share == 10_000 else np.abs((batch.column("u").to_numpy() ^ seed) * 2654435761 >> 16) % 10_000 < share
                x, y, m = x[inside], batch.column("y").to_numpy()[inside], batch.column("m").to_numpy()[inside]
                at = np.array([places.get(k, -1) for k in range(max(open_nodes) + 1)])[tree.nodes(x)]  # -1 for finished ones
                x, y, m, at = x[at >= 0], y[at >= 0], m[at >= 0], at[at >= 0]
                p = 1 / (1 + np.exp(-m))
                weights = p - y, p * (1 - p)
                for k, w in enumerate(weights):
                    some[k] += np.bincount(at, w, len(open_nodes))
                for i, j in enumerate(chosen):
                    cell = at * widths[i] + np.searchsorted(cuts[j], x[:, j], side="right")
                    for k, w in enumerate(weights):
                        held[i][k] += np.bincount(cell, w, len(open_nodes) * widths[i]).reshape(len(open_nodes), -1)
            for n, node in enumerate(open_nodes):
                if not some[1, n]:
                    continue
                for i, j in enumerate(chosen or [-1]):
                    sums = held[i][:, n] if chosen else some[:, n : n + 1]
                    yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([j], pa.int32()), pa.array([np.ascontiguousarray(sums).tobytes()], pa.binary())], ["node", "j", "sums"])

        def split(parts: pd.DataFrame) -> pd.DataFrame:
            out = []
            for (node, j), group in parts.groupby(["node", "j"]):
                g, h = np.sum([np.frombuffer(p) for p in group["sums"]], axis=0).reshape(2, -1)
                gain, _, _ = rules.gains(g, h)
                k = int(np.argmax(gain)) if len(gain) else 0
                usable = len(gain) and gain[k] > -np.inf
                out.append((node, j, float(cuts[j][k]) if usable else 0.0, float(gain[k]) if usable else float("-inf"), g.sum(), h.sum()))
            return pd.DataFrame(out, columns=["node", "j", "cut", "gain", "g", "h"])

        sums = state.mapInArrow(histograms, "node long, j int, sums binary")
        return sums.groupBy("node", F.floor(F.col("j") / TOGETHER)).applyInPandas(split, "node long, j int, cut double, gain double, g double, h double")


class BoostedModel(Model):
    def __init__(self, column: str, trees: list[Tree], width: int):
        super().__init__()
        self.column, self.trees, self.width = column, trees, width

    @property
    def importances(self) -> list[float]:
        """The gain of each column's splits, as a share of all."""
        out = np.zeros(self.width)
        for tree in self.trees:
            for column, _, gain in tree.splits.values():
                out[column] += gain
        return (out / out.sum() if out.sum() else out).tolist()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.trees

        @F.pandas_udf("double")
        def margin(xs: pd.Series) -> pd.Series:
            if not len(xs):
                return pd.Series([], dtype=float)
            x = np.stack(xs.to_numpy())
            return pd.Series(np.sum([t.values(x) for t in trees], axis=0) if trees else np.zeros(len(x)))

        chance = 1 / (1 + F.exp(-F.col("_g")))
        out = dataset.withColumn("_g", margin(vector_to_array(self.column)))
        return out.withColumns({"probability": array_to_vector(F.array(1 - chance, chance)), "prediction": (F.col("_g") > 0).cast("double")}).drop("_g")
