"""Kernel machines, boosted trees and networks against brute force, numpy and shapes that only they can tell."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from varloom.operators import boosting, kernels, learning, metrics, networks


def frame(spark, x, y):
    rows = [(i, int(c), [float(v) for v in r]) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "sample_id long, label int, features array<double>").repartition(3)


def rings(n, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    angle, radius = rng.uniform(0, 2 * np.pi, n), 1 + 1.5 * y + rng.normal(size=n) * 0.15
    return np.stack([radius * np.cos(angle), radius * np.sin(angle)], 1), y


def area(df):
    return metrics.roc_auc(df).first()[0]


@pytest.mark.parametrize("model,params,least", [("svm", {"C": 10.0}, 0.98), ("mlp", {"hidden_layer_sizes": [8], "activation": "tanh", "max_iter": 60}, 0.98), ("xgboost", {"n_estimators": 5, "max_depth": 3}, 0.95)])
def test_rings(spark, model, params, least):
    train, held = frame(spark, *rings(300, 1)), frame(spark, *rings(200, 2))
    out = learning.fit_final(train, model, params)(held)
    assert area(out) > least
    scores = [r["score"] for r in out.collect()]
    assert all(0 <= s <= 1 for s in scores)
    right = out.filter((F.col("score") > 0.5) == (F.col("label") == 1)).count()
    assert right > 0.85 * len(scores)  # probabilities, not only an order


def test_a_linear_kernel_cannot_tell_rings_but_tells_sides(spark):
    assert area(learning.fit_final(frame(spark, *rings(300, 1)), "svm", {"kernel": "linear"})(frame(spark, *rings(200, 2)))) < 0.7
    x = np.random.default_rng(3).normal(size=(200, 3))
    rows = frame(spark, x, x[:, 1] > 0)
    fitted = learning.create_model("svm", 3, kernel="linear").fit(learning._vectors(rows))
    assert learning.importances(fitted, ["a", "b", "c"])[0][::2] == ("b", 1)
    assert learning.importances(learning.create_model("svm", 3).fit(learning._vectors(rows)), ["a", "b", "c"]) == []
    with pytest.raises(ValueError):
        learning.create_model("svm", 3, kernel="poly")


def test_fourier_features_and_platt(spark):
    x = np.random.default_rng(4).normal(size=(30, 3))
    df = frame(spark, x, np.zeros(30))
    got = np.array([r["f"] for r in df.orderBy("sample_id").select(kernels.fourier_features(F.col("features"), 3, 4000, 0.3, 7).alias("f")).collect()])
    want = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(got @ got.T - want).max() < 0.1
    rng = random.Random(2)
    margins = [(m, float(rng.random() < 1 / (1 + math.exp(-(2 * m - 1))))) for m in (rng.gauss(0, 1.5) for _ in range(4000))]
    slope, offset = kernels.platt(spark.createDataFrame(margins, "m double, y double"))
    assert abs(slope - 2) < 0.2 and abs(offset + 1) < 0.2
    assert kernels.kernel_width(df.select(array_to_vector("features").alias("v")), "v", "scale")[1] == pytest.approx(1 / (3 * x.var()))


def grown(x, y, m, rules, depth, rate):
    """The tree by trying every column and every cut between two values."""
    p = 1 / (1 + np.exp(-m))
    g, h, splits, weights = p - y, p * (1 - p), {}, {}

    def grow(node, mine, level):
        best = (0.0, None)
        score = lambda s: g[s].sum() ** 2 / (h[s].sum() + rules.reg_lambda)
        for j in range(x.shape[1]) if level < depth else ():
            values = np.unique(x[:, j])
            for cut in (values[1:] + values[:-1]) / 2:
                left, right = mine & (x[:, j] < cut), mine & (x[:, j] >= cut)
                if min(h[left].sum(), h[right].sum()) < rules.min_child_weight:
                    continue
                gain = (score(left) + score(right) - score(mine)) / 2 - rules.gamma
                if gain > best[0] + 1e-12:
                    best = (gain, (j, cut))
        if best[1] is None:
            weights[node] = -rate * g[mine].sum() / (h[mine].sum() + rules.reg_lambda)
            return
        splits[node] = (*best[1], best[0])
        grow(2 * node, mine & (x[:, best[1][0]] < best[1][1]), level + 1)
        grow(2 * node + 1, mine & (x[:, best[1][0]] >= best[1][1]), level + 1)

    grow(1, np.ones(len(x), bool), 0)
    return splits, weights


@pytest.mark.parametrize("options", [{}, {"gamma": 0.3, "reg_lambda": 3.0, "min_child_weight": 4.0}])
def test_trees_equal_brute_force(spark, options):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(120, 4)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(int)
    model = boosting.BoostedTrees("v", n_estimators=3, max_depth=3, learning_rate=0.5, **options).fit(frame(spark, x, y).withColumn("v", array_to_vector("features")))
    m = np.zeros(len(x))
    for tree in model.trees:
        splits, weights = grown(x, y, m, boosting.Rules(**options), 3, 0.5)
        assert tree.splits.keys() == splits.keys()
        for node, split in splits.items():
            assert tree.splits[node] == pytest.approx(split)
        assert tree.weights == pytest.approx(weights)
        m += tree.values(x)
    named = learning.importances(type("P", (), {"stages": [model]})(), list("abcd"))
    assert {named[0][0], named[1][0]} == {"a", "c"} and sum(v for _, v, _ in named) == pytest.approx(1)


def test_shares_of_rows_and_columns_and_odd_columns(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(300, 5)), np.ones((300, 1))], 1)
    y = (x[:, 1] + 0.3 * rng.normal(size=300) > 0).astype(int)
    rows = frame(spark, x, y).withColumn("v", array_to_vector("features"))
    fit = lambda **more: boosting.BoostedTrees("v", n_estimators=6, max_depth=2, max_bin=16, **more).fit(rows)
    model = fit(subsample=0.7, colsample_bytree=0.5)
    assert area(learning._score(model.transform(rows))) > 0.85
    assert model.importances[5] == 0.0
    again = fit(subsample=0.7, colsample_bytree=0.5)
    assert [t.splits.keys() for t in again.trees] == [t.splits.keys() for t in model.trees]
    constant = boosting.BoostedTrees("v", n_estimators=1, max_depth=2).fit(frame(spark, np.ones((20, 2)), [1] * 15 + [0] * 5).withColumn("v", array_to_vector("features")))
    assert constant.trees[0].splits == {} and constant.trees[0].weights[1] == pytest.approx(0.3 * 5 / 6)


def test_quantile_cuts(spark):
    rng = np.random.default_rng(7)
    x = np.stack([rng.exponential(size=20_000), rng.integers(0, 4, 20_000)], 1)
    cuts = boosting.quantile_cuts(frame(spark, x, np.zeros(20_000)), "features", 32)
    assert cuts[1].tolist() == [0.5, 1.5, 2.5]
    shares = np.diff(np.concatenate([[0], np.searchsorted(np.sort(x[:, 0]), cuts[0]), [20_000]])) / 20_000
    assert len(cuts[0]) == 31 and shares.max() < 1.5 / 32 and shares.min() > 0.5 / 32


@pytest.mark.parametrize("activation", sorted(networks.ACTIVATIONS))
def test_a_gradient_step_equals_numpy(spark, activation):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(50, 3)), rng.integers(0, 2, 50)
    rows = frame(spark, x, y).selectExpr("features as x", "cast(label as double) as y", "false as held")
    net = networks.Perceptron("v", hidden=[4, 3], activation=activation, alpha=0.5)
    net.sizes = [3, 4, 3, 1]
    theta = networks.initial(net.sizes, activation, 1)

    def loss(t):
        z = networks.forward(t, net.sizes, activation, x)[-1][:, 0]
        return np.mean(np.logaddexp(0, z) - y * z) + networks.penalised(t, net.sizes, 0.5, 50)[0]

    got, slope, _ = net.passed(rows, theta)
    assert got == pytest.approx(loss(theta))
    steps = np.eye(len(theta)) * 1e-6
    assert slope == pytest.approx([(loss(theta + s) - loss(theta - s)) / 2e-6 for s in steps], abs=1e-5)
    net.solver, net.max_iter, net.rate = "adam", 1, 1e-4
    after, _ = net._descend(rows, theta)
    assert after == pytest.approx(theta - 1e-4 * slope / (np.abs(slope) + 1e-8), abs=1e-9)


def test_early_stopping(spark):
    x, y = rings(400, 9)
    rows = frame(spark, x, y).withColumn("v", array_to_vector("features"))
    net = networks.Perceptron("v", hidden=[16, 8], max_iter=300, early_stopping=True, validation_fraction=0.2, n_iter_no_change=5)
    model = net.fit(rows)
    assert model.steps < 100 and area(learning._score(model.transform(rows))) > 0.97
    with pytest.raises(ValueError):
        networks.Perceptron("v", activation="step")


def test_penalties_and_names(spark):
    x = np.random.default_rng(10).normal(size=(150, 6))
    rows = frame(spark, x, x[:, 4] > 0)
    weights = lambda **p: [abs(v) for v in learning.create_model("logistic_regression", 6, **p).fit(learning._vectors(rows)).stages[-1].coefficients]
    assert sum(w > 1e-6 for w in weights(C=0.05, penalty="l1")) == 1 and sum(w > 1e-6 for w in weights(C=0.05)) == 6
    assert sum(weights(penalty=None, max_iter=20)) > sum(weights(C=0.05))
    names = learning.feature_names(4, ["metab_a", "pheno_b"])
    assert learning.importances(learning.create_model("logistic", 6, regParam=0.1).fit(learning._vectors(rows)), names)[0][0] == "metab_a"
    assert learning.importances(learning.create_model("gbt", 6, maxIter=2).fit(learning._vectors(rows)), names)[0][0] == "metab_a"
    with pytest.raises(ValueError, match="names"):
        learning.importances(learning.create_model("logistic", 6).fit(learning._vectors(rows)), names[:2])
    for a, b in itertools.combinations([0.0, 0.3], 2):
        assert learning.create_model("mlp", 6, dropout=a).getStages()[-1].alpha < learning.create_model("mlp", 6, dropout=b).getStages()[-1].alpha


def test_fits_have_partitions_by_their_size(spark, monkeypatch):
    from varloom.operators import learning

    rows = spark.range(0, 60, 1, 24).selectExpr("id as sample_id", "cast(id % 2 as int) as label", "array(cast(id % 7 as double), cast(id % 2 as double)) as features")
    seen, real = [], learning.create_model

    def watched(*args, **kwargs):
        model = real(*args, **kwargs)
        fit = model.fit
        model.fit = lambda df: (seen.append(df.rdd.getNumPartitions()), fit(df))[1]
        return model

    monkeypatch.setattr(learning, "create_model", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        results, held = learning.cross_validate(rows, "logistic", [{"maxIter": 3}], 2)
        assert held.count() == 60 and results.count() == 2 and seen == [1, 1]
        monkeypatch.setattr(learning, "CELLS", 30)  # of 120
        seen.clear()
        learning.cross_validate(rows, "logistic", [{"maxIter": 3}], 2)
        assert seen and all(1 < n <= 4 for n in seen)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_linear_machines_are_fitted_in_few_tasks(spark):
    """However many partitions the rows come in: a fit's jobs have a task for each of them."""
    from varloom.operators import learning

    rows = spark.range(0, 60, 1, 24).selectExpr("id as sample_id", "cast(id % 2 as int) as label", "array(cast(id % 7 as double), cast(id % 2 as double)) as features")
    made, width = learning.sized([learning._vectors(rows)], 60)
    assert (made[0].rdd.getNumPartitions(), width) == (1, 2)
    results, held = learning.cross_validate(rows, "linear_svc", learning.param_grid({"regParam": [0.01, 0.1], "maxIter": [5]}), 3)
    assert held.count() == 60 and [r["score"] for r in results.collect()] == [1.0] * 3
