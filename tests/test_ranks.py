"""Exact medians against numpy: ties, signs, gaps, folds, and many passes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.operators import learning, ranks


def test_bits_keep_the_order():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=1000) * 10.0 ** rng.integers(-300, 300, 1000), [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324]])
    bits = ranks.ordered_bits(x)
    assert (np.argsort(bits, kind="stable") == np.argsort(x + 0.0, kind="stable")).all() and (ranks.from_bits(bits) == x).all()


def data(n, seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(0, 1), lambda: float(rng.randrange(5)), lambda: rng.choice([-1e300, 1e-300, 3.0, -0.0, 0.0]), lambda: 7.25 + rng.random() * 1e-9]
    hole = lambda f: None if rng.random() < 0.1 else float("nan") if rng.random() < 0.1 else f()
    return [(i, i % 4, *[hole(f) for f in kinds], None) for i in range(n)]


@pytest.mark.parametrize("cells,gather", [(20, 1 << 16), (20, 0), (8, 10)])
def test_medians(spark, monkeypatch, cells, gather):
    monkeypatch.setattr(ranks, "CELLS", cells)
    monkeypatch.setattr(ranks, "GATHER", gather)
    names = ["a", "b", "c", "d", "none"]
    for n in (0, 1, 2, 997):
        rows = data(n, n)
        df = spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, d double, none double").repartition(3)
        table = np.array([[np.nan if x is None else x for x in r[2:]] for r in rows], dtype=float).reshape(n, 5)
        known = lambda x: x[~np.isnan(x)]
        median = lambda x: float(np.median(known(x))) if len(known(x)) else None
        assert ranks.medians(df, names) == [{c: median(table[:, j]) for j, c in enumerate(names)}]
        fold = np.array([r[1] for r in rows])
        assert ranks.medians(df, names, folds=4) == [{c: median(table[fold != f, j]) for j, c in enumerate(names)} for f in range(4)]
        assert ranks.medians(df, names, together=True)[0]["a"] == median(table.ravel())


def test_fills_by_fold(spark):
    rows = spark.createDataFrame([(i, i % 3, None if i % 5 == 0 else float(i * i), None) for i in range(40)], "sample_id long, fold int, x double, empty double")
    for how, f in (("median", np.median), ("mean", np.mean)):
        got = {r["sample_id"]: r for r in learning.impute_by_fold(rows, ["x", "empty"], 3, how).collect()}
        for i in range(40):
            want = i * i if i % 5 else f([k * k for k in range(40) if k % 5 and k % 3 != i % 3])
            assert got[i]["x"] == pytest.approx(want) and got[i]["empty"] == 0.0
    filled = learning.impute(rows.withColumn("x y", F.col("x")), ["x y"], "median").filter("sample_id = 0").first()
    assert filled["x y"] == np.median([k * k for k in range(40) if k % 5])
