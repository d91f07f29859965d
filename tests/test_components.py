"""Principal components against numpy: tall, square, wide, constant and missing columns."""

import numpy as np
import pytest

from varloom.operators import components, learning


def frame(spark, x):
    return spark.createDataFrame([(i, [None if np.isnan(c) else float(c) for c in v]) for i, v in enumerate(x)], "sample_id long, emb array<double>").repartition(3)


@pytest.mark.parametrize("shape,k", [((200, 6), 3), ((12, 12), "auto"), ((20, 3000), "auto"), ((150, 1500), 4), ((1, 5), "auto")])
@pytest.mark.parametrize("scale", [True, False])
def test_against_numpy(spark, shape, k, scale):
    rng = np.random.default_rng(shape[1])
    rank = min(shape)
    x = (rng.normal(size=(shape[0], rank)) * 0.7 ** np.arange(rank) * 10) @ rng.normal(size=(rank, shape[1])) + rng.normal(size=shape[1])
    x[:, 0] = 3.0
    x[0, 1] = np.nan
    clean = np.nan_to_num(x)
    deviation = clean.std(0)
    z = (clean - clean.mean(0)) / (np.where(deviation > 0, deviation, 1) if scale else 1)
    _, s, v = np.linalg.svd(z, full_matrices=False)
    found = components.fit_components(frame(spark, x), "emb", k, scale)
    want = min(shape) if k == "auto" else k
    assert found.vectors.shape == (shape[1], want) and len(found.shares) == want
    assert found.shares == pytest.approx((s**2 / max((s**2).sum(), 1e-300))[:want].tolist(), abs=1e-7)
    got = np.array([r["emb"] for r in found.reduce(frame(spark, x), "emb").orderBy("sample_id").collect()])
    solid = s[:want] > 1e-6 * s[0] if s[0] else s[:want] > 1
    assert np.allclose(np.abs(got)[:, solid], np.abs(z @ v[:want].T)[:, solid], atol=1e-3 * (s[0] or 1) / np.sqrt(shape[0]))


def test_same_for_the_same_rows_and_refusals(spark):
    x = np.random.default_rng(1).normal(size=(40, 30))
    first, second = (components.fit_components(frame(spark, x), "emb", 30) for _ in range(2))
    assert np.allclose(first.vectors, second.vectors, atol=1e-6)
    with pytest.raises(ValueError, match="nothing to fit"):
        components.fit_components(frame(spark, x[:0]), "emb")
    with pytest.raises(ValueError, match="of 2 and of 3"):
        components.fit_components(spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0],)], "emb array<double>"), "emb")


def test_the_thin_matrix_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(components, "LARGEST", 100)
    with pytest.raises(ValueError, match="too many to hold"):
        learning.fit_reducer(frame(spark, np.random.default_rng(2).normal(size=(30, 20))), "emb")
