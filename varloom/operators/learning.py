"""Folds, imputation, scaling, reduction, models and cross-validation."""

from __future__ import annotations

import ast
import itertools
import warnings
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.sources.scratch import kept

from .boosting import BoostedTrees
from .components import fit_components
from .kernels import KernelSvm
from .metrics import roc_auc
from .networks import Perceptron
from .ranks import medians

FILLS = ("median", "mean", "most_frequent", "zero")


def _ranked(rows: DataFrame, by: str | None, seed: int) -> DataFrame:
    """_rank: place of a row among those of its label in the order of a seeded hash of its id, from 0.

    Rows are ranked within cells of the hash's first two digits, which start after the cells before them: a
    label that holds most rows is still many tasks.
    """
    label = F.col(by) if by else F.lit(0)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("sample_id").cast("string")), 256)
    hashed = rows.withColumns({"_by": label, "_hash": order}).withColumn("_cell", F.substring("_hash", 1, 2))
    before = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    cells = hashed.groupBy(F.col("_by").alias("_key"), F.col("_cell").alias("_at")).agg(F.count("*").alias("_n"))
    starts = cells.select("_key", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # 256 rows a label
    within = F.row_number().over(Window.partitionBy("_by", "_cell").orderBy("_hash", "sample_id")) - 1
    joined = hashed.withColumn("_r", within).join(starts, F.col("_by").eqNullSafe(F.col("_key")) & (F.col("_cell") == F.col("_at")))
    return joined.withColumn("_rank", F.col("_r") + F.col("_start")).drop("_by", "_hash", "_cell", "_key", "_at", "_start", "_r")


def stratified_folds(rows: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """fold: rows of each label dealt in the order of a seeded hash of their id, so classes are balanced to one."""
    return _ranked(rows, "label", seed).withColumn("fold", F.pmod("_rank", F.lit(k)).cast("int")).drop("_rank")


def train_test_split(rows: DataFrame, test_share: float = 0.2, stratify: bool = True, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the exact quota ceil(n * test_share) of each label, or of all rows."""
    if not 0 < test_share < 1:
        raise ValueError("the share of test rows is between 0 and 1")
    by = ["label"] if stratify else []
    sizes = rows.groupBy(*[F.col(c).alias("_label") for c in by]).agg(F.ceil(F.count("*") * test_share).alias("_quota"))
    ranked = _ranked(rows, "label" if stratify else None, seed)
    on = F.col("label").eqNullSafe(F.col("_label")) if stratify else F.lit(True)
    marked = ranked.join(F.broadcast(sizes), on)  # one row a label
    part = lambda c: marked.filter(c).select(*rows.columns)
    return part(F.col("_rank") >= F.col("_quota")), part(F.col("_rank") < F.col("_quota"))


def fill_matrix(rows: DataFrame, columns: Sequence[str], how: str = "median") -> DataFrame:
    """Missing cells filled with one value for all columns: median or mean of all known cells, else 0."""
    if how not in ("median", "mean"):
        raise ValueError("how is median or mean")
    cells = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    if how == "median":
        fill = F.lit(medians(rows, columns, together=True)[0][columns[0]] or 0.0)
        return rows.withColumns({c: F.coalesce(x, fill) for c, x in cells.items()})
    value = rows.select(F.explode(F.array(*cells.values())).alias("x")).agg(F.coalesce(F.avg("x"), F.lit(0.0)).alias("_fill"))
    return rows.crossJoin(F.broadcast(value)).withColumns({c: F.coalesce(x, F.col("_fill")) for c, x in cells.items()}).drop("_fill")


def fill_values(rows: DataFrame, columns: Sequence[str], how: str, order: str = "sample_id") -> DataFrame:
    """One row: what missing cells (null or NaN) of each column get; 0 for an all-missing column."""
    if how not in FILLS:
        raise ValueError(f"{how} is none of {', '.join(FILLS)}")
    if how == "zero":
        return rows.agg(*[F.first(F.lit(0.0)).alias(c) for c in columns])
    cells = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    if how == "median":
        return rows.sparkSession.createDataFrame([[x or 0.0 for x in medians(rows, columns)[0].values()]], ", ".join(f"`{c}` double" for c in columns))
    if how == "mean":
        return rows.agg(*[F.coalesce(F.avg(x), F.lit(0.0)).alias(c) for c, x in cells.items()])
    # The most frequent value; of several, the one seen first.
    long = rows.select(F.col(order).alias("_o"), F.explode(F.array(*[F.struct(F.lit(c).alias("c"), x.alias("x")) for c, x in cells.items()])).alias("v")).filter("v.x is not null")
    counted = long.groupBy("v.c", "v.x").agg(F.count("*").alias("n"), F.min("_o").alias("first"))
    best = counted.groupBy("c").agg(F.min_by("x", F.struct(-F.col("n"), F.col("first"))).alias("x"))
    return best.agg(*[F.coalesce(F.max(F.when(F.col("c") == c, F.col("x"))), F.lit(0.0)).alias(c) for c in columns])


def impute(rows: DataFrame, columns: Sequence[str], how: str, fit: DataFrame | None = None) -> DataFrame:
    """Missing cells filled with values fitted on ``fit`` (the rows themselves by default)."""
    values = fill_values(fit if fit is not None else rows, columns, how)
    values = values.select(*[F.col(c).alias(f"_fill_{c}") for c in columns])
    out = rows.crossJoin(F.broadcast(values))
    return out.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.col(f"_fill_{c}")) for c in columns}).drop(*values.columns)


def impute_by_fold(rows: DataFrame, columns: Sequence[str], folds: int, how: str = "median") -> DataFrame:
    """Every row filled once for each fold, from the rows outside that fold: no leak into validation rows."""
    names = [f"_fill_{c}" for c in columns]
    if how == "median":
        each = [[i, *[x or 0.0 for x in found.values()]] for i, found in enumerate(medians(rows, columns, folds))]
        values = rows.sparkSession.createDataFrame(each, ", ".join(["for_fold int", *[f"`{c}` double" for c in names]]))
    else:  # of all rows less the fold's
        sums = rows.groupBy("fold").agg(*[e for c in columns for e in (F.sum(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"_s_{c}"), F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"_n_{c}"))]).collect()  # a row for each fold
        of = lambda i, k: sum((r[k] or 0.0) for r in sums if r["fold"] != i)
        each = [[i, *[of(i, f"_s_{c}") / n if (n := of(i, f"_n_{c}")) else 0.0 for c in columns]] for i in range(folds)]
        values = rows.sparkSession.createDataFrame([[x if k == 0 else float(x) for k, x in enumerate(e)] for e in each], ", ".join(["for_fold int", *[f"`{c}` double" for c in names]]))
    out = rows.join(F.broadcast(values), rows["fold"] == values["for_fold"])  # a row for each fold
    return out.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.col(f"_fill_{c}")) for c in columns}).drop("for_fold", *[f"_fill_{c}" for c in columns])


def standardize(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population standard deviation; constant columns become 0."""
    stats = rows.agg(*[e for c in columns for e in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))])
    scale = lambda c: F.when(F.col(f"_s_{c}") == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
    return rows.crossJoin(F.broadcast(stats)).withColumns({c: scale(c) for c in columns}).drop(*stats.columns)


def explained_variance(rows: DataFrame, column: str, k: int, scale: bool = True) -> DataFrame:
    """component, share: of a principal component analysis, missing cells as 0."""
    found = fit_components(rows, column, k, scale)
    return rows.sparkSession.createDataFrame(list(enumerate(found.shares)), "component int, share double")


def fit_reducer(rows: DataFrame, column: str, k: int | str = "auto", scale: bool = True) -> Callable[[DataFrame], DataFrame]:
    """A function that turns array ``column`` into its first principal components, fitted on ``rows``.

    Missing cells count as 0; columns are centered and, with ``scale``, divided by their population deviation.
    k "auto" keeps min(rows, width) components.
    """
    found = fit_components(rows, column, k, scale)
    return lambda df: found.reduce(df, column)


Fitted = Callable[[DataFrame], DataFrame]


def fold_preparation(embedded: str | None, tabular: Sequence[str], how: str = "median", components: int | str = "auto") -> Callable[[DataFrame], Fitted]:
    """fit(train) -> a function that adds ``features``: reduced embedding, then filled tabular columns; fitted on train."""

    def fit(train: DataFrame) -> Fitted:
        reduce = fit_reducer(train, embedded, components) if embedded else lambda df: df

        def ready(df: DataFrame) -> DataFrame:
            filled = impute(df, tabular, how, fit=train) if tabular else df
            parts = [*([F.col(embedded)] if embedded else []), *([F.array(*tabular)] if tabular else [])]
            return reduce(filled).withColumn("features", F.concat(*parts))

        return ready

    return fit


def feature_names(components: int, tabular: Sequence[str]) -> list[str]:
    return [*[f"emb_pca_{i}" for i in range(components)], *tabular]


def param_grid(options: dict[str, Sequence]) -> list[dict]:
    """All combinations; a single value stands for a list of one, and no options for one empty combination."""
    lists = [v if isinstance(v, (list, tuple)) else [v] for v in options.values()]
    return [dict(zip(options, x, strict=True)) for x in itertools.product(*lists)]


def grid_frame(spark, options: dict[str, Sequence]) -> DataFrame:
    """The same as a relation: one column per option."""
    out = spark.range(1).select()
    for name, values in options.items():
        out = out.select("*", F.explode(F.array([F.lit(v) for v in values])).alias(name))
    return out


#: Parameters that each model takes; others are left out with a warning.
MODELS = {
    "logistic": {"regParam", "elasticNetParam", "maxIter", "tol"},
    "logistic_regression": {"C", "penalty", "l1_ratio", "solver", "max_iter", "tol"},
    "linear_svc": {"regParam", "maxIter", "tol"},
    "svm": {"C", "kernel", "gamma", "features", "max_iter", "tol"},
    "gbt": {"maxIter", "maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy"},
    "xgboost": {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight", "gamma", "reg_lambda", "max_bin"},
    "spark_mlp": {"layers", "maxIter", "stepSize", "solver", "blockSize", "tol"},
    "mlp": {"hidden_layer_sizes", "activation", "alpha", "dropout", "solver", "max_iter", "learning_rate_init", "tol", "early_stopping", "validation_fraction", "n_iter_no_change"},
}
#: Trees take columns as they are; the others get them scaled.
UNSCALED = ("gbt", "xgboost")


class PenalisedLogistic(Estimator):
    """Logistic regression whose penalty is 1 / (C n); ``penalty`` is l1, l2, elasticnet or none."""

    def __init__(self, column: str, C: float = 1.0, penalty: str | None = "l2", l1_ratio: float = 0.5, max_iter: int = 100, tol: float = 1e-4, solver: str = "lbfgs"):
        super().__init__()
        if penalty not in ("l1", "l2", "elasticnet", "none", None):
            raise ValueError(f"{penalty} is no penalty")
        share = {"l1": 1.0, "elasticnet": l1_ratio}.get(penalty, 0.0)
        self.strength = 0.0 if penalty in ("none", None) else 1 / C
        self.model = LogisticRegression(featuresCol=column, labelCol="label", elasticNetParam=share, maxIter=max_iter, tol=tol, standardization=False)

    def _fit(self, dataset: DataFrame):
        return self.model.fit(dataset, {self.model.regParam: self.strength / max(dataset.count(), 1)})


def create_model(name: str, width: int, seed: int = 42, **params):
    """A pipeline that scales (but for trees) and fits.

    Unknown parameters are left out with a warning; an unknown model is an error.  ``dropout`` of a network becomes a
    penalty of a tenth of it, as what it stands for.
    """
    if name not in MODELS:
        raise ValueError(f"{name} is none of {', '.join(MODELS)}")
    if extra := set(params) - MODELS[name]:
        warnings.warn(f"{name} takes no {', '.join(sorted(extra))}", stacklevel=2)
        params = {k: v for k, v in params.items() if k in MODELS[name]}
    column = "x" if name in UNSCALED else "z"
    spark_ml = {"featuresCol": column, "labelCol": "label"}
    if name == "logistic":
        model = LogisticRegression(**spark_ml, **params)
    elif name == "logistic_regression":
        model = PenalisedLogistic(column, **params)
    elif name == "linear_svc":
        model = LinearSVC(**spark_ml, **params)
    elif name == "svm":
        model = KernelSvm(column, seed=seed, **params)
    elif name == "gbt":
        model = GBTClassifier(**spark_ml, seed=seed, **params)
    elif name == "xgboost":
        model = BoostedTrees(column, seed=seed, **params)
    elif name == "spark_mlp":
        model = MultilayerPerceptronClassifier(**spark_ml, seed=seed, **(params | {"layers": [width, *params.get("layers", [16]), 2]}))
    else:
        dropout, hidden = params.pop("dropout", 0), params.pop("hidden_layer_sizes", (100,))
        if dropout > 0:
            params["alpha"] = max(params.get("alpha", 1e-4), dropout / 10)
        model = Perceptron(column, hidden=[hidden] if isinstance(hidden, int) else hidden, seed=seed, **params)
    return Pipeline(stages=[*([] if name in UNSCALED else [StandardScaler(inputCol="x", outputCol="z", withMean=True)]), model])


def importances(fitted, names: Sequence[str]) -> list[tuple[str, float, int]]:
    """(feature, importance, rank) of a fitted pipeline, most important first: gains or shares of trees, sizes of linear
    weights; nothing of models that have neither."""
    model = fitted.stages[-1]
    if hasattr(model, "importances"):
        values = model.importances
    elif hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray().tolist()
    else:
        values = [abs(float(x)) for x in model.coefficients] if hasattr(model, "coefficients") else None
    if values is None:
        return []
    if len(values) != len(names):
        raise ValueError(f"{len(names)} names for {len(values)} features")
    order = sorted(zip(names, values, strict=True), key=lambda x: (-x[1], x[0]))
    return [(n, float(v), i + 1) for i, (n, v) in enumerate(order)]


def _score(df: DataFrame) -> DataFrame:
    raw = vector_to_array("probability")[1] if "probability" in df.columns else vector_to_array("rawPrediction")[1]
    return df.select("sample_id", *(["label"] if "label" in df.columns else []), raw.alias("score"), F.col("prediction").cast("int").alias("pred"))


def _vectors(rows: DataFrame) -> DataFrame:
    return rows.select("sample_id", *(["label"] if "label" in rows.columns else []), array_to_vector("features").alias("x"))


#: Combinations of a grid that are fitted at once; cells of one partition of what they are fitted on, at least.
AT_ONCE, CELLS = 4, 1 << 20


def sized(frames: Sequence[DataFrame], rows: int) -> tuple[list[DataFrame], int]:
    """``frames`` (x) in as many partitions as cells of ``rows`` rows need, and the width of x.

    Fits run hundreds of jobs, each of them a task for every partition, however few rows a partition holds.
    """
    width = len(frames[0].first()["x"])
    return [x.coalesce(max(1, -(-rows * width // CELLS))) for x in frames], width


def cross_validate(rows: DataFrame, model: str, grid: Iterable[dict], folds: int = 5, seed: int = 42, prepare: Callable[[DataFrame], Fitted] | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, out-of-fold predictions) of rows (sample_id, label, features).

    For each fold every combination is fitted on the other folds and judged on this one by ROC-AUC; the best one's
    predictions are kept, the first one's of several, and checkpointed: who reads them prepares nothing again.
    Choosing on the validation fold makes the scores optimistic.
    ``prepare`` makes features out of other columns, fitted on each fold's training rows.  A fold's rows are prepared
    once and its combinations are fitted a few at a time.
    """
    spark = rows.sparkSession
    grid = list(grid)
    data = stratified_folds(rows, folds, seed).persist()
    results, held_out = [], None
    try:
        total = data.count()
        for fold in range(folds):
            parts = data.filter(F.col("fold") != fold), data.filter(F.col("fold") == fold)
            ready = prepare(parts[0]) if prepare else lambda df: df
            made, width = sized([_vectors(ready(x)) for x in parts], total)
            train, held = (x.persist() for x in made)
            try:

                def judge(params: dict, train=train, held=held, width=width) -> tuple[float, dict, DataFrame]:
                    out = _score(create_model(model, width, seed, **params).fit(train).transform(held))
                    return roc_auc(out).first()[0], params, out

                with ThreadPoolExecutor(AT_ONCE) as pool:
                    score, params, out = max(pool.map(judge, grid), key=lambda x: x[0])
                out = kept(out.withColumn("fold", F.lit(fold)))
            finally:
                train.unpersist()
                held.unpersist()
            results.append((model, fold, float(score), str(sorted(params.items()))))
            held_out = out if held_out is None else held_out.unionByName(out)
    finally:
        data.unpersist()
    return spark.createDataFrame(results, "model string, fold int, score double, params string"), held_out


def cv_summary(results: DataFrame) -> DataFrame:
    """model, folds, mean_score, std_score (of all folds) and best_params, those of the best fold (the first of several)."""
    best = F.min_by("params", F.struct(-F.col("score"), F.col("fold"))).alias("best_params")
    return results.groupBy("model").agg(F.count("*").alias("folds"), F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"), best)


def read_params(text: str) -> dict:
    """The parameters that a result's ``params`` stands for."""
    return dict(ast.literal_eval(text))


def fit_pipeline(rows: DataFrame, model: str, params: dict, seed: int = 42, prepare: Callable[[DataFrame], Fitted] | None = None) -> tuple[Any, Fitted]:
    """(the fitted pipeline, the function that makes its features), fitted on all of ``rows``."""
    ready = prepare(rows) if prepare else lambda df: df
    made = _vectors(ready(rows))
    (train,), width = sized([made], rows.count())
    train.persist()
    try:
        return create_model(model, width, seed, **params).fit(train), ready
    finally:
        train.unpersist()


def fit_final(rows: DataFrame, model: str, params: dict, seed: int = 42, prepare: Callable[[DataFrame], Fitted] | None = None) -> Fitted:
    """A function that gives (sample_id, label where known, score, pred) of new rows, fitted on all of ``rows``."""
    fitted, ready = fit_pipeline(rows, model, params, seed, prepare)
    return lambda df: _score(fitted.transform(_vectors(ready(df))))


def infer_columns(names: Sequence[str], rows: int, prefix: str = "emb") -> tuple[list[str], list[str]]:
    """(embedded, tabular) columns of a table that does not say which are which: by the prefix where some have it, else the
    first ones are embedded, as many as there are rows, half of all at most."""
    named = [n for n in names if n.startswith(prefix)]
    if named:
        return named, [n for n in names if n not in set(named)]
    first = min(rows, len(names) // 2)
    return list(names[:first]), list(names[first:])


def ablation_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of each (module, model)'s fold scores."""
    return scores.groupBy("module", "model").agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))


def module_comparison(summary: DataFrame) -> DataFrame:
    return summary.groupBy("module").agg(F.max("mean_score").alias("best"), F.avg("mean_score").alias("mean"), F.stddev_pop("mean_score").alias("std"), F.count("*").alias("models"))


def best_combination(summary: DataFrame) -> DataFrame:
    return summary.filter("mean_score > 0").orderBy(F.desc("mean_score"), "module", "model").limit(1)
