"""From sample vectors and tabular sources to cross-validated models, their ranking and an ablation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.operators import learning, metrics, omics
from varloom.sources import files

from .settings import OmicsSettings

#: Keys of a record's six vectors and the columns they become.
KEYS = {"Mut_hap1": "mut1", "WT_hap1": "wt1", "Mut_hap2": "mut2", "WT_hap2": "wt2", "Mut_ref": "mutref", "WT_ref": "wtref"}


def wide_vectors(vectors: DataFrame, model: str | None = None) -> DataFrame:
    """One row for each (sample, variant); ``ord``, the variant's id, settles ties."""
    rows = vectors if model is None else vectors.filter(F.col("model") == model)
    wide = rows.groupBy("sample_id", "variant_id").agg(*[F.max(F.when(F.col("key") == k, F.col("vec").cast("array<double>"))).alias(c) for k, c in KEYS.items()])
    return wide.filter("mut1 is not null").withColumn("ord", F.col("variant_id"))


def sample_features(vectors: DataFrame, settings: OmicsSettings) -> DataFrame:
    """(sample_id, emb): each sample's chosen variants, represented and aggregated."""
    rows = wide_vectors(vectors, settings.model_name)
    if settings.top_k > 0:
        rows = omics.select_top(omics.scored(rows), settings.select, settings.top_k, settings.weight, settings.widen)
    return omics.aggregate_vectors(omics.represented(rows, settings.strategy), "rep", settings.aggregate).select("sample_id", F.col("vec").alias("emb"))


#: Ids that are named in the scan of the vectors at most; more are joined.
NAMED = 10_000


def of_samples(vectors: DataFrame, samples: DataFrame) -> DataFrame:
    """The vectors of ``samples``, before anything is computed from them.

    Few ids become a filter of the scan, which then skips the folders of other samples; more are a semi-join.
    """
    ids = [r[0] for r in samples.limit(NAMED + 1).collect()]
    if len(ids) <= NAMED:
        return vectors.filter(F.col("sample_id").isin([x for x in ids if x is not None]))
    return vectors.join(samples, "sample_id", "left_semi")


def load_sources(spark: SparkSession, settings: OmicsSettings, labels: DataFrame | None = None) -> dict[str, DataFrame]:
    """The sources that are configured and exist, by modality; vectors only of samples that ``labels`` and the other
    sources have."""
    out = {}
    for name, path in (("metab", settings.metabolome_path), ("pheno", settings.phenome_path)):
        if files.exists(spark, path):
            out[name] = files.read_features(spark, path, settings.id_column)
    if files.exists(spark, settings.embedding_path):
        path = settings.embedding_path
        vectors = files.read_sample_json(spark, path) if settings.embedding_format == "json" else files.read_sample_npz(spark, path) if settings.embedding_format == "npz" else files.read_store(spark, path)
        if labels is not None:
            vectors = of_samples(vectors, omics.common_samples(labels, *out.values()))
        out["emb"] = sample_features(vectors, settings)
    return out


def aligned(labels: DataFrame, sources: dict[str, DataFrame], use: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(sample_id, label, emb where used, tabular columns named {modality}_{column}) and those names.

    Only samples that all of ``sources`` have, so that every module is judged on the same ones.  A source that has an
    id twice is refused.
    """
    if missing := [m for m in use if m not in sources]:
        raise ValueError(f"no source for {', '.join(missing)}")
    known = omics.refuse_repeats(labels.select("sample_id", "label"), "labels")
    out = reduce(lambda df, s: df.join(s.select("sample_id"), "sample_id", "left_semi"), sources.values(), known)
    tabular: list[str] = []
    for name in use:
        source = sources[name]
        if name != "emb":
            named = {c: f"{name}_{c}" for c in source.columns if c != "sample_id"}
            source = source.select("sample_id", *[F.col(c).alias(n) for c, n in named.items()])
            tabular += named.values()
        out = out.join(omics.refuse_repeats(source, name), "sample_id")
    return out, tabular


def evaluated(predictions: DataFrame) -> dict[str, DataFrame]:
    """metrics (counts, ratios, areas and the rank by ROC-AUC), reports and curves of each module and model apart."""
    each = [tuple(r) for r in predictions.select("module", "model").distinct().orderBy("module", "model").collect()]
    kinds = {
        "metrics": lambda df: metrics.confusion(df).crossJoin(metrics.roc_auc(df)).crossJoin(metrics.average_precision(df)),  # one row each
        "reports": metrics.classification_report, "roc_curves": metrics.roc_curve, "pr_curves": metrics.pr_curve,
    }
    out = {}
    for name, f in kinds.items():
        parts = [f(predictions.filter((F.col("module") == module) & (F.col("model") == model))).select(F.lit(module).alias("module"), F.lit(model).alias("model"), "*") for module, model in each]
        out[name] = reduce(DataFrame.unionByName, parts)
    by_area = Window.orderBy(F.desc("roc_auc"), "module", "model")  # a row for each module and model
    out["metrics"] = out["metrics"].withColumn("rank", F.row_number().over(by_area))
    return out


def run(spark: SparkSession, settings: OmicsSettings) -> dict[str, Any]:
    """scores, cv (means and best parameters), summary, comparison, best, predictions and metrics of all modules and
    models; written where output_dir is set.  ``predict`` is a function: it fits the best combination on all samples
    and predicts the rows that it is given, ``importances`` another: the features of that model, most important first.
    ``params`` has the chosen parameters of each module and model.  ``evaluated`` looks at the predictions of each module and model apart.

    A module whose sources are not there is skipped.
    """
    labels = files.read_labels(spark, settings.label_path, settings.id_column, settings.label_column)
    sources = load_sources(spark, settings, labels)
    if omics.common_samples(labels, *sources.values()).isEmpty():
        raise ValueError("no sample is in all sources")
    scores, predictions = None, None
    inputs = {}
    for module in settings.modules:
        use = omics.MODULES.get(module)
        if use is None:
            raise ValueError(f"{module} is none of {', '.join(omics.MODULES)}")
        if any(m not in sources for m in use):
            continue
        rows, tabular = aligned(labels, sources, use)
        prepare = learning.fold_preparation("emb" if "emb" in use else None, tabular, settings.impute, settings.components)
        inputs[module] = rows, prepare
        for model in settings.models:
            found, held = learning.cross_validate(rows, model, learning.param_grid(settings.grids.get(model, {})), settings.folds, settings.seed, prepare)
            found, held = found.withColumn("module", F.lit(module)), held.select(F.lit(module).alias("module"), F.lit(model).alias("model"), "sample_id", "fold", "label", "score", "pred")
            scores, predictions = (found, held) if scores is None else (scores.unionByName(found), predictions.unionByName(held))
    if scores is None:
        raise ValueError("no module has all its sources")
    summary = learning.ablation_summary(scores)
    cv = reduce(DataFrame.unionByName, [learning.cv_summary(scores.filter(F.col("module") == m)).withColumn("module", F.lit(m)) for m in inputs])
    out = {"scores": scores, "cv": cv, "summary": summary.orderBy(F.desc("mean_score"), "module", "model"), "comparison": learning.module_comparison(summary), "best": learning.best_combination(summary), "params": cv.select("module", "model", "best_params"), "predictions": predictions, "metrics": metrics.confusion(predictions)}
    if settings.output_dir:
        for name, df in out.items():
            if name == "predictions":
                df.write.mode("overwrite").partitionBy("module", "model").json(f"{settings.output_dir}/{name}")
            else:  # a few rows each
                df.coalesce(1).write.mode("overwrite").csv(f"{settings.output_dir}/{name}", header=True) if name == "summary" else df.coalesce(1).write.mode("overwrite").json(f"{settings.output_dir}/{name}")

    def predict(df: DataFrame) -> DataFrame:
        best = out["best"].join(cv.select("module", "model", "best_params"), ["module", "model"]).first()
        rows, prepare = inputs[best["module"]]
        return learning.fit_final(rows, best["model"], learning.read_params(best["best_params"]), settings.seed, prepare)(df)

    def importances() -> list[tuple[str, float, int]]:
        best = out["best"].join(cv.select("module", "model", "best_params"), ["module", "model"]).first()
        rows, prepare = inputs[best["module"]]
        fitted, ready = learning.fit_pipeline(rows, best["model"], learning.read_params(best["best_params"]), settings.seed, prepare)
        tabular = [c for c in rows.columns if c not in ("sample_id", "label", "emb")]
        width = ready(rows).select(F.size("features")).first()[0]
        return learning.importances(fitted, learning.feature_names(width - len(tabular), tabular))

    return {**out, "predict": predict, "importances": importances}
