"""Exact classification metrics as window and conditional aggregates.  Input: label (0/1), score, pred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion(rows: DataFrame) -> DataFrame:
    count = lambda y, p: F.count_if((F.col("label") == y) & (F.col("pred") == p))
    c = rows.agg(count(1, 1).alias("tp"), count(0, 1).alias("fp"), count(0, 0).alias("tn"), count(1, 0).alias("fn"))
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    c = c.withColumns({"accuracy": ratio(tp + tn, tp + fp + tn + fn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})
    return c.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def classification_report(rows: DataFrame) -> DataFrame:
    """precision, recall, f1 and support of each class, their plain and weighted means, and accuracy."""
    both = rows.select(F.explode(F.array(F.struct(F.col("label").alias("c"), F.lit(1).alias("is"), F.lit(0).alias("said")), F.struct(F.col("pred").alias("c"), F.lit(0).alias("is"), F.lit(1).alias("said")))).alias("x"), "label", "pred")
    per = both.groupBy(F.col("x.c").alias("c")).agg(
        F.sum("x.is").alias("support"), F.sum("x.said").alias("said"), F.sum(F.when((F.col("label") == F.col("pred")) & (F.col("x.is") == 1), 1).otherwise(0)).alias("hit")
    )
    per = per.withColumns({"precision": ratio(F.col("hit").cast("double"), F.col("said")), "recall": ratio(F.col("hit").cast("double"), F.col("support"))})
    per = per.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    each = per.select(F.col("c").cast("string").alias("class"), "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"))
    means = lambda name, f: per.agg(*[f(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").cast("bigint").alias("support")).select(F.lit(name).alias("class"), "precision", "recall", "f1", "support")
    macro = means("macro avg", F.avg)
    weighted = means("weighted avg", lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support"))
    return each.unionByName(macro).unionByName(weighted)


#: Ranges of scores that running totals are dealt to.
RANGES = 64


def _by_score(rows: DataFrame) -> DataFrame:
    """Positives and negatives at each distinct score, and cumulated from the highest.

    Scores are cut into ranges at sampled quantiles; each range is summed alone and starts from the totals of
    the ranges above it, so no task sees all scores.  A missing score comes last.
    """
    at = rows.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    score = F.col("score").cast("double")
    cuts = sorted(set(rows.select(score.alias("score")).approxQuantile("score", [i / RANGES for i in range(1, RANGES)], 0.005)))
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c > score)) if cuts else F.lit(0)
    at = at.withColumn("_range", F.when(score.isNull(), F.lit(RANGES)).otherwise(above))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over RANGES rows
    heads = at.groupBy("_range").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    heads = heads.select(F.col("_range").alias("_head"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_p", "_n")])
    down = Window.partitionBy("_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    inside = at.withColumns({"tp": F.sum("p").over(down), "fp": F.sum("n").over(down)})
    joined = inside.join(F.broadcast(heads), F.col("_range") == F.col("_head"))
    return joined.select("score", "p", "n", (F.col("tp") + F.col("_p")).alias("tp"), (F.col("fp") + F.col("_n")).alias("fp"))


def roc_auc(rows: DataFrame) -> DataFrame:
    """Ties count half; 0.5 if one class is absent."""
    c = _by_score(rows)
    area = F.sum(F.col("n").cast("double") * (F.col("tp") - F.col("p") + F.col("p") / 2.0))
    return c.agg(area.alias("a"), F.sum("p").alias("pos"), F.sum("n").alias("neg")).select(F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("a") / (F.col("pos").cast("double") * F.col("neg"))).otherwise(F.lit(0.5)).alias("roc_auc"))


def average_precision(rows: DataFrame) -> DataFrame:
    c = _by_score(rows)
    return c.agg(F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("a"), F.sum("p").alias("pos")).select(ratio(F.col("a"), F.col("pos").cast("double")).alias("average_precision"))


def _totals(c: DataFrame) -> DataFrame:
    return c.agg(F.sum("p").alias("pos"), F.sum("n").alias("neg"))


def roc_curve(rows: DataFrame) -> DataFrame:
    c = _by_score(rows)
    return c.crossJoin(F.broadcast(_totals(c))).select(F.col("score").alias("threshold"), ratio(F.col("fp").cast("double"), F.col("neg")).alias("fpr"), ratio(F.col("tp").cast("double"), F.col("pos")).alias("tpr"))


def pr_curve(rows: DataFrame) -> DataFrame:
    c = _by_score(rows)
    return c.crossJoin(F.broadcast(_totals(c))).select(F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), ratio(F.col("tp").cast("double"), F.col("pos")).alias("recall"))
