"""Scores, selection and aggregation of variant vectors, and alignment of samples over sources."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from varloom.functions import vectors as V
from varloom.sources.scratch import kept

SCORES = ("relative", "absolute", "delta", "weighted", "cascade")


def differences(rows: DataFrame) -> DataFrame:
    """dh1, dh2, dref; null where a part is missing."""
    diff = lambda a, b: F.when(V.present(F.col(a)) & V.present(F.col(b)), V.minus(F.col(a), F.col(b)))
    return rows.withColumns({"dh1": diff("mut1", "wt1"), "dh2": diff("mut2", "wt2"), "dref": diff("mutref", "wtref")})


def scored(rows: DataFrame) -> DataFrame:
    """relative, absolute (null for incomplete records) and delta."""
    out = differences(rows)
    whole = F.col("dh1").isNotNull() & F.col("dh2").isNotNull() & F.col("dref").isNotNull()
    d = (F.col("dh1"), F.col("dh2"), F.col("dref"))
    return out.withColumns({
        "relative": F.when(whole, V.score_relative(*d)), "absolute": F.when(whole, V.score_absolute(*d)),
        "delta": V.score_delta(F.col("mut1"), F.col("wt1"), F.col("mut2"), F.col("wt2")),
    })


def represented(rows: DataFrame, strategy: str) -> DataFrame:
    vec = V.represent(strategy, *(F.col(c) for c in ("mut1", "wt1", "mut2", "wt2", "mutref", "wtref")))
    return rows.withColumn("rep", vec).filter("rep is not null")


#: Ranges of a score in which ranks are counted alone.
RANGES = 64


def rank_share(rows: DataFrame, score: str, out: str, by: str = "sample_id", order: str = "ord") -> DataFrame:
    """``out``: (rank - 1) / (n - 1) among a sample's rows that have the score, ties in the order of ``order``; one half for
    an only row, null for a row without the score.

    A sample's rows are dealt to ranges of the score, at quantiles of all rows; each range is ranked alone and starts
    after those below it, so no task needs all rows of a sample.
    """
    value = F.nanvl(F.col(score).cast("double"), F.lit(float("inf")))
    cuts = sorted(set(rows.select(value.alias("x")).approxQuantile("x", [i / RANGES for i in range(1, RANGES)], 0.005)))
    at = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value)) if cuts else F.lit(0)
    dealt = rows.withColumn("_range", F.when(F.col(score).isNotNull(), at))
    sample = Window.partitionBy("_by")
    cells = dealt.filter("_range is not null").groupBy(F.col(by).alias("_by"), F.col("_range").alias("_at")).agg(F.count("*").alias("_n"))  # RANGES rows a sample
    cells = cells.select("_by", "_at", F.coalesce(F.sum("_n").over(sample.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(sample).alias("_all"))
    # Rows without the score need no cell: one of their own, dealt by order.
    salt = F.coalesce("_range", F.pmod(F.xxhash64(order), F.lit(RANGES)).cast("int") - RANGES)
    dealt = dealt.withColumn("_range", salt)
    ranked = dealt.withColumn("_r", F.row_number().over(Window.partitionBy(by, "_range").orderBy(score, order)) - 1)
    joined = ranked.join(cells, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_at")), "left")
    share = F.when(F.col("_all") == 1, 0.5).otherwise((F.col("_r") + F.col("_before")) / (F.col("_all") - 1))
    return joined.withColumn(out, share).drop("_range", "_r", "_by", "_at", "_before", "_all")


def select_top(rows: DataFrame, how: str, k: int, weight: float = 0.5, widen: float = 3.0) -> DataFrame:
    """The k best rows of each sample with their rank; all rows, unranked, if k is 0.

    ``weighted`` mixes the rank shares of both scores; ``cascade`` takes ``widen`` times k by the absolute
    score and the k best of those by the relative one.  Rows without the score (of these two, without either) take
    no part: they are neither ranked nor kept, whatever the number of others, and shift no share.

    They come behind the others in the windows and are left out by rank: a filter before them would have scores worked
    out twice.  Spark keeps k rows of a sample in each task before it shuffles, as the limits are constants.
    """
    if how not in SCORES:
        raise ValueError(f"{how} is none of {', '.join(SCORES)}")
    if k <= 0:
        return rows.withColumn("rank", F.lit(None).cast("int"))
    sample = Window.partitionBy("sample_id")
    best = lambda df, by, n, out, *ties: df.withColumn(out, F.row_number().over(sample.orderBy(F.desc_nulls_last(by), *ties))).filter((F.col(out) <= n) & F.col(by).isNotNull())
    if how in ("weighted", "cascade"):
        both = F.col("relative").isNotNull() & F.col("absolute").isNotNull()
        rows = rows.withColumns({"_rel": F.when(both, F.col("relative")), "_abs": F.when(both, F.col("absolute"))})
    if how == "weighted":
        rows = kept(rows)  # read for both scores' ranges, counts and ranks
        rows = rank_share(rank_share(rows, "_rel", "_wr"), "_abs", "_wa")
        out = best(rows.withColumn("weighted", weight * F.col("_wr") + (1 - weight) * F.col("_wa")), "weighted", k, "rank", "ord")
    elif how == "cascade":
        out = best(best(rows, "_abs", int(k * max(widen, 1.0)), "_a", "ord"), "_rel", k, "rank", "_a")
    else:
        return best(rows, how, k, "rank", "ord")
    return out.drop("_rel", "_abs", "_wr", "_wa", "_a")


def aggregate_vectors(rows: DataFrame, column: str, how: str, by: str = "sample_id") -> DataFrame:
    """Element-wise mean or max of each sample's vectors, as (by, i, value) sums before any shuffle."""
    if how not in ("mean", "max"):
        raise ValueError("how is mean or max")
    value = F.avg("x") if how == "mean" else F.max("x")
    cells = rows.select(by, F.posexplode(column).alias("i", "x")).groupBy(by, "i").agg(value.alias("x"))
    return cells.groupBy(by).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda c: c["x"]).alias("vec"))


def common_samples(*sources: DataFrame) -> DataFrame:
    """Ids that every source has, once each."""
    out = sources[0].select("sample_id").distinct()
    for other in sources[1:]:
        out = out.join(other.select("sample_id"), "sample_id", "left_semi")
    return out


def numeric_columns(df: DataFrame, *but: str) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in but]


def refuse_repeats(source: DataFrame, name: str) -> DataFrame:
    """``source``, whose evaluation fails if an id stands there twice: it would multiply the rows of a join.

    One aggregate on the id, on which the join that follows is dealt anyway.
    """
    again = F.raise_error(F.concat(F.lit(f"{name} has sample "), F.coalesce(F.col("sample_id").cast("string"), F.lit("null")), F.lit(" more than once")))
    values = [c for c in source.columns if c != "sample_id"]
    each = source.groupBy("sample_id").agg(F.count("*").alias("_n"), F.first(F.struct(*values)).alias("_v"))
    return each.select("sample_id", F.when(F.col("_n") > 1, again).otherwise(F.col("_v")).alias("_v")).select("sample_id", "_v.*")


def feature_matrix(modalities: dict[str, DataFrame], labels: DataFrame, use: Sequence[str] | None = None) -> DataFrame:
    """sample_id, label and one array column per modality, for the samples that all have.

    A source that has an id twice is refused: it would multiply rows.
    """
    out = refuse_repeats(labels.select("sample_id", "label"), "labels")
    for name in use or modalities:
        source = modalities[name].select("sample_id", F.col("features").alias(name))
        out = out.join(refuse_repeats(source, name), "sample_id")
    return out


def select_features(rows: DataFrame, column: str, keep: Sequence[int] | Sequence[bool]) -> DataFrame:
    """Array ``column`` cut down to the places in ``keep``, in that order, or to those where a mask is true."""
    mask = bool(keep) and all(isinstance(x, bool) for x in keep)
    places = [i for i, x in enumerate(keep) if x] if mask else list(keep)
    if not places or min(places) < 0:
        raise ValueError("at least one place, none below 0")
    return rows.withColumn(column, F.array(*[F.get(F.col(column), F.lit(int(i))) for i in places]))


MODALITIES = ("emb", "metab", "pheno")
#: The modality sets of an ablation: every non-empty one, "all" for the whole.
MODULES = {"all" if n == len(MODALITIES) else "_".join(use): use for n in range(1, len(MODALITIES) + 1) for use in itertools.combinations(MODALITIES, n)}
