"""Column expressions over ARRAY<DOUBLE> vectors.  An empty or null array stands for a missing vector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(a: Column) -> Column:
    return a.isNotNull() & (F.size(a) > 0)


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def mean_of(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + y) / 2)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either norm is 0."""
    return F.when((norm(a) == 0) | (norm(b) == 0), F.lit(0.0)).otherwise(dot(a, b) / (norm(a) * norm(b)))


def score_relative(d1: Column, d2: Column, dref: Column) -> Column:
    return 1 - (cosine(d1, dref) + cosine(d2, dref)) / 2


def score_absolute(d1: Column, d2: Column, dref: Column) -> Column:
    return norm(d1) + norm(d2) + norm(dref)


def score_delta(mut1: Column, wt1: Column, mut2: Column, wt2: Column) -> Column:
    """Norm of the mean difference; Mut1 alone without WT1, haplotype 1 alone without both of haplotype 2."""
    d1 = F.when(present(wt1), minus(mut1, wt1)).otherwise(mut1)
    d = F.when(present(mut2) & present(wt2), mean_of(d1, minus(mut2, wt2))).otherwise(d1)
    return F.when(present(mut1), norm(d)).otherwise(F.lit(0.0))


STRATEGIES = ("mut_hap1", "mut_hap2", "mut_hap1_hap2_mean", "mut_hap1_hap2_concat", "mut_mean_minus_wt_ref", "mut_concat_minus_wt_ref", "baseline_delta_deltaref")


def represent(strategy: str, mut1: Column, wt1: Column, mut2: Column, wt2: Column, mutref: Column, wtref: Column) -> Column:
    """One vector for a variant; null without Mut1.  A part counts if it is as long as Mut1; without it
    the strategies fall back to what there is, and an unknown one to Mut1."""
    has = lambda a: F.coalesce(F.size(a) == F.size(mut1), F.lit(False))
    zeros = F.transform(mut1, lambda x: F.lit(0.0))
    mean = F.when(has(mut2), mean_of(mut1, mut2)).otherwise(mut1)
    if strategy == "mut_hap2":
        out = F.when(has(mut2), mut2).otherwise(mut1)
    elif strategy == "mut_hap1_hap2_mean":
        out = mean
    elif strategy == "mut_hap1_hap2_concat":
        out = F.when(has(mut2), F.concat(mut1, mut2)).otherwise(mut1)
    elif strategy == "mut_mean_minus_wt_ref":
        out = F.when(has(wtref), minus(mean, wtref)).otherwise(mean)
    elif strategy == "mut_concat_minus_wt_ref":
        left = F.when(has(wtref), minus(mut1, wtref)).otherwise(mut1)
        right = F.when(has(wtref) & has(mut2), minus(mut2, wtref)).when(has(mut2), mut2).otherwise(mut1)
        out = F.concat(left, right)
    elif strategy == "baseline_delta_deltaref":
        base = F.when(has(wt1) & has(wt2), mean_of(wt1, wt2)).when(has(wt1), wt1).otherwise(zeros)
        first = F.when(has(wt1), minus(mut1, wt1)).otherwise(zeros)
        delta = F.when(has(mut2) & has(wt2), mean_of(first, minus(mut2, wt2))).otherwise(first)
        against = F.when(has(mutref) & has(wtref), minus(mutref, wtref)).otherwise(zeros)
        out = F.concat(base, delta, against)
    else:
        out = mut1
    return F.when(present(mut1), out)


def pool(hidden: Column, mask: Column, method: str) -> Column:
    """Token vectors to one vector by the mask: mean, max or last_token."""
    if method == "last_token":
        return F.element_at(hidden, F.greatest(F.aggregate(mask, F.lit(0), lambda s, m: s + m), F.lit(1)))
    kept = F.transform(F.filter(F.arrays_zip(hidden.alias("h"), mask.alias("m")), lambda t: t["m"] == 1), lambda t: t["h"])
    return reduce_tokens(kept, method)


def tail_pool(hidden: Column, mask: Column, width: Column, method: str) -> Column:
    """The last ``width`` valid tokens (all, if fewer), mean or max; either side of padding."""
    kept = F.transform(F.filter(F.arrays_zip(hidden.alias("h"), mask.alias("m")), lambda t: t["m"] == 1), lambda t: t["h"])
    n = F.least(width, F.size(kept))
    return reduce_tokens(F.slice(kept, F.size(kept) - n + 1, n), method)


def reduce_tokens(tokens: Column, method: str) -> Column:
    if method not in ("mean", "max"):
        raise ValueError(f"pooling is mean, max or last_token, not {method}")
    rest, first = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), F.element_at(tokens, 1)
    join = (lambda x, y: F.greatest(x, y)) if method == "max" else (lambda x, y: x + y)
    out = F.aggregate(rest, first, lambda s, t: F.zip_with(s, t, join))
    if method == "mean":
        out = F.transform(out, lambda x: x / F.size(tokens))
    return F.when(F.size(tokens) > 0, out)
