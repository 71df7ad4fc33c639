"""Scores of allele effects from predicted logits and counts; arrays are folded natively."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

LN2 = math.log(2.0)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not once for each element of a fold inside."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mean(name: str) -> Column:
    """Mean of a column of doubles, the same whatever the order of rows and the number of tasks: decimals of up to 18 places are summed
    and divided exactly. With a number beyond 10^15, an infinite one or NaN among them it is the mean of doubles. Nulls do not count."""
    value = F.col(name).cast("double")
    exact = F.abs(value) < 1e15
    # a sum beyond 38 digits is null
    mean_ = F.try_avg(F.when(exact, value.cast("decimal(38,18)"))).cast("double")
    return F.coalesce(F.when(F.count_if(~exact) == 0, mean_), F.avg(value))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))


def log2_fold_change(ref_logcounts: Column, alt_logcounts: Column) -> Column:
    return (alt_logcounts - ref_logcounts) / F.lit(LN2)


def softmax(logits: Column) -> Column:
    """Probabilities; the largest logit is taken off first, so nothing overflows."""
    grown = let(F.array_max(logits).cast("double"), lambda top: F.transform(logits, lambda x: F.exp(x.cast("double") - top)))
    return let(grown, lambda g: let(total(g), lambda s: F.transform(g, lambda x: x / s)))


def _entropy_terms(p: Column, m: Column) -> Column:
    return total(F.zip_with(p, m, lambda a, b: F.when(a > 0, a * F.log2(a / b)).otherwise(0.0)))


def jensen_shannon_distance(ref_logits: Column, alt_logits: Column) -> Column:
    """Square root of the base-2 divergence between the two softmax profiles: 0 for equal, 1 for disjoint ones."""
    def distance(p: Column, q: Column) -> Column:
        m = F.zip_with(p, q, lambda a, b: (a + b) / 2)
        return F.sqrt(F.greatest((_entropy_terms(p, m) + _entropy_terms(q, m)) / 2, F.lit(0.0)))

    return let(softmax(ref_logits), lambda p: let(softmax(alt_logits), lambda q: distance(p, q)))


def quantile_below(sorted_values: Column, x: Column) -> Column:
    """Share of the distribution strictly below ``x``."""
    return F.size(F.filter(sorted_values, lambda v: v < x)) / F.size(sorted_values)


def active_allele_quantile(sorted_values: Column, ref: Column, alt: Column) -> Column:
    return F.greatest(quantile_below(sorted_values, ref), quantile_below(sorted_values, alt))


def integrative_score(lfc: Column, jsd: Column, quantile: Column) -> Column:
    return lfc * jsd * quantile


def counts_log2fc(ref: Column, alt: Column) -> Column:
    return (total(alt) - total(ref)) / F.lit(LN2)


def profile_l1(ref: Column, alt: Column) -> Column:
    return total(F.zip_with(ref, alt, lambda r, a: F.abs(a.cast("double") - r.cast("double"))))


def counts_profile(logits: Column, log_counts: Column) -> Column:
    """Profile that sums to the predicted counts."""
    return let(F.exp(log_counts), lambda n: F.transform(softmax(logits), lambda x: x * n))


def max_abs(values: Column) -> Column:
    """Largest absolute value; nulls and NaN are left out, none left gives null."""
    return F.array_max(F.transform(F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x)), lambda x: F.abs(x)))
