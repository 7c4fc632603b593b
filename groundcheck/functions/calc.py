"""Registered calculations: a name and its inputs give a column. More can be registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def yoy_growth(current: Column, prior: Column) -> Column:
    return F.try_divide(current - prior, prior)


def margin(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def eps_growth(current_eps: Column, prior_eps: Column) -> Column:
    return yoy_growth(current_eps, prior_eps)


#: Name -> (function, input names).
REGISTRY: dict[str, tuple[Callable[..., Column], tuple[str, ...]]] = {
    "yoy_growth": (yoy_growth, ("current", "prior")),
    "margin": (margin, ("numerator", "denominator")),
    "eps_growth": (eps_growth, ("current_eps", "prior_eps")),
}


def recompute(name: Column, inputs: Column, registry: dict | None = None) -> Column:
    """Value of the named calculation over a map of inputs; null for an unknown name, wrong input
    names, a null input or a zero divisor."""
    result = F.lit(None).cast("double")
    for known, (function, wanted) in (registry or REGISTRY).items():
        fits = F.array_sort(F.map_keys(inputs)) == F.array(*[F.lit(w) for w in sorted(wanted)])
        result = F.when((name == known) & fits, function(*[F.try_element_at(inputs, F.lit(w)) for w in wanted])).otherwise(result)
    return result


def within_tolerance(recomputed: Column, asserted: Column, absolute: float = 0.005, relative: float = 0.01) -> Column:
    return F.abs(recomputed - asserted) <= F.greatest(F.lit(absolute), F.lit(relative) * F.abs(recomputed))
