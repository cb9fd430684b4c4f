"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import pct
from .joins import combine
from .quantiles import median, median_by_size


def n_distinct(c: Column | str) -> Column:
    """Distinct count in which NULL is one more value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("bigint")), F.lit(0))


def sum_strict(c: Column | str) -> Column:
    """Sum that is NULL when any input is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.count(F.when(c.isNull(), 1)) == 0, F.sum(c))


def count_by(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def moments(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, sum, mean, sample sd and coefficient of variation (%)."""
    base = df.groupBy(*by) if by else df
    out = base.agg(
        F.count("*").alias("n"),
        F.sum(col).alias("total"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("sd"),
    )
    return out.withColumn("cv", pct(F.col("sd"), F.col("mean")))


def share(cond: Column, weight: Column | str | None = None) -> Column:
    """Share (%) of rows, or of a weight, for which the condition holds."""
    hit = F.coalesce(cond, F.lit(False))
    if weight is None:
        return pct(F.count_if(hit), F.count("*"))
    weight = F.col(weight) if isinstance(weight, str) else weight
    return pct(F.sum(F.when(hit, weight).otherwise(F.lit(0.0))), F.sum(weight))


def min_participation(
    df: DataFrame, actor: str, counterpart: str, min_rows: int, min_counterparts: int
) -> DataFrame:
    """Actors with enough rows and enough distinct counterparts, with both counts."""
    pairs = df.groupBy(actor, counterpart).agg(F.count("*").alias("__n"))
    out = pairs.groupBy(actor).agg(F.sum("__n").alias("n_contracts"), F.count("*").alias("n_counterparts"))
    return out.filter((F.col("n_contracts") >= min_rows) & (F.col("n_counterparts") >= min_counterparts))


def actor_profile(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    distincts: Mapping[str, Column | str],
    with_median: bool = True,
    extra: Sequence[Column] = (),
    extra_names: Sequence[str] = (),
) -> DataFrame:
    """Count, sum, mean, median, sd of the value and distinct counts, per actor.

    ``extra`` aggregates share the pass of the sums. Each distinct count is a table of its own (distinct (actor, value), then a count), so
    what travels for it is two columns and not a copy of the row with room for all sums, and one actor holding a large part of the
    rows does not end in one task. ``df`` is read once per table and twice more for the median: hand over a written one if it is costly.
    """
    by = list(by)
    out = df.groupBy(*by).agg(
        F.count("*").alias("n_contracts"),
        F.sum(value).alias("val_contracts"),
        F.avg(value).alias("val_mean"),
        F.stddev_samp(value).alias("val_sd"),
        *[c.alias(n) for c, n in zip(extra, extra_names)],
    )
    parts = [_distinct_per_group(df, by, c, n) for n, c in distincts.items()]
    middle = ["val_median"] if with_median else []
    if with_median:
        parts.append((median_by_size if by else median)(df, by, value, "val_median"))
    names = [*by, "n_contracts", "val_contracts", "val_mean", *middle, "val_sd", *distincts, *extra_names]
    return combine(by, out, *parts).select(*names)


def _distinct_per_group(df: DataFrame, by: Sequence[str], c: Column | str, name: str) -> DataFrame:
    """Distinct values per group; NULL is one more value."""
    c = F.col(c) if isinstance(c, str) else c
    return df.select(*by, c.alias("__value")).distinct().groupBy(*by).agg(F.count("*").alias(name))


def n_places(activity: DataFrame, actor: str, name: str = "n_places") -> DataFrame:
    """Number of places per actor, from an (actor, place) activity table."""
    return activity.groupBy(actor).agg(F.count("*").alias(name))


def mean_of_means(df: DataFrame, inner: Sequence[str], outer: Sequence[str], col: str, name: str = "mean") -> DataFrame:
    """Mean within the inner groups, then mean of those within the outer groups."""
    first = df.groupBy(*inner).agg(F.avg(col).alias("__m"))
    return first.groupBy(*outer).agg(F.avg("__m").alias(name))


def panel_mean(df: DataFrame, keys: Sequence[str], cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Mean of many columns per key, NULL ignored."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}{suffix}") for c in cols])


def yearly_totals(df: DataFrame, year: str, name: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """Total per year and indicator."""
    df = df.filter(F.col(value).isNotNull())
    if names:
        df = df.filter(F.col(name).isin(list(names)))
    return df.groupBy(year, name).agg(F.sum(value).alias("total"))


def place_summary(
    df: DataFrame, keys: Sequence[str], row_key: Sequence[str], name: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """Mean and sd per place of selected indicators.

    The indicators are first put side by side per ``row_key`` and then summarised; with one
    value per row and indicator both steps are conditional aggregates.
    """
    wide = (
        df.filter(F.col(name).isin(list(names)))
        .groupBy(*keys, *row_key)
        .agg(*[F.first(F.when(F.col(name) == n, F.col(value)), ignorenulls=True).alias(a) for n, a in names.items()])
    )
    aggs = []
    for alias in names.values():
        aggs += [F.avg(alias).alias(f"{alias}_mean"), F.stddev_samp(alias).alias(f"{alias}_sd")]
    return wide.groupBy(*keys).agg(*aggs)


def participation_table(df: DataFrame, by: Sequence[str], keep: Column, value: str = "value") -> DataFrame:
    """Share of actors and of value per group of excluded actors, against the whole population.

    ``df`` has one row per actor with its value; ``keep`` selects the actors that are listed.
    """
    # All groups are formed once, listed or not: the totals come from the same exchange.
    grouped = df.groupBy(*by).agg(
        F.count_if(keep).alias("__n"),
        F.sum(F.when(keep, F.col(value))).alias("__v"),
        F.count("*").alias("__all_n"),
        F.sum(value).alias("__all_v"),
    )
    total = grouped.agg(F.struct(F.sum("__all_n").alias("n"), F.sum("__all_v").alias("v")).alias("t")).scalar()
    return grouped.filter((F.col("__n") > 0) & (F.col("__all_n") > 0)).select(
        *by, pct(F.col("__n"), total["n"]).alias("pct_actors"), pct(F.col("__v"), total["v"]).alias("pct_value")
    )


def weighted_exposure(
    activity: DataFrame, panel: DataFrame, actor: str, place: str, weight: str, cols: Sequence[str]
) -> DataFrame:
    """Sum over places of indicator times activity share, NULL skipped, per actor."""
    joined = activity.join(panel, place, "left")
    return joined.groupBy(actor).agg(
        *[F.coalesce(F.sum(F.col(c) * F.col(weight)), F.lit(0.0)).alias(c) for c in cols]
    )
