"""Pivots with declared values, unpivots and binning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import map_values
from .quantiles import quantile_struct


def widen(
    df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence, prefix: str = "", fill=None
) -> DataFrame:
    """Long to wide for one value column. The values are declared, so no extra job lists them."""
    out = df.groupBy(*keys).pivot(name, list(values)).agg(F.max(value))
    out = out.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})
    return out if fill is None else out.fillna(fill, subset=[f"{prefix}{v}" for v in values])


def widen_many(
    df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str], values: Sequence, fill=0
) -> DataFrame:
    """Long to wide for many value columns, named ``<column>_<period>``."""
    if not values:
        return df.select(*keys).distinct()
    aggs = [F.max(F.when(F.col(t) == v, F.col(c))).alias(f"{c}_{v}") for c in cols for v in values]
    out = df.groupBy(*keys).agg(*aggs)
    # the keys are left alone: a NULL actor must not become the actor 0
    return out if fill is None else out.fillna(fill, subset=[f"{c}_{v}" for c in cols for v in values])


def lengthen(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "name", value: str = "value"):
    """Wide to long."""
    return df.unpivot(list(keys), list(cols), name, value)


def period_bins(
    df: DataFrame, year: str, width: int = 2, name: str = "period", years: DataFrame | None = None
) -> tuple[DataFrame, list[int]]:
    """Equal-width, right-closed year bins numbered from 1; also returns the bin numbers.

    The number of bins is the number of distinct years over ``width``, rounded down. ``years`` may
    supply the rows that define the bins.
    """
    lo, hi, n = (df if years is None else years).agg(F.min(year), F.max(year), F.count_distinct(year)).first()
    k = max(int((n or 0) // width), 1)
    y = F.col(year)
    if n and hi > lo:
        # the number of the first right edge at or above the year
        bin_no = F.greatest(F.lit(1), F.ceil((y - F.lit(lo)) * F.lit(k) / F.lit(hi - lo)).cast("int"))
    else:
        bin_no = F.lit(1)
    return df.withColumn(name, F.when(y.isNotNull(), bin_no)), list(range(1, k + 1))


def quantile_bucket(
    df: DataFrame, col: str, probs: Sequence[float], labels: Sequence[str], name: str = "bucket"
) -> DataFrame:
    """Label by quantile interval, right-closed, the lowest value included."""
    if len(labels) != len(probs) - 1:
        raise ValueError("need one label per interval")
    q = quantile_struct(df, col, {f"q{i}": p for i, p in enumerate(probs)})
    v = F.col(col)
    out = F.when(v < q["q0"], F.lit(None).cast("string"))
    for i, label in enumerate(labels, 1):
        out = out.when(v <= q[f"q{i}"], F.lit(label))
    return df.withColumn(name, out)


def select_indicators(
    df: DataFrame, name: str, renames: Mapping[str, str], year: str | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Keep the listed indicators and years and give the indicators their new names."""
    df = df.filter(F.col(name).isin(list(renames)))
    if years:
        df = df.filter(F.col(year).between(*years))
    return map_values(df, name, renames)
