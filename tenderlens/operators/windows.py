"""Window-style operators written so that one hot group does not sit in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import r_div
from ..session import cut_lineage
from .aggregates import n_distinct
from .joins import join_null_safe, prior_period


def share_of_total(df: DataFrame, part: Sequence[str], col: str, name: str = "share") -> DataFrame:
    """Value divided by the total of its group."""
    totals = df.groupBy(*part).agg(F.sum(col).alias("__total"))
    return join_null_safe(df, totals, part).withColumn(name, r_div(F.col(col), F.col("__total"))).drop("__total")


def group_size(df: DataFrame, part: Sequence[str], name: str = "n") -> DataFrame:
    """Number of rows of the group on every row."""
    return join_null_safe(df, df.groupBy(*part).agg(F.count("*").alias(name)), part)


def n_distinct_over(df: DataFrame, part: Sequence[str], col: str, name: str = "n_distinct") -> DataFrame:
    """Distinct count of the group (NULL is a value) on every row."""
    return join_null_safe(df, df.groupBy(*part).agg(n_distinct(col).alias(name)), part)


def head_per_group(df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows per group. Spark keeps n rows per group and task before the shuffle."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n).drop("__r")


def slice_max(df: DataFrame, part: Sequence[str], col: str, tie: Sequence[str]) -> DataFrame:
    """Row with the largest value of any ordered type per group, ties settled by the smallest ``tie`` columns.

    Spark keeps one row per group and task before the shuffle.
    """
    rest = [c for c in df.columns if c not in part]
    w = Window.partitionBy(*part).orderBy(F.col(col).desc_nulls_last(), *tie)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1).select(*part, *rest).select(*df.columns)


def slice_min(df: DataFrame, part: Sequence[str], col: str) -> DataFrame:
    """Rows with the smallest value per group, ties kept."""
    least = df.groupBy(*part).agg(F.min(col).alias("__least"))
    return join_null_safe(df, least, part, "inner").filter(F.col(col) == F.col("__least")).drop("__least")


def with_row_id(df: DataFrame, order: Sequence[Column], name: str = "row_id") -> DataFrame:
    """Dense row numbers from 1 over a total order, without a single-task window.

    The rows are range-sorted once and written to reliable storage; per-partition counts then
    give each partition its offset. The offset table has one row per partition.
    """
    sorted_rows = df.orderBy(*order).withColumn("__pos", F.monotonically_increasing_id())
    fixed = cut_lineage(sorted_rows)
    part = F.shiftright("__pos", 33)
    counts = fixed.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    # one row per partition, so this window is bounded by the partition count
    w = Window.partitionBy(F.lit(0)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    inside = F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        fixed.withColumn("__p", part)
        .join(F.broadcast(offsets), "__p", "inner")
        .withColumn(name, F.col("__off") + inside + 1)
        .select(*df.columns, name)
    )


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Global z-scores. Mean and sd come from a scalar subquery, not from a global window."""
    stats = [F.avg(c).alias(f"m_{c}") for c in cols] + [F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    s = df.agg(F.struct(*stats).alias("s")).scalar()
    return df.withColumns({f"{c}{suffix}": r_div(F.col(c) - s[f"m_{c}"], s[f"s_{c}"]) for c in cols})


def outliers_z(df: DataFrame, col: str, limit: float = 3.0) -> DataFrame:
    z = f"{col}_z"
    return zscore(df, [col]).filter((F.col(z) > limit) | (F.col(z) < -limit))


def period_changes(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    cols: Sequence[str] = (),
    flags: Mapping[str, str] | None = None,
    digits: int | None = 4,
    exact: Sequence[str] = (),
    suffix: str = "_r",
) -> DataFrame:
    """Percentage changes (``exact`` columns unrounded) and persistent flags against the previous period.

    All measures share one pass and one window; rows without a previous period are dropped.
    """
    flags = flags or {}
    prev = prior_period(df, keys, t, [*cols, *flags], suffix="__prev")
    out = {}
    for c in cols:
        change = r_div(F.col(c), F.col(f"{c}__prev")) - 1
        if digits is not None and c not in exact:
            # rounding is defined for finite numbers only
            finite = (change < F.lit(float("inf"))) & (change > F.lit(float("-inf")))
            change = F.when(finite, F.bround(change, digits)).otherwise(change)
        out[f"{c}{suffix}"] = change * 100
    for c, name in flags.items():
        out[name] = F.when((F.col(c) == 1) & (F.col(f"{c}__prev") == 1), 1).otherwise(0)
    return prev.withColumns(out).select(*keys, t, *out)


def rate_of_change(
    df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str], digits: int | None = 4, suffix: str = "_r"
) -> DataFrame:
    """Percentage change against the previous period; rows without one are dropped."""
    return period_changes(df, keys, t, cols, digits=digits, suffix=suffix)


def persistent_flag(df: DataFrame, keys: Sequence[str], t: str, flags: Mapping[str, str]) -> DataFrame:
    """1 when a flag is set in two consecutive periods (``flags``: flag column -> result column)."""
    return period_changes(df, keys, t, flags=flags)
