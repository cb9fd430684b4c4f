"""Exact interpolated quantiles of groups of any size, by selection instead of a sort.

Distinct values with their counts are dealt by (group, slice, value). A slice is a range of values a 256th of a doubling
wide, known from the value alone, so a large group is spread over many tasks. The sizes of a group's slices, a
short list, tell which slices hold the ranks that are asked for; only those slices' values are ranked.
One plan serves all sizes; nothing is written or run when it is built. Over a written table, ``median_by_size`` lists the
values of the groups that are small, so that their values travel once, and leaves the others to the slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import join_null_safe

#: Groups of at most this many rows are small: their values are listed in memory
SMALL = 10_000


def slice_of(v: Column) -> Column:
    """A number that never falls as the value grows. Doubles span 2 ** -1074 to 2 ** 1024."""
    size = F.abs(v)
    slot = F.when(size == float("inf"), F.lit(600_000)).when(size > 0, F.floor(F.log2(size) * 256) + 300_000).otherwise(F.lit(0))
    return F.when(v < 0, -slot).otherwise(slot).cast("int")


def quantiles(df: DataFrame, by: Sequence[str], col: str, probs: Mapping[str, float]) -> DataFrame:
    """One row per group with a column per name in ``probs`` (linear interpolation, R type 7).

    NaN counts as missing and infinities as the largest and smallest values; a group without a value has NULLs.
    """
    by = list(by)
    keys = by or ["__all"]
    v = F.col(col).cast("double")
    base = df.select(*by, F.when(~F.isnan(v), v).alias("__v"))
    if not by:
        base = base.withColumn("__all", F.lit(1))
    counts = base.groupBy(*keys, slice_of(F.col("__v")).alias("__s"), "__v").agg(F.count("*").alias("__n"))
    values = counts.filter(F.col("__v").isNotNull())

    # which slices hold a rank that is asked for
    sizes = values.groupBy(*keys, "__s").agg(F.sum("__n").alias("__m"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *keys,
        "__s",
        "__m",
        F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__before"),
        F.sum("__m").over(whole).alias("__total"),
    )
    ranks = []
    for p in probs.values():
        h = (F.col("__total") - 1) * F.lit(float(p))
        ranks += [F.floor(h), F.ceil(h)]
    wanted = F.lit(False)
    for rank in ranks:
        wanted = wanted | ((rank >= F.col("__before")) & (rank < F.col("__before") + F.col("__m")))
    inside = Window.partitionBy(*keys, "__s").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = join_null_safe(values, sizes.filter(wanted).drop("__m"), [*keys, "__s"], "inner").withColumn("__hi", F.sum("__n").over(inside))
    hi = F.col("__before") + F.col("__hi")
    lo = hi - F.col("__n")

    ends = []
    for i, p in enumerate(probs.values()):
        h = (F.col("__total") - 1) * F.lit(float(p))
        for end, rank in (("a", F.floor(h)), ("z", F.ceil(h))):
            ends.append(F.max(F.when((rank >= lo) & (rank < hi), F.col("__v"))).alias(f"__{end}{i}"))
    if by:  # groups without a value still get a row
        ranked = ranked.unionByName(base.filter(F.col("__v").isNull()).select(*keys), allowMissingColumns=True)
    found = ranked.groupBy(*keys).agg(F.max("__total").alias("__total"), *ends)
    out = []
    for i, (name, p) in enumerate(probs.items()):
        h = (F.col("__total") - 1) * F.lit(float(p))
        a, z = F.col(f"__a{i}"), F.col(f"__z{i}")
        out.append(F.when(a == z, a).otherwise(a + (h - F.floor(h)) * (z - a)).alias(name))
    found = found.select(*keys, *out)
    if by:
        return found
    one = df.sparkSession.range(1).select(F.lit(1).alias("__all"))
    return join_null_safe(one, found, keys, "left").select(*probs)


def median(df: DataFrame, by: Sequence[str], col: str, name: str = "median") -> DataFrame:
    return quantiles(df, by, col, {name: 0.5})


def median_by_size(df: DataFrame, by: Sequence[str], col: str, name: str = "median") -> DataFrame:
    """``median`` over a written table, which is read once more to find the groups of more than ``SMALL`` rows.

    The keys of these, at most one per ``SMALL`` rows, are written.
    """
    by = list(by)
    large = df.groupBy(*by).agg(F.count("*").alias("__n")).filter(F.col("__n") > SMALL)
    large = cut_lineage(large.select(*by))
    v = F.col(col).cast("double")
    # 0.0 is added because -0.0 is no value of its own
    base = df.select(*by, F.when(~F.isnan(v), v + F.lit(0.0)).alias("__v"))
    few = join_null_safe(base, large, by, "left_anti")
    listed = few.groupBy(*by).agg(F.sort_array(F.collect_list("__v")).alias("__list"))
    h = (F.size("__list") - 1) * F.lit(0.5)
    a, z = F.get("__list", F.floor(h).cast("int")), F.get("__list", F.ceil(h).cast("int"))
    listed = listed.select(*by, F.when(a == z, a).otherwise(a + (h - F.floor(h)) * (z - a)).alias(name))
    return listed.unionByName(median(join_null_safe(base, large, by, "left_semi"), by, "__v", name))


def quantile_struct(df: DataFrame, col: str, probs: Mapping[str, float]):
    """Global quantiles as one struct-valued scalar subquery column."""
    q = quantiles(df, [], col, probs)
    return q.select(F.struct(*[F.col(n) for n in probs]).alias("q")).scalar()
