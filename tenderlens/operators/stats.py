"""Profiles, correlations, histograms, densities and box summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import log10_positive, r_div
from .joins import join_null_safe
from .quantiles import quantile_struct, quantiles

_POINTS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}


_BARS = "▁▂▃▅▇"


def profile(df: DataFrame, cols: Sequence[str], bars: int = 5) -> DataFrame:
    """Missing values, completeness, mean, sd, quartiles and a text histogram of numeric columns.

    ``hist`` has one bar for each of ``bars`` equal slices from the least to the largest value, its height relative to
    the fullest slice; NULL for columns without a finite value.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    basic = long.groupBy("column").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
    )
    basic = basic.withColumn("complete_rate", 1 - F.col("n_missing") / F.col("n"))
    basic = basic.join(_bars(df, cols, bars), "column", "left")
    return basic.join(quantiles(long, ["column"], "value", _POINTS), "column", "left")


def _bars(df: DataFrame, cols: Sequence[str], bars: int) -> DataFrame:
    """(column, hist). The ranges come from a scalar subquery, so all columns are counted in one aggregate."""
    value = {c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")) for c in cols}
    ends = [f(value[c]).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]
    span = df.agg(F.struct(*ends).alias("s")).scalar()
    counts = []
    for i, c in enumerate(cols):
        lo, hi = span[f"lo_{i}"], span[f"hi_{i}"]
        slot = F.when(hi > lo, F.least(F.floor((value[c] - lo) / (hi - lo) * bars), F.lit(bars - 1))).otherwise(F.lit(0))
        counts.append(F.array(*[F.count_if(value[c].isNotNull() & (slot == k)) for k in range(bars)]).alias(f"c_{i}"))
    one = df.agg(*counts)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c_{i}").alias("k")) for i, c in enumerate(cols)])
    each = one.select(F.explode(rows).alias("x")).select("x.column", "x.k")
    glyphs = F.array(*[F.lit(g) for g in _BARS])
    top = F.array_max("k")
    bar = F.transform("k", lambda n: F.get(glyphs, F.round(n / top * (len(_BARS) - 1)).cast("int")))
    return each.select("column", F.when(top > 0, F.array_join(bar, "")).alias("hist"))


def profile_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values, empty strings, length range and distinct values of text columns."""
    long = df.select(*cols).unpivot([], list(cols), "column", "value")
    return long.groupBy("column").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.count_if(F.col("value") == "").alias("n_empty"),
        F.min(F.length("value")).alias("min_length"),
        F.max(F.length("value")).alias("max_length"),
        F.count_distinct("value").alias("n_unique"),
    )


def correlation_long(df: DataFrame, cols: Sequence[str], digits: int | None = 2) -> DataFrame:
    """Pearson correlations over complete rows as (var1, var2, value).

    One aggregate holds every covariance; a constant column gives NULL.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = data.agg(*[F.covar_pop(cols[i], cols[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    cells = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            lo, hi = min(i, j), max(i, j)
            scale = F.sqrt(F.col(f"c_{i}_{i}") * F.col(f"c_{j}_{j}"))
            value = F.when(scale > 0, F.try_divide(F.col(f"c_{lo}_{hi}"), scale))
            if digits is not None:
                value = F.bround(value, digits)
            cells.append(F.struct(F.lit(cols[i]).alias("var1"), F.lit(cols[j]).alias("var2"), value.alias("value")))
    return row.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def histogram(
    df: DataFrame, col: str, by: Sequence[str] = (), bins: int = 30, log10: bool = False
) -> DataFrame:
    """Counts over equal-width bins of the common range, per facet."""
    v = log10_positive(F.col(col)) if log10 else F.col(col).cast("double")
    data = df.select(*by, v.alias("__v")).filter(F.col("__v").isNotNull())
    r = data.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi")).alias("r")).scalar()
    width = (r["hi"] - r["lo"]) / bins
    at = F.coalesce(F.floor(r_div(F.col("__v") - r["lo"], width)), F.lit(0))
    binned = data.withColumn("bin", F.least(at, F.lit(bins - 1)).cast("int")).groupBy(*by, "bin").agg(
        F.count("*").alias("n")
    )
    return binned.select(*by, "bin", (r["lo"] + F.col("bin") * width).alias("bin_start"), "n")


def density(df: DataFrame, col: str, by: Sequence[str] = (), points: int = 128, log10: bool = False) -> DataFrame:
    """Gaussian kernel density on an even grid over the common range, per facet.

    Values are first spread linearly over their two neighbouring grid points, so what meets the
    grid is at most ``points`` weights per facet however many rows there are. The bandwidth is
    0.9 * min(sd, IQR / 1.34) * n^(-1/5).
    """
    v = log10_positive(F.col(col)) if log10 else F.col(col).cast("double")
    by = list(by)
    data = df.select(*by, v.alias("__v")).filter(F.col("__v").isNotNull())
    grouped = data.groupBy(*by) if by else data
    spread = grouped.agg(F.count("*").alias("__n"), F.stddev_samp("__v").alias("__sd"))
    quarters = {"__q1": 0.25, "__q3": 0.75}
    if by:
        scale = join_null_safe(spread, quantiles(data, by, "__v", quarters), by, "inner")
    else:
        q = quantile_struct(data, "__v", quarters)
        scale = spread.withColumns({n: q[n] for n in quarters})
    iqr = (F.col("__q3") - F.col("__q1")) / 1.34
    bw = 0.9 * F.when(iqr > 0, F.least("__sd", iqr)).otherwise(F.col("__sd")) * F.pow(F.col("__n"), F.lit(-0.2))
    scale = scale.select(*by, "__n", bw.alias("__bw")).filter(F.col("__bw") > 0)

    r = data.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi")).alias("r")).scalar()
    step = (r["hi"] - r["lo"]) / (points - 1)
    pos = F.coalesce(r_div(F.col("__v") - r["lo"], step), F.lit(0.0))
    data = data.withColumn("__pos", pos)
    left = F.least(F.floor("__pos"), F.lit(points - 2)).cast("int")
    data = data.withColumn("__i", left).withColumn("__w", F.col("__pos") - F.col("__i"))
    halves = F.array(
        F.struct(F.col("__i").alias("g"), (1 - F.col("__w")).alias("w")),
        F.struct((F.col("__i") + 1).alias("g"), F.col("__w").alias("w")),
    )
    mass = (
        data.select(*by, F.explode(halves).alias("h"))
        .groupBy(*by, F.col("h.g").alias("__g"))
        .agg(F.sum("h.w").alias("__m"))
    )
    if by:
        mass = join_null_safe(mass, scale, by, "inner")
    else:
        s = scale.select(F.struct("__n", "__bw").alias("s")).scalar()
        mass = mass.withColumns({"__n": s["__n"], "__bw": s["__bw"]}).filter(F.col("__bw").isNotNull())
    mass = mass.withColumn("__step", step)
    on_grid = mass.withColumn("grid", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    u = (F.col("grid") - F.col("__g")) * F.col("__step") / F.col("__bw")
    kernel = F.exp(-0.5 * u * u) * F.lit(0.3989422804014327) / F.col("__bw")
    out = on_grid.groupBy(*by, "grid").agg(F.sum(F.col("__m") * kernel / F.col("__n")).alias("density"))
    return out.select(*by, "grid", (r["lo"] + F.col("grid") * step).alias("x"), "density")


def box_stats(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and number of points beyond them, per group."""
    by = list(by)
    q = quantiles(df, by, col, {"q1": 0.25, "med": 0.5, "q3": 0.75})
    v, reach = F.col(col), 1.5 * (F.col("q3") - F.col("q1"))
    inside = (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach)
    rows = join_null_safe(df.select(*by, col), q, by, "inner")
    # the quartiles are constant within a group
    return rows.groupBy(*by, "q1", "med", "q3").agg(
        F.min(F.when(inside, v)).alias("low_whisker"),
        F.max(F.when(inside, v)).alias("high_whisker"),
        F.count_if(~inside).alias("n_outliers"),
    )
