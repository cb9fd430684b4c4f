"""Concentration and red-flag indicators per actor.

Everything per (actor, counterpart) comes from one pre-aggregate. Shares are never attached to
rows: the indices are rewritten as ratios of sums, so each is a plain partial aggregate and an
actor with a third of all rows costs no more than its number of map-side partials.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import in_set, pct, r_div
from ..session import cut_lineage
from .aggregates import share
from .joins import combine


def pair_totals(df: DataFrame, actor: str, counterpart: str, value: str, *extra: Column) -> DataFrame:
    """Rows and value per (actor, counterpart)."""
    return df.groupBy(actor, counterpart).agg(F.count("*").alias("n"), F.sum(value).alias("v"), *extra)


def hhi_of(part: str) -> Column:
    """Herfindahl-Hirschman index on the 0-100 scale from the parts of one actor."""
    x = F.col(part).cast("double")
    return r_div(F.sum(x * x), F.sum(x) * F.sum(x)) * 100


def hhi(df: DataFrame, actor: str, counterpart: str, value: str) -> DataFrame:
    pairs = pair_totals(df, actor, counterpart, value)
    return pairs.groupBy(actor).agg(hhi_of("n").alias("num_hhi"), hhi_of("v").alias("val_hhi"))


def top_k_total(pairs: DataFrame, actor: str, counterpart: str, part: str, k: int, name: str) -> DataFrame:
    """Sum of the k largest parts of each actor.

    The rank filter is applied inside each map task before the shuffle, so an actor sends at most
    k rows per task.
    """
    w = Window.partitionBy(actor).orderBy(F.desc(part), F.asc(counterpart))
    top = pairs.select(actor, counterpart, part).withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k)
    return top.groupBy(actor).agg(F.sum(part).alias(name))


RATIO_NAMES = ("pnum_ick", "pval_ick")


def index_from_pairs(
    pairs: DataFrame, actor: str, counterpart: str, k: int, *extra: Column, names: Sequence[str] = RATIO_NAMES
) -> DataFrame:
    """``extra`` aggregates and the k-firm ratios by count and value, per actor, from pair totals.

    With k = 1 the largest part is a maximum and everything is one aggregate.
    """
    if k == 1:
        tops = [pct(F.max(c), F.sum(c)).alias(name) for c, name in zip(("n", "v"), names)]
        return pairs.groupBy(actor).agg(*extra, *tops)
    # three readers with different columns: write the pair totals once instead of three full scans
    pairs = cut_lineage(pairs)
    base = pairs.groupBy(actor).agg(*extra, F.sum("n").alias("__tn"), F.sum("v").alias("__tv"))
    out = combine(
        [actor],
        base,
        top_k_total(pairs, actor, counterpart, "n", k, "__kn"),
        top_k_total(pairs, actor, counterpart, "v", k, "__kv"),
    )
    ratios = {names[0]: pct(F.col("__kn"), F.col("__tn")), names[1]: pct(F.col("__kv"), F.col("__tv"))}
    return out.withColumns(ratios).drop("__tn", "__tv", "__kn", "__kv")


def concentration_ratio(
    df: DataFrame, actor: str, counterpart: str, value: str, k: int, names: Sequence[str] = RATIO_NAMES
) -> DataFrame:
    """Share of the k most important counterparts by count and by value."""
    return index_from_pairs(pair_totals(df, actor, counterpart, value), actor, counterpart, k, names=names)


def closed_share(df: DataFrame, by: Sequence[str], process: str, closed: Sequence, value: str) -> DataFrame:
    """Share of contracts and of value awarded without open competition."""
    cond = in_set(F.col(process), closed)
    return df.groupBy(*by).agg(share(cond).alias("pnum_closed"), share(cond, value).alias("pval_closed"))


def winners_rate(df: DataFrame, by: Sequence[str], counterpart: str) -> DataFrame:
    """Distinct counterparts per 100 contracts."""
    pairs = df.groupBy(*by, counterpart).agg(F.count("*").alias("__n"))
    return pairs.groupBy(*by).agg(pct(F.count("*"), F.sum("__n")).alias("pnum_winners"))


def extension_share(df: DataFrame, by: Sequence[str], extension: str, term: str) -> DataFrame:
    """Share of contracts extended and share of extra days in the total term."""
    ext, total = F.col(extension), F.col(extension) + F.col(term)
    return df.groupBy(*by).agg(
        share(ext > 0).alias("pnum_extended"), pct(F.sum(ext), F.sum(total)).alias("pval_extended")
    )


def addition_share(df: DataFrame, by: Sequence[str], addition: str, value: str) -> DataFrame:
    """Share of contracts with additions and share of added value."""
    add = F.col(addition)
    return df.groupBy(*by).agg(share(add > 0).alias("pnum_added"), pct(F.sum(add), F.sum(value)).alias("pval_added"))
