"""Risk indicators per actor: whole period, by period, composite index and consolidation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.aggregates import actor_profile, min_participation, n_places
from ..operators.concentration import RATIO_NAMES, hhi_of, index_from_pairs, pair_totals
from ..operators.joins import combine, join_null_safe
from ..operators.quantiles import quantile_struct
from ..operators.reshape import period_bins, widen_many
from ..operators.windows import period_changes
from ..session import cut_lineage

RELATIVE_CUTS = (0.444, 0.744)
BUYER_CUTS = (15.0, 30.0)
SUPPLIER_CUTS = (60.0, 80.0)
BANDS = ("Bajo", "Medio", "Alto")


@dataclass(frozen=True)
class Roles:
    """Which columns play which part, and the thresholds of one kind of actor."""

    actor: str
    counterpart: str
    value: str = "val"
    addition: str = "addition"
    extension: str = "ext_days"
    term: str = "term"
    process: str = "process_type"
    closed: tuple = ("4-NOT SPECIFIED",)
    signed: str = "signed"
    min_contracts: int = 6
    min_counterparts: int = 5
    k: int = 4
    #: attributes that come along with the actor, as its order level; of several values the smallest
    carried: tuple = ()
    distincts: Mapping[str, str] = field(default_factory=lambda: {"n_families": "family", "n_groups": "grp"})


BUYERS = Roles("buyer_id", "supplier_id")
SUPPLIERS = Roles("supplier_id", "buyer_id", min_contracts=3, min_counterparts=2, k=1)


def eligible(df: DataFrame, r: Roles, contracts: DataFrame | None = None) -> DataFrame:
    """Rows of the actors with enough participation in ``contracts`` (by default ``df`` itself)."""
    source = df if contracts is None else contracts
    actors = min_participation(source, r.actor, r.counterpart, r.min_contracts, r.min_counterparts)
    return join_null_safe(df, actors.select(r.actor), [r.actor], "left_semi")


def _flags(r: Roles) -> list[Column]:
    """Partial sums per (actor, counterpart) from which the red-flag shares follow."""
    closed = S.in_set(F.col(r.process), r.closed)
    ext, add = F.col(r.extension), F.col(r.addition)
    return [
        F.count_if(closed).alias("closed_n"),
        F.sum(F.when(closed, F.col(r.value)).otherwise(0.0)).alias("closed_v"),
        F.count_if(ext > 0).alias("ext_n"),
        F.sum(ext).alias("ext_d"),
        F.sum(ext + F.col(r.term)).alias("term_d"),
        F.count_if(add > 0).alias("add_n"),
        F.sum(add).alias("add_v"),
    ]


def _shares(total) -> list[Column]:
    """The red-flag shares; ``total`` gives the sum of a partial sum over an actor."""
    return [
        S.pct(total("closed_n"), total("n")).alias("pnum_closed"),
        S.pct(total("closed_v"), total("v")).alias("pval_closed"),
        S.pct(total("n_counterparts"), total("n")).alias("pnum_winners"),
        S.pct(total("ext_n"), total("n")).alias("pnum_extended"),
        S.pct(total("ext_d"), total("term_d")).alias("pval_extended"),
        S.pct(total("add_n"), total("n")).alias("pnum_added"),
        S.pct(total("add_v"), total("v")).alias("pval_added"),
    ]


def red_flags(df: DataFrame, r: Roles) -> DataFrame:
    """Concentration and red-flag shares of the eligible actors from one pre-aggregate."""
    pairs = pair_totals(df, r.actor, r.counterpart, r.value, *_flags(r))
    out = index_from_pairs(
        pairs,
        r.actor,
        r.counterpart,
        r.k,
        F.sum("n").alias("__n"),
        F.count("*").alias("n_counterparts"),
        hhi_of("n").alias("num_hhi"),
        hhi_of("v").alias("val_hhi"),
        *_shares(lambda c: F.count("*") if c == "n_counterparts" else F.sum(c)),
    )
    return _enough(out, r).drop("__n")


def _enough(index: DataFrame, r: Roles) -> DataFrame:
    return index.filter((F.col("__n") >= r.min_contracts) & (F.col("n_counterparts") >= r.min_counterparts))


_SUMS = ("closed_n", "closed_v", "ext_n", "ext_d", "term_d", "add_n", "add_v")


def actor_indicators(df: DataFrame, r: Roles) -> DataFrame:
    """Profile, concentration and red flags of one kind of actor over the whole period.

    The (actor, counterpart) pre-aggregate supplies participation, HHI and top-k and has only rows and value; the sums of the
    shares come per actor from the profile's pass over the contracts, so pairs do not carry them.
    """
    extra = [*[F.min(c) for c in r.carried], *_flags(r)]
    facts = actor_profile(df, [r.actor], r.value, dict(r.distincts), extra=extra, extra_names=[*r.carried, *_SUMS])
    index = concentration(df, r, keep_counts=True).drop("n_contracts")
    # actors below the participation limits have a profile only
    both = combine([r.actor], index, facts).filter(F.col("n_counterparts").isNotNull())
    names = {"n": "n_contracts", "v": "val_contracts"}
    ratios = [c for c in index.columns if c in RATIO_NAMES]
    rest = [c for c in facts.columns if c != r.actor and c not in _SUMS]
    levels = [c for c in index.columns if c not in RATIO_NAMES]
    return both.select(*levels, *_shares(lambda c: F.col(names.get(c, c))), *ratios, *rest)


def buyer_indicators(df: DataFrame, r: Roles = BUYERS) -> DataFrame:
    return actor_indicators(df, r)


def supplier_indicators(df: DataFrame, r: Roles = SUPPLIERS, places: DataFrame | None = None) -> DataFrame:
    """Supplier indicators with active years and, given an activity table, number of places."""
    out = actor_indicators(df, r)
    years = df.select(r.actor, F.year(r.signed).alias("__y")).distinct()
    more = [years.groupBy(r.actor).agg(F.count("*").alias("n_active_years"))]
    if places is not None:
        more.append(n_places(places, r.actor))
    return combine([r.actor], out, *more).filter(F.col("n_counterparts").isNotNull())


# ---------------------------------------------------------------- by period


def concentration(df: DataFrame, r: Roles, keep_counts: bool = False) -> DataFrame:
    """HHI and k-firm ratios of the eligible actors, with their counts if wanted."""
    pairs = pair_totals(df, r.actor, r.counterpart, r.value)
    out = index_from_pairs(
        pairs,
        r.actor,
        r.counterpart,
        r.k,
        F.sum("n").alias("__n"),
        F.count("*").alias("n_counterparts"),
        hhi_of("n").alias("num_hhi"),
        hhi_of("v").alias("val_hhi"),
    )
    out = _enough(out, r)
    return out.withColumnRenamed("__n", "n_contracts") if keep_counts else out.drop("__n", "n_counterparts")


_FLAGS = ("closed", "extended", "added")


def period_table(df: DataFrame, r: Roles, width: int = 2) -> tuple[DataFrame, list[int]]:
    """Profile, winners rate and 0/1 occurrence flags per (actor, period), for all actors.

    The bins come from the years of the eligible actors; the eligibility test runs on the distinct
    (actor, year) pairs, not on the contracts.
    """
    df = df.withColumn("__year", F.year(r.signed))
    years = eligible(df.select(r.actor, "__year").distinct(), r, contracts=df)
    df, periods = period_bins(df, "__year", width, years=years)
    keys = [r.actor, "period"]
    seen = [
        S.in_set(F.col(r.process), r.closed),
        F.coalesce(F.col(r.extension) > 0, F.lit(False)),
        F.coalesce(F.col(r.addition) > 0, F.lit(False)),
    ]
    distincts = {**r.distincts, "n_counterparts": r.counterpart}
    flags = [F.max(c.cast("int")) for c in seen]
    facts = actor_profile(df, keys, r.value, distincts, extra=flags, extra_names=_FLAGS)
    return facts.withColumn("pnum_winners", S.pct(F.col("n_counterparts"), F.col("n_contracts"))), periods


_MEASURES = ("n_contracts", "val_contracts", "val_mean", "val_median", "val_sd")


def indicators_by_period(df: DataFrame, r: Roles, mode: str = "abs", width: int = 2) -> DataFrame:
    """Wide table per actor: ``abs`` holds levels and occurrence, ``rel`` changes and persistence.

    Cells of absent periods are 0; whole-period concentration is attached to both. The ``rel``
    table drops actors without two consecutive periods.
    """
    table, periods = period_table(df, r, width)
    measures = [*_MEASURES, *r.distincts, "n_counterparts"]
    if mode == "abs":
        named = table.withColumnsRenamed({f: f"b_{f}" for f in _FLAGS})
        cols = [*measures, "pnum_winners", *[f"b_{f}" for f in _FLAGS]]
        wide = widen_many(named, [r.actor], "period", cols, periods)
    elif mode == "rel":
        keys = [r.actor]
        joined = period_changes(
            table, keys, "period", [*measures, "pnum_winners"], {f: f"r_{f}" for f in _FLAGS}, exact=("pnum_winners",)
        )
        cols = [*[f"{m}_r" for m in measures], "pnum_winners_r", *[f"r_{f}" for f in _FLAGS]]
        wide = widen_many(joined, keys, "period", cols, periods[1:])
    else:
        raise ValueError("mode is 'abs' or 'rel'")
    filled = S.fill_non_finite(wide, 0, [c for c in wide.columns if c != r.actor])
    parts = [filled.withColumn("__here", F.lit(1)), concentration(df, r)]
    if r.carried:
        parts.append(df.groupBy(r.actor).agg(*[F.min(c).alias(c) for c in r.carried]))
    both = combine([r.actor], *parts)
    # keep actors that are eligible and have a row for this mode
    return both.filter(F.col("num_hhi").isNotNull() & F.col("__here").isNotNull()).drop("__here")


# ---------------------------------------------------------------- composite index


CONCENTRATION = ("num_hhi", "val_hhi", "pnum_ick", "pval_ick")


def composite_index(
    df: DataFrame,
    cols: Sequence[str] = CONCENTRATION,
    cuts: tuple[float, float] = RELATIVE_CUTS,
    relative: bool = True,
    keep: bool = True,
) -> DataFrame:
    """Mean of the concentration indicators (``irc``) and its risk band (``irc_band``).

    Relative cuts are fractions of the largest index; the actor table, one row per actor, is then written once to
    the shared folder, so that the maximum does not compute it a second time.
    """
    out = df.withColumn("irc", S.row_mean([F.col(c) for c in cols]))
    if relative:
        out = cut_lineage(out)
    scale = F.col("irc")
    if relative:
        top = out.agg(F.max("irc").alias("m")).scalar()
        scale = S.r_div(F.col("irc"), top)
    out = out.withColumn("irc_band", S.band(scale, cuts, BANDS))
    return out if keep else out.drop(*cols)


def consolidate_features(
    df: DataFrame, middle: str = "median", merge_closed: bool = True, q: float = 0.9
) -> DataFrame:
    """One addition indicator with its band, and optionally one closed-procurement share.

    The actor table is written once to the shared folder: the cuts read it again.

    ``middle`` is the lower cut: 'median' (used for buyers) or 'mean' (used for suppliers).
    """
    parts = ["pnum_extended", "pval_extended", "pnum_added", "pval_added"]
    out = cut_lineage(df.withColumn("additions", S.row_mean([F.col(c) for c in parts])))
    cut = quantile_struct(out, "additions", {"mid": 0.5, "high": q})
    low = cut["mid"] if middle == "median" else out.agg(F.avg("additions").alias("m")).scalar()
    out = out.withColumn("additions_band", S.band(F.col("additions"), [low, cut["high"]], BANDS, closed="right"))
    drop = list(parts)
    if merge_closed:
        out = out.withColumn("closed", S.row_mean([F.col("pnum_closed"), F.col("pval_closed")]))
        drop += ["pnum_closed", "pval_closed"]
    return out.drop(*drop)


# ---------------------------------------------------------------- participation


def participation_profile(df: DataFrame, actor: str, counterpart: str, value: str) -> DataFrame:
    """Contracts, value (millions) and distinct counterparts per actor."""
    pairs = pair_totals(df, actor, counterpart, value)
    return pairs.groupBy(actor).agg(
        F.sum("n").alias("n"), (F.sum("v") / 1e6).alias("value"), F.count("*").alias("n_counterparts")
    )


def volume_band(n: str) -> Column:
    """Band of an actor's number of contracts."""
    return S.band(F.col(n), [1, 10, 100, 1000], ["once", "2-10", "11-100", "101-1K", ">1K"], closed="right")
