"""Whole-period indicators, composite index and participation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import participation_table
from ..plans import risk as R
from ..sources.contracts import contracts
from ..sources.files import stage
from .aggregation import SHARES
from .base import C, query, rounded

_NEED = [
    "buyer_id", "supplier_id", "val", "addition", "ext_days", "term", "process_type", "signed", "family", "grp",
]


def _full_sql(actor: str, other: str, n: int, m: int, k: int, extra: str = "") -> str:
    return (
        SHARES.format(a=actor, b=other, k=k)
        + f""", f AS (SELECT {actor} AS a, count(*) AS n_contracts, sum(val) AS val_contracts, avg(val) AS val_mean, median(val) AS val_median,
stddev_samp(val) AS val_sd, count(DISTINCT family) AS n_families, count(DISTINCT grp) AS n_groups, count(DISTINCT {other}) AS n_counterparts,
100.0 * sum(CASE WHEN process_type = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) / count(*) AS pnum_closed,
100 * sum(CASE WHEN process_type = '4-NOT SPECIFIED' THEN val ELSE 0 END) / sum(val) AS pval_closed,
100.0 * count(DISTINCT {other}) / count(*) AS pnum_winners,
100.0 * sum(CASE WHEN ext_days > 0 THEN 1 ELSE 0 END) / count(*) AS pnum_extended, 100.0 * sum(ext_days) / sum(ext_days + term) AS pval_extended,
100.0 * sum(CASE WHEN addition > 0 THEN 1 ELSE 0 END) / count(*) AS pnum_added, 100 * sum(addition) / sum(val) AS pval_added{extra}
FROM c GROUP BY 1 HAVING count(*) >= {n} AND count(DISTINCT {other}) >= {m}),
ind AS (SELECT * FROM f JOIN h USING (a) JOIN k USING (a)),
idx AS (SELECT *, (num_hhi + val_hhi + pnum_ick + pval_ick) / 4 AS irc, (pnum_extended + pval_extended + pnum_added + pval_added) / 4 AS additions,
        (pnum_closed + pval_closed) / 2 AS closed FROM ind)"""
    )


_BUYER_SQL = _full_sql("buyer_id", "supplier_id", 6, 5, 4)
SUPPLIER_SQL = _full_sql(
    "supplier_id", "buyer_id", 3, 2, 1,
    ", count(DISTINCT year) AS n_active_years, count(DISTINCT buyer_place) AS n_places",
)
_INT = ("n_contracts", "n_families", "n_groups", "n_counterparts")
_PCT = (
    "pnum_closed", "pval_closed", "pnum_winners", "pnum_extended", "pval_extended", "pnum_added", "pval_added",
    "num_hhi", "val_hhi", "pnum_ick", "pval_ick",
)
_MONEY = {"val_contracts": 2, "val_mean": 4, "val_median": 4, "val_sd": 4}


def _select(actor: str, ints=_INT) -> str:
    return (
        f"SELECT a AS {actor}, "
        + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ints)
        + ", "
        + ", ".join(f"round({c}, {n}) AS {c}" for c, n in _MONEY.items())
        + ", "
        + ", ".join(f"round({c}, 6) AS {c}" for c in _PCT)
    )


def _digits():
    return {**_MONEY, **{c: 6 for c in _PCT}}


@query("D13_buyer_indicators", f"{_BUYER_SQL} {_select('buyer_id')} FROM ind")
def d13(spark, d):
    return rounded(R.buyer_indicators(stage(contracts(spark, d, _NEED), "contracts")), **_digits())


@query(
    "D14_supplier_indicators",
    f"{SUPPLIER_SQL} {_select('supplier_id', (*_INT, 'n_active_years', 'n_places'))} FROM ind",
)
def d14(spark, d):
    df = stage(contracts(spark, d, [*_NEED, "buyer_place"]), "contracts")
    places = df.select("supplier_id", "buyer_place").distinct()
    return rounded(R.supplier_indicators(df, places=places), **_digits())


def flagship(spark, d):
    """Composite concentration index per eligible supplier, relative bands."""
    df = contracts(spark, d, ["supplier_id", "buyer_id", "val"])
    return R.composite_index(R.concentration(df, R.SUPPLIERS, keep_counts=True))


@query(
    "D17_composite_index",
    SUPPLIER_SQL
    + """ SELECT a AS supplier_id, CAST(n_contracts AS BIGINT) AS n_contracts, CAST(n_counterparts AS BIGINT) AS n_counterparts,
round(num_hhi, 6) AS num_hhi, round(val_hhi, 6) AS val_hhi, round(pnum_ick, 6) AS pnum_ick, round(pval_ick, 6) AS pval_ick, round(irc, 6) AS irc,
CASE WHEN irc / (SELECT max(irc) FROM idx) < 0.444 THEN 'Bajo' WHEN irc / (SELECT max(irc) FROM idx) < 0.744 THEN 'Medio' ELSE 'Alto' END AS irc_band
FROM idx""",
)
def d17(spark, d):
    return rounded(flagship(spark, d), num_hhi=6, val_hhi=6, pnum_ick=6, pval_ick=6, irc=6)


@query(
    "D17_composite_index_absolute",
    _BUYER_SQL
    + """ SELECT a AS buyer_id, round(irc, 6) AS irc, CASE WHEN irc < 1.4 THEN 'Bajo' WHEN irc < 1.6 THEN 'Medio' ELSE 'Alto' END AS irc_band FROM idx""",
)
def d17b(spark, d):
    df = contracts(spark, d, ["supplier_id", "buyer_id", "val"])
    r = R.BUYERS
    index = R.concentration(df, r)
    out = R.composite_index(index, cuts=(1.4, 1.6), relative=False, keep=False)
    return rounded(out, irc=6)


@query(
    "D18_consolidate_features",
    SUPPLIER_SQL
    + """ SELECT a AS supplier_id, round(additions, 6) AS additions, round(closed, 6) AS closed,
CASE WHEN additions <= (SELECT avg(additions) FROM idx) THEN 'Bajo' WHEN additions <= (SELECT quantile_cont(additions, 0.9) FROM idx) THEN 'Medio'
ELSE 'Alto' END AS additions_band FROM idx""",
)
def d18(spark, d):
    out = R.consolidate_features(_red_flags(spark, d), middle="mean")
    return rounded(out, additions=6, closed=6)


def _red_flags(spark, d):
    """Red-flag shares of the eligible suppliers."""
    df = contracts(spark, d, ["supplier_id", "buyer_id", "val", "addition", "ext_days", "term", "process_type"])
    cols = ["supplier_id", "pnum_closed", "pval_closed", "pnum_extended", "pval_extended", "pnum_added", "pval_added"]
    return R.red_flags(df, R.SUPPLIERS).select(*cols)


@query(
    "D19_participation_exclusion",
    C
    + """, t AS (SELECT supplier_id, count(*) AS n, sum(val) / 1e6 AS value, count(DISTINCT buyer_id) AS k FROM c GROUP BY 1),
x AS (SELECT *, CASE WHEN n <= 1 THEN 'once' WHEN n <= 10 THEN '2-10' WHEN n <= 100 THEN '11-100' WHEN n <= 1000 THEN '101-1K' ELSE '>1K' END AS volume FROM t)
SELECT volume, round(100.0 * count(*) / (SELECT count(*) FROM t), 6) AS pct_actors, round(100 * sum(value) / (SELECT sum(value) FROM t), 6) AS pct_value
FROM x WHERE n <= 20 OR k <= 30 GROUP BY volume""",
)
def d19(spark, d):
    df = contracts(spark, d, ["supplier_id", "buyer_id", "val"])
    actors = R.participation_profile(df, "supplier_id", "buyer_id", "val").withColumn("volume", R.volume_band("n"))
    keep = (F.col("n") <= 20) | (F.col("n_counterparts") <= 30)
    out = rounded(participation_table(actors, ["volume"], keep), pct_actors=6, pct_value=6)
    return out.orderBy(F.desc("pct_actors"))
