"""Reshaping, period binning and period indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reshape as Rs
from ..plans import risk as R
from ..plans.quality import DECILE_LABELS, DECILES
from ..sources.contracts import contracts, table
from ..sources.files import stage
from .base import C, query, rounded

_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "R1_widen",
    C
    + " SELECT buyer_place, "
    + ", ".join(f"round(sum(CASE WHEN contract_type = '{t}' THEN val END), 2) AS \"{t}\"" for t in _TYPES)
    + " FROM c GROUP BY buyer_place",
)
def r1(spark, d):
    df = contracts(spark, d, ["buyer_place", "contract_type", "val"])
    long = df.groupBy("buyer_place", "contract_type").agg(F.round(F.sum("val"), 2).alias("v"))
    return Rs.widen(long, ["buyer_place"], "contract_type", "v", _TYPES)


_YEARS = tuple(range(1995, 2002))
_BY_YEAR = C + ", y AS (SELECT supplier_id, year, count(*) AS n, sum(val) AS v FROM c GROUP BY 1, 2)"


@query(
    "R2_widen_many",
    _BY_YEAR
    + " SELECT supplier_id, "
    + ", ".join(
        f"CAST(coalesce(max(CASE WHEN year = {y} THEN n END), 0) AS BIGINT) AS n_{y}, "
        f"round(coalesce(max(CASE WHEN year = {y} THEN v END), 0), 2) AS v_{y}"
        for y in _YEARS
    )
    + " FROM y GROUP BY supplier_id",
)
def r2(spark, d):
    df = contracts(spark, d, ["supplier_id", "year", "val"])
    long = df.groupBy("supplier_id", "year").agg(F.count("*").alias("n"), F.round(F.sum("val"), 2).alias("v"))
    return Rs.widen_many(long, ["supplier_id"], "year", ["n", "v"], _YEARS)


@query(
    "R3_widen_prefixed",
    _BY_YEAR
    + " SELECT supplier_id, "
    + ", ".join(f"CAST(coalesce(max(CASE WHEN year = {y} THEN 1 END), 0) AS INTEGER) AS b_{y}" for y in _YEARS)
    + " FROM y GROUP BY supplier_id",
)
def r3(spark, d):
    df = contracts(spark, d, ["supplier_id", "year"])
    long = df.distinct().withColumn("b", F.lit(1))
    return Rs.widen(long, ["supplier_id"], "year", "b", _YEARS, prefix="b_", fill=0)


@query(
    "R4_lengthen",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, '{c}' AS name, {c} AS value FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def r4(spark, d):
    df = table(spark, d, "lineitem")
    return Rs.lengthen(df, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount", "l_tax"])


# right-closed equal-width bins: k = distinct years / 2, rounded down
_BINNED = """, r AS (SELECT min(year) AS lo, max(year) AS hi, CAST(floor(count(DISTINCT year) / 2) AS INTEGER) AS k FROM {src}),
b AS (SELECT {src}.*, CAST(greatest(1, ceil((year - lo) * k / (hi - lo))) AS INTEGER) AS period FROM {src}, r)"""


@query(
    "R5_period_bins",
    C + _BINNED.format(src="c") + " SELECT period, year, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 1, 2",
)
def r5(spark, d):
    df, _ = Rs.period_bins(contracts(spark, d, ["year"]), "year")
    return df.groupBy("period", "year").agg(F.count("*").alias("n"))


@query(
    "R6_quantile_bucket",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE "
    + " ".join(
        f"WHEN l_extendedprice <= (SELECT quantile_cont(l_extendedprice, {i / 10}) FROM lineitem) THEN '{x}'"
        for i, x in enumerate("abcdefghij", 1)
    )
    + " END AS bucket FROM lineitem",
)
def r6(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return Rs.quantile_bucket(df, "l_extendedprice", DECILES, DECILE_LABELS).drop("l_extendedprice")


@query(
    "R7_select_indicators",
    C
    + " SELECT buyer_place, CASE contract_type WHEN 'PROMO' THEN 'ine_promo' ELSE 'ine_small' END AS contract_type, year, "
    "CAST(count(*) AS BIGINT) AS n FROM c WHERE contract_type IN ('PROMO', 'SMALL') AND year BETWEEN 1996 AND 1999 GROUP BY 1, 2, 3",
)
def r7(spark, d):
    df = contracts(spark, d, ["buyer_place", "contract_type", "year"])
    kept = Rs.select_indicators(df, "contract_type", {"PROMO": "ine_promo", "SMALL": "ine_small"}, "year", (1996, 1999))
    return kept.groupBy("buyer_place", "contract_type", "year").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- indicators by period

_M = ("n_contracts", "val_contracts", "val_mean", "val_median", "val_sd", "n_families", "n_groups", "n_counterparts")


def _period_sql(actor: str, other: str, n: int, m: int, k: int) -> str:
    return (
        C
        + f""", el AS (SELECT {actor} FROM c GROUP BY 1 HAVING count(*) >= {n} AND count(DISTINCT {other}) >= {m}),
e AS (SELECT {actor} AS a, {other} AS o, c.* FROM c WHERE {actor} IN (SELECT * FROM el))"""
        + _BINNED.format(src="e")
        + f""", t AS (SELECT a, period, count(*) AS n_contracts, sum(val) AS val_contracts, avg(val) AS val_mean, median(val) AS val_median,
stddev_samp(val) AS val_sd, count(DISTINCT family) AS n_families, count(DISTINCT grp) AS n_groups, count(DISTINCT o) AS n_counterparts,
100.0 * count(DISTINCT o) / count(*) AS pnum_winners, max(CASE WHEN process_type = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) AS closed,
max(CASE WHEN ext_days > 0 THEN 1 ELSE 0 END) AS extended, max(CASE WHEN addition > 0 THEN 1 ELSE 0 END) AS added FROM b GROUP BY 1, 2),
p AS (SELECT a, o, count(*) AS n, sum(val) AS v FROM e GROUP BY 1, 2),
s AS (SELECT a, n / sum(n) OVER (PARTITION BY a) AS pn, v / sum(v) OVER (PARTITION BY a) AS pv FROM p),
rk AS (SELECT a, pn, pv, row_number() OVER (PARTITION BY a ORDER BY pn DESC) AS rn, row_number() OVER (PARTITION BY a ORDER BY pv DESC) AS rv FROM s),
con AS (SELECT a, sum(pow(pn * 100, 2)) / 100 AS num_hhi, sum(pow(pv * 100, 2)) / 100 AS val_hhi,
sum(CASE WHEN rn <= {k} THEN pn END) * 100 AS pnum_ick, sum(CASE WHEN rv <= {k} THEN pv END) * 100 AS pval_ick FROM rk GROUP BY a)"""
    )


_CON = ", ".join(f"round(any_value({c}), 9) AS {c}" for c in R.CONCENTRATION)
_COUNTS = {"n_contracts", "n_families", "n_groups", "n_counterparts"}


def _abs_sql(actor, other, n, m, k):
    cells = []
    for c in (*_M, "pnum_winners"):
        for p in (1, 2, 3):
            cell = f"coalesce(max(CASE WHEN period = {p} THEN {c} END), 0)"
            digits = {"val_contracts": 2, "val_mean": 7}.get(c, 4)
            cells.append(f"CAST({cell} AS BIGINT) AS {c}_{p}" if c in _COUNTS else f"round({cell}, {digits}) AS {c}_{p}")
    for f in ("closed", "extended", "added"):
        cells += [f"CAST(coalesce(max(CASE WHEN period = {p} THEN {f} END), 0) AS INTEGER) AS b_{f}_{p}" for p in (1, 2, 3)]
    return _period_sql(actor, other, n, m, k) + f" SELECT a AS {actor}, {', '.join(cells)}, {_CON} FROM t JOIN con USING (a) GROUP BY a"


def _rate(c: str) -> str:
    r = f"(t.{c} / q.{c} - 1)"
    return f"CASE WHEN q.{c} = 0 OR q.{c} IS NULL OR t.{c} IS NULL THEN 0 ELSE {r} END"


def _rel_sql(actor, other, n, m, k):
    rates = ", ".join(f"round_even({_rate(c)}, 4) * 100 AS {c}_r" for c in _M)
    rates += f", {_rate('pnum_winners')} * 100 AS pnum_winners_r"
    rates += ", " + ", ".join(
        f"CASE WHEN t.{f} = 1 AND q.{f} = 1 THEN 1 ELSE 0 END AS r_{f}" for f in ("closed", "extended", "added")
    )
    cells = []
    for c in (*_M, "pnum_winners"):
        cells += [f"round(coalesce(max(CASE WHEN period = {p} THEN {c}_r END), 0), 6) AS {c}_r_{p}" for p in (2, 3)]
    for f in ("closed", "extended", "added"):
        cells += [f"CAST(coalesce(max(CASE WHEN period = {p} THEN r_{f} END), 0) AS INTEGER) AS r_{f}_{p}" for p in (2, 3)]
    return (
        _period_sql(actor, other, n, m, k)
        + f", j AS (SELECT t.a, t.period, {rates} FROM t JOIN t q ON t.a = q.a AND t.period = q.period + 1)"
        + f" SELECT a AS {actor}, {', '.join(cells)}, {_CON} FROM j JOIN con USING (a) GROUP BY a"
    )


_NEED = [
    "buyer_id", "supplier_id", "val", "addition", "ext_days", "term", "process_type", "signed", "family", "grp",
]


def _rounded_wide(df, keys):
    digits = {}
    for name, kind in df.dtypes:
        if kind == "double" and name not in keys:
            if name.startswith("val_mean_") and "_r_" not in name:
                digits[name] = 7  # means of whole cents are never half-way between two such values
            elif "_r_" in name:
                digits[name] = 6
            else:
                digits[name] = 2 if name.startswith("val_contracts_") else 4
    digits.update({c: 9 for c in R.CONCENTRATION})
    return rounded(df, **digits)


def _register(kind: str, roles: R.Roles, args: tuple):
    @query(f"D15_{kind}_periods_absolute", _abs_sql(*args))
    def absolute(spark, d):
        out = R.indicators_by_period(stage(contracts(spark, d, _NEED), "contracts"), roles, "abs")
        return _rounded_wide(out, [roles.actor])

    @query(f"D16_{kind}_periods_relative", _rel_sql(*args))
    def relative(spark, d):
        out = R.indicators_by_period(stage(contracts(spark, d, _NEED), "contracts"), roles, "rel")
        return _rounded_wide(out, [roles.actor])


_register("buyer", R.BUYERS, ("buyer_id", "supplier_id", 6, 5, 4))
_register("supplier", R.SUPPLIERS, ("supplier_id", "buyer_id", 3, 2, 1))
