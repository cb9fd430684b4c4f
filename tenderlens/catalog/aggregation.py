"""Grouped aggregates, concentration indicators, profiles and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import concentration as K
from ..operators import stats as St
from ..operators.quantiles import median, quantiles
from ..plans import risk as R
from ..sources.contracts import CLOSED_PROCESS, contracts, table
from ..sources.files import stage
from .base import C, query, rounded


@query("A1_count", C + " SELECT buyer_id, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY buyer_id")
def a1(spark, d):
    return A.count_by(contracts(spark, d, ["buyer_id"]), ["buyer_id"])


@query(
    "A2_moments",
    C
    + " SELECT contract_type, CAST(count(*) AS BIGINT) AS n, round(sum(val), 2) AS total, round(avg(val), 4) AS mean, "
    "round(stddev_samp(val), 4) AS sd, round(stddev_samp(val) / avg(val) * 100, 6) AS cv FROM c GROUP BY contract_type",
)
def a2(spark, d):
    out = A.moments(contracts(spark, d, ["contract_type", "val"]), "val", ["contract_type"])
    return rounded(out, total=2, mean=4, sd=4, cv=6)


@query("A3_median", C + " SELECT supplier_id, round(median(val), 4) AS median FROM c GROUP BY supplier_id")
def a3(spark, d):
    return rounded(median(contracts(spark, d, ["supplier_id", "val"]), ["supplier_id"], "val"), median=4)


@query(
    "A4_quantiles",
    C
    + " SELECT grp, round(quantile_cont(val, 0.1), 4) AS q10, round(quantile_cont(val, 0.25), 4) AS q25, "
    "round(quantile_cont(val, 0.9), 4) AS q90 FROM c GROUP BY grp",
)
def a4(spark, d):
    out = quantiles(contracts(spark, d, ["grp", "val"]), ["grp"], "val", {"q10": 0.1, "q25": 0.25, "q90": 0.9})
    return rounded(out, q10=4, q25=4, q90=4)


@query(
    "A4_quantiles_selection",
    "SELECT l_suppkey, round(median(l_extendedprice), 4) AS q50, round(quantile_cont(l_extendedprice, 0.9), 4) AS q90 "
    "FROM lineitem GROUP BY l_suppkey",
)
def a4b(spark, d):
    df = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice")
    out = quantiles(df, ["l_suppkey"], "l_extendedprice", {"q50": 0.5, "q90": 0.9})
    return rounded(out, q50=4, q90=4)


@query(
    "A5_distinct_with_null",
    "SELECT l_suppkey, CAST(count(DISTINCT k) + max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n FROM "
    "(SELECT l_suppkey, nullif(l_linenumber, 7) AS k FROM lineitem) GROUP BY l_suppkey",
)
def a5(spark, d):
    df = table(spark, d, "lineitem").select("l_suppkey", F.nullif("l_linenumber", F.lit(7)).alias("k"))
    return df.groupBy("l_suppkey").agg(A.n_distinct("k").alias("n"))


@query("A6_distinct", C + " SELECT DISTINCT buyer_name, buyer_id, buyer_place FROM c")
def a6(spark, d):
    return contracts(spark, d, ["buyer_name", "buyer_id", "buyer_place"]).distinct()


@query(
    "A7_share",
    C
    + " SELECT exec_place, round(100.0 * sum(CASE WHEN val > 50000 THEN 1 ELSE 0 END) / count(*), 6) AS p_n, "
    "round(100 * sum(CASE WHEN val > 50000 THEN val ELSE 0 END) / sum(val), 6) AS p_v FROM c GROUP BY exec_place",
)
def a7(spark, d):
    df = contracts(spark, d, ["exec_place", "val"])
    high = F.col("val") > 50000
    out = df.groupBy("exec_place").agg(A.share(high).alias("p_n"), A.share(high, "val").alias("p_v"))
    return rounded(out, p_n=6, p_v=6)


@query(
    "A8_min_participation",
    C
    + " SELECT supplier_id, CAST(count(*) AS BIGINT) AS n_contracts, CAST(count(DISTINCT buyer_id) AS BIGINT) AS n_counterparts "
    "FROM c GROUP BY supplier_id HAVING count(*) >= 40 AND count(DISTINCT buyer_id) >= 30",
)
def a8(spark, d):
    return A.min_participation(contracts(spark, d, ["supplier_id", "buyer_id"]), "supplier_id", "buyer_id", 40, 30)


@query(
    "A9_actor_profile",
    C
    + """ SELECT buyer_id, CAST(count(*) AS BIGINT) AS n_contracts, round(sum(val), 2) AS val_contracts,
round(avg(val), 4) AS val_mean, round(median(val), 4) AS val_median, round(stddev_samp(val), 4) AS val_sd,
CAST(count(DISTINCT family) AS BIGINT) AS n_families, CAST(count(DISTINCT grp) AS BIGINT) AS n_groups,
CAST(count(DISTINCT supplier_id) AS BIGINT) AS n_counterparts FROM c GROUP BY buyer_id""",
)
def a9(spark, d):
    df = stage(contracts(spark, d, ["buyer_id", "supplier_id", "val", "family", "grp"]), "contracts")
    out = A.actor_profile(
        df, ["buyer_id"], "val", {"n_families": "family", "n_groups": "grp", "n_counterparts": "supplier_id"}
    )
    return rounded(out, val_contracts=2, val_mean=4, val_median=4, val_sd=4)


@query("A10_n_places", C + " SELECT buyer_id, CAST(count(DISTINCT exec_place) AS BIGINT) AS n_places FROM c GROUP BY buyer_id")
def a10(spark, d):
    return A.n_places(contracts(spark, d, ["buyer_id", "exec_place"]).distinct(), "buyer_id")


PAIRS = C + ", p AS (SELECT {a} AS a, {b} AS b, count(*) AS n, sum(val) AS v FROM c GROUP BY 1, 2)"
SHARES = PAIRS + """,
s AS (SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS pn, v / sum(v) OVER (PARTITION BY a) AS pv FROM p),
h AS (SELECT a, sum(pow(pn * 100, 2)) / 100 AS num_hhi, sum(pow(pv * 100, 2)) / 100 AS val_hhi FROM s GROUP BY a),
r AS (SELECT a, pn, pv, row_number() OVER (PARTITION BY a ORDER BY pn DESC) AS rn, row_number() OVER (PARTITION BY a ORDER BY pv DESC) AS rv FROM s),
k AS (SELECT a, sum(CASE WHEN rn <= {k} THEN pn END) * 100 AS pnum_ick, sum(CASE WHEN rv <= {k} THEN pv END) * 100 AS pval_ick FROM r GROUP BY a)"""


@query(
    "A11_hhi",
    SHARES.format(a="supplier_id", b="buyer_id", k=1)
    + " SELECT a AS supplier_id, round(num_hhi, 9) AS num_hhi, round(val_hhi, 9) AS val_hhi FROM h",
)
def a11(spark, d):
    out = K.hhi(contracts(spark, d, ["supplier_id", "buyer_id", "val"]), "supplier_id", "buyer_id", "val")
    return rounded(out, num_hhi=9, val_hhi=9)


@query(
    "A12_concentration_ratio",
    SHARES.format(a="buyer_id", b="supplier_id", k=4)
    + " SELECT a AS buyer_id, round(pnum_ick, 9) AS pnum_ick, round(pval_ick, 9) AS pval_ick FROM k",
)
def a12(spark, d):
    df = contracts(spark, d, ["supplier_id", "buyer_id", "val"])
    return rounded(K.concentration_ratio(df, "buyer_id", "supplier_id", "val", 4), pnum_ick=9, pval_ick=9)


@query(
    "A12_concentration_top1",
    SHARES.format(a="supplier_id", b="buyer_id", k=1)
    + " SELECT a AS supplier_id, round(pnum_ick, 9) AS pnum_ick, round(pval_ick, 9) AS pval_ick FROM k",
)
def a12b(spark, d):
    df = contracts(spark, d, ["supplier_id", "buyer_id", "val"])
    return rounded(K.concentration_ratio(df, "supplier_id", "buyer_id", "val", 1), pnum_ick=9, pval_ick=9)


@query(
    "A13_closed_share",
    C
    + f""" SELECT supplier_id, round(100.0 * sum(CASE WHEN process_type = '{CLOSED_PROCESS}' THEN 1 ELSE 0 END) / count(*), 6) AS pnum_closed,
round(100 * sum(CASE WHEN process_type = '{CLOSED_PROCESS}' THEN val ELSE 0 END) / sum(val), 6) AS pval_closed
FROM c GROUP BY supplier_id""",
)
def a13(spark, d):
    df = contracts(spark, d, ["supplier_id", "process_type", "val"])
    out = K.closed_share(df, ["supplier_id"], "process_type", [CLOSED_PROCESS], "val")
    return rounded(out, pnum_closed=6, pval_closed=6)


@query(
    "A14_winners_rate",
    C
    + " SELECT buyer_id, round(100.0 * count(DISTINCT supplier_id) / count(*), 6) AS pnum_winners FROM c GROUP BY buyer_id",
)
def a14(spark, d):
    out = K.winners_rate(contracts(spark, d, ["buyer_id", "supplier_id"]), ["buyer_id"], "supplier_id")
    return rounded(out, pnum_winners=6)


@query(
    "A15_extension_share",
    C
    + """ SELECT supplier_id, round(100.0 * sum(CASE WHEN ext_days > 0 THEN 1 ELSE 0 END) / count(*), 6) AS pnum_extended,
round(100.0 * sum(ext_days) / sum(ext_days + term), 6) AS pval_extended FROM c GROUP BY supplier_id""",
)
def a15(spark, d):
    df = contracts(spark, d, ["supplier_id", "ext_days", "term"])
    return rounded(K.extension_share(df, ["supplier_id"], "ext_days", "term"), pnum_extended=6, pval_extended=6)


@query(
    "A16_addition_share",
    C
    + """ SELECT buyer_id, round(100.0 * sum(CASE WHEN addition > 0 THEN 1 ELSE 0 END) / count(*), 6) AS pnum_added,
round(100 * sum(addition) / sum(val), 6) AS pval_added FROM c GROUP BY buyer_id""",
)
def a16(spark, d):
    df = contracts(spark, d, ["buyer_id", "addition", "val"])
    return rounded(K.addition_share(df, ["buyer_id"], "addition", "val"), pnum_added=6, pval_added=6)


_A17 = C + """, t AS (SELECT supplier_id, count(*) AS n, sum(val) / 1e6 AS value, count(DISTINCT buyer_id) AS k FROM c GROUP BY 1)"""


@query(
    "A17_participation_table",
    _A17
    + """ SELECT CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS n_counterparts, round(100.0 * count(*) / (SELECT count(*) FROM t), 6) AS pct_actors,
round(100 * sum(value) / (SELECT sum(value) FROM t), 6) AS pct_value FROM t WHERE n <= 40 OR k <= 30 GROUP BY 1, 2""",
)
def a17(spark, d):
    df = R.participation_profile(
        contracts(spark, d, ["supplier_id", "buyer_id", "val"]), "supplier_id", "buyer_id", "val"
    )
    out = A.participation_table(df, ["n", "n_counterparts"], (F.col("n") <= 40) | (F.col("n_counterparts") <= 30))
    return rounded(out, pct_actors=6, pct_value=6)


@query(
    "A18_mean_of_means",
    C
    + """ SELECT buyer_place, round(avg(m), 4) AS mean FROM (SELECT buyer_place, contract_type, year, avg(val) AS m FROM c
GROUP BY 1, 2, 3) GROUP BY buyer_place""",
)
def a18(spark, d):
    df = contracts(spark, d, ["buyer_place", "contract_type", "year", "val"])
    out = A.mean_of_means(df, ["buyer_place", "contract_type", "year"], ["buyer_place"], "val")
    return rounded(out, mean=4)


@query(
    "A19_panel_mean",
    "SELECT l_suppkey, round(avg(nullif(l_quantity, 10)), 9) AS l_quantity_m, round(avg(l_tax), 9) AS l_tax_m, "
    "round(avg(l_discount), 9) AS l_discount_m FROM lineitem GROUP BY l_suppkey",
)
def a19(spark, d):
    df = table(spark, d, "lineitem").select(
        "l_suppkey", F.nullif("l_quantity", F.lit(10.0)).alias("l_quantity"), "l_tax", "l_discount"
    )
    out = A.panel_mean(df, ["l_suppkey"], ["l_quantity", "l_tax", "l_discount"], "_m")
    return rounded(out, l_quantity_m=9, l_tax_m=9, l_discount_m=9)


@query(
    "A20_yearly_totals",
    C
    + " SELECT year, contract_type, round(sum(val), 2) AS total FROM c WHERE contract_type IN ('PROMO', 'SMALL', 'LARGE') GROUP BY 1, 2",
)
def a20(spark, d):
    df = contracts(spark, d, ["year", "contract_type", "val"])
    return rounded(A.yearly_totals(df, "year", "contract_type", "val", ["PROMO", "SMALL", "LARGE"]), total=2)


@query(
    "A21_place_summary",
    C
    + """, g AS (SELECT buyer_place, year, month, avg(CASE WHEN contract_type = 'PROMO' THEN val END) / 1e3 AS income,
avg(CASE WHEN contract_type = 'SMALL' THEN val END) / 1e3 AS spending FROM c WHERE contract_type IN ('PROMO', 'SMALL') GROUP BY 1, 2, 3)
SELECT buyer_place, round(avg(income), 6) AS income_mean, round(stddev_samp(income), 6) AS income_sd,
round(avg(spending), 6) AS spending_mean, round(stddev_samp(spending), 6) AS spending_sd FROM g GROUP BY buyer_place""",
)
def a21(spark, d):
    df = contracts(spark, d, ["buyer_place", "year", "month", "contract_type", "val"])
    panel = df.groupBy("buyer_place", "year", "month", "contract_type").agg((F.avg("val") / 1e3).alias("valor"))
    out = A.place_summary(
        panel, ["buyer_place"], ["year", "month"], "contract_type", "valor", {"PROMO": "income", "SMALL": "spending"}
    )
    out = rounded(out, income_mean=6, income_sd=6, spending_mean=6, spending_sd=6)
    return out.orderBy(F.desc("income_mean"))


@query(
    "A22_weighted_exposure",
    C
    + """, t AS (SELECT supplier_id, buyer_place AS place, sum(val) AS v FROM c GROUP BY 1, 2),
act AS (SELECT supplier_id, place, v / sum(v) OVER (PARTITION BY supplier_id) AS p FROM t),
pan AS (SELECT s_nationkey AS place, avg(s_acctbal) AS balance FROM supplier WHERE s_acctbal > 0 GROUP BY 1)
SELECT supplier_id, round(coalesce(sum(balance * p), 0), 4) AS balance FROM act LEFT JOIN pan USING (place) GROUP BY supplier_id""",
)
def a22(spark, d):
    from ..plans.places import activity_shares

    df = contracts(spark, d, ["supplier_id", "buyer_place", "val"])
    act = activity_shares(df, "supplier_id", "buyer_place", "val").withColumnRenamed("buyer_place", "place")
    panel = table(spark, d, "supplier").filter("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("place")).agg(
        F.avg("s_acctbal").alias("balance")
    )
    return rounded(A.weighted_exposure(act, panel, "supplier_id", "place", "p", ["balance"]), balance=4)


def _profile_sql(col: str, expr: str) -> str:
    return f"""SELECT '{col}' AS column, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count(x) AS BIGINT) AS n_missing,
round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd, round(count(x) / count(*), 9) AS complete_rate, round(min(x), 4) AS p0,
round(quantile_cont(x, 0.25), 4) AS p25, round(median(x), 4) AS p50, round(quantile_cont(x, 0.75), 4) AS p75, round(max(x), 4) AS p100,
(SELECT string_agg(substr('▁▂▃▅▇', CAST(round(n / m * 4) AS INTEGER) + 1, 1), '' ORDER BY s) FROM (
  SELECT s, n, max(n) OVER () AS m FROM (SELECT g.s, count(h.s) AS n FROM range(5) g(s) LEFT JOIN (
    SELECT least(floor((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) * 5), 4) AS s
    FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM lineitem) WHERE x IS NOT NULL) h ON g.s = h.s GROUP BY g.s))) AS hist
FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM lineitem)"""


@query(
    "A23_profile",
    " UNION ALL ".join(
        _profile_sql(c, e)
        for c, e in (
            ("l_quantity", "nullif(l_quantity, 10)"),
            ("l_extendedprice", "l_extendedprice"),
            ("l_discount", "l_discount"),
        )
    ),
)
def a23(spark, d):
    df = table(spark, d, "lineitem").select(
        F.nullif("l_quantity", F.lit(10.0)).alias("l_quantity"), "l_extendedprice", "l_discount"
    )
    out = St.profile(df, ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(out, mean=4, sd=4, complete_rate=9, p0=4, p25=4, p50=4, p75=4, p100=4)


@query(
    "A23_profile_text",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
        f"CAST(count(CASE WHEN {c} = '' THEN 1 END) AS BIGINT) AS n_empty, CAST(min(length({c})) AS INTEGER) AS min_length, "
        f"CAST(max(length({c})) AS INTEGER) AS max_length, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique FROM documents"
        for c in ("text", "lang", "source")
    ),
)
def a23b(spark, d):
    return St.profile_text(table(spark, d, "documents"), ["text", "lang", "source"])


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "A24_correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, round_even(corr({a}, {b}), 2) AS value FROM lineitem WHERE l_tax > 0"
        for a in _CORR
        for b in _CORR
    ),
)
def a24(spark, d):
    df = table(spark, d, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return St.correlation_long(df, _CORR)


_HIST = """WITH x AS (SELECT {f} AS f, {v} AS v FROM {t}), r AS (SELECT min(v) AS lo, max(v) AS hi FROM x)
SELECT f AS {f}, CAST(least(floor((v - lo) / ((hi - lo) / {b})), {b} - 1) AS INTEGER) AS bin,
round(lo + least(floor((v - lo) / ((hi - lo) / {b})), {b} - 1) * ((hi - lo) / {b}), 6) AS bin_start, CAST(count(*) AS BIGINT) AS n
FROM x, r WHERE v IS NOT NULL GROUP BY 1, 2, 3"""


@query(
    "A25_histogram",
    _HIST.format(f="o_orderpriority", v="CASE WHEN o_totalprice > 0 THEN log10(o_totalprice) END", t="orders", b=30),
)
def a25(spark, d):
    out = St.histogram(table(spark, d, "orders"), "o_totalprice", ["o_orderpriority"], 30, log10=True)
    return rounded(out, bin_start=6)


_DENSITY = """WITH x AS (SELECT o_orderpriority, log10(o_totalprice) AS v FROM orders WHERE o_totalprice > 0),
r AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 63 AS step FROM x),
b AS (SELECT o_orderpriority, count(*) AS n, 0.9 * least(stddev_samp(v), (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34)
      * pow(count(*), -0.2) AS bw FROM x GROUP BY 1),
p AS (SELECT o_orderpriority, (v - lo) / step AS pos FROM x, r),
q AS (SELECT o_orderpriority, pos, least(floor(pos), 62) AS i FROM p),
m AS (SELECT o_orderpriority, g, sum(w) AS m FROM (SELECT o_orderpriority, i AS g, 1 - (pos - i) AS w FROM q UNION ALL
      SELECT o_orderpriority, i + 1, pos - i FROM q) GROUP BY 1, 2)
SELECT o_orderpriority, CAST(grid AS INTEGER) AS grid, round(lo + grid * step, 6) AS x,
round(sum(m * exp(-0.5 * pow((grid - g) * step / bw, 2)) * 0.3989422804014327 / bw / n), 6) AS density
FROM m JOIN b USING (o_orderpriority), r, (SELECT unnest(range(0, 64)) AS grid) GROUP BY o_orderpriority, grid, lo, step"""


@query("A26_density", _DENSITY)
def a26(spark, d):
    out = St.density(table(spark, d, "orders"), "o_totalprice", ["o_orderpriority"], points=64, log10=True)
    return rounded(out, x=6, density=6)


@query(
    "A27_box_stats",
    """WITH q AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.25) AS q1, median(l_extendedprice) AS med,
quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
x AS (SELECT l.l_suppkey, q1, med, q3, l_extendedprice AS v, l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
FROM lineitem l JOIN q USING (l_suppkey))
SELECT l_suppkey, round(q1, 4) AS q1, round(med, 4) AS med, round(q3, 4) AS q3, min(CASE WHEN inside THEN v END) AS low_whisker,
max(CASE WHEN inside THEN v END) AS high_whisker, CAST(count(*) - count(CASE WHEN inside THEN 1 END) AS BIGINT) AS n_outliers
FROM x GROUP BY l_suppkey, q1, med, q3""",
)
def a27(spark, d):
    out = St.box_stats(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice")
    return rounded(out, q1=4, med=4, q3=4)
