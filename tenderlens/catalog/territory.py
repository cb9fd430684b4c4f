"""Territorial panels, enrichment and hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import panel as Pn
from ..plans.places import activity_shares
from ..sources.contracts import contracts, table
from ..sources.panel_view import PANEL_SQL, panel
from .base import C, query, rounded

_PANEL = C + f", pan AS ({PANEL_SQL})"
_CLEAN = (
    _PANEL
    + """, cl AS (SELECT codigo_departamento, departamento, codigo_entidad, entidad, subcategoria,
CASE WHEN subcategoria LIKE 'SGP - Distribución asig%' THEN 'abs - ' || indicador WHEN subcategoria LIKE 'SGP - Porcentaje%' THEN 'ppe - ' || indicador
ELSE indicador END AS indicador, CASE WHEN und_medida = 'Millones de pesos corrientes' THEN cents * 1e6 WHEN und_medida IS NOT NULL THEN cents END AS valor,
anno, mes, fuente, und_medida FROM pan WHERE anno BETWEEN 1996 AND 2000)"""
)


def _clean(spark, d):
    return Pn.clean_panel(panel(spark, d), (1996, 2000))


@query(
    "D20_clean_panel",
    _CLEAN + " SELECT codigo_departamento, codigo_entidad, entidad, indicador, valor, anno, mes, und_medida FROM cl",
)
def d20(spark, d):
    cols = ["codigo_departamento", "codigo_entidad", "entidad", "indicador", "valor", "anno", "mes", "und_medida"]
    return _clean(spark, d).select(*cols)


@query(
    "D20_panel_levels",
    _CLEAN
    + """ SELECT level, indicador, CAST(count(*) AS BIGINT) AS n, round(avg(valor), 4) AS mean FROM (
SELECT 'country' AS level, * FROM cl WHERE departamento = 'ASIA'
UNION ALL SELECT 'department', * FROM cl WHERE departamento = entidad AND departamento <> 'ASIA'
UNION ALL SELECT 'municipality', * FROM cl WHERE departamento <> entidad OR departamento = 'EUROPE') GROUP BY 1, 2""",
)
def d20b(spark, d):
    levels = Pn.split_levels(_clean(spark, d), "departamento", "entidad", "ASIA", ["EUROPE"])
    tagged = [df.withColumn("level", F.lit(name)) for name, df in levels.items()]
    rows = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return rounded(rows.groupBy("level", "indicador").agg(F.count("*").alias("n"), F.avg("valor").alias("mean")), mean=4)


@query(
    "D21_enrich_buyers",
    C
    + """, a AS (SELECT s_nationkey AS place, avg(s_acctbal) AS balance FROM supplier GROUP BY 1),
b AS (SELECT c_nationkey AS place, CAST(count(*) AS BIGINT) AS customers FROM customer GROUP BY 1)
SELECT DISTINCT buyer_id, buyer_name, buyer_place AS place, round(balance, 4) AS balance, customers FROM c
LEFT JOIN a ON buyer_place = a.place LEFT JOIN b ON buyer_place = b.place""",
)
def d21(spark, d):
    buyers = contracts(spark, d, ["buyer_id", "buyer_name", "buyer_place"]).distinct()
    buyers = buyers.withColumnRenamed("buyer_place", "place")
    a = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("place")).agg(F.avg("s_acctbal").alias("balance"))
    b = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("place")).agg(F.count("*").alias("customers"))
    return rounded(Pn.enrich_buyers(buyers, "place", {"balance": a, "customers": b}), balance=4)


@query(
    "D21_enrich_suppliers",
    _PANEL
    + """, t AS (SELECT supplier_id, exec_place AS place, sum(val) AS v FROM c GROUP BY 1, 2),
act AS (SELECT supplier_id, place, v / sum(v) OVER (PARTITION BY supplier_id) AS p FROM t),
ok AS (SELECT supplier_id FROM c GROUP BY 1 HAVING count(*) >= 40),
f AS (SELECT codigo_entidad AS place, avg(CASE WHEN indicador = 'PROMO' THEN m END) AS promo, avg(CASE WHEN indicador = 'SMALL' THEN m END) AS small
FROM (SELECT codigo_entidad, indicador, anno, avg(cents) AS m FROM pan WHERE indicador IN ('PROMO', 'SMALL') GROUP BY 1, 2, 3) GROUP BY 1)
SELECT supplier_id, round(coalesce(sum(promo * p), 0), 4) AS promo, round(coalesce(sum(small * p), 0), 4) AS small
FROM act LEFT JOIN f USING (place) WHERE supplier_id IN (SELECT * FROM ok) GROUP BY supplier_id""",
)
def d21b(spark, d):
    df = contracts(spark, d, ["supplier_id", "exec_place", "val"])
    act = activity_shares(df.withColumnRenamed("exec_place", "place"), "supplier_id", "place", "val")
    actors = df.groupBy("supplier_id").agg(F.count("*").alias("n")).filter("n >= 40")
    feats = Pn.panel_features(
        _numeric(spark, d), "codigo_entidad", "indicador", "valor", "anno", {"PROMO": "promo", "SMALL": "small"}
    ).withColumnRenamed("codigo_entidad", "place")
    out = Pn.enrich_suppliers(act, actors, feats, "supplier_id", "place", "p", ["promo", "small"])
    return rounded(out, promo=4, small=4)


_IND = {"PROMO": "inf_promo", "SMALL": "inf_small", "LARGE": "inf_large"}


def _numeric(spark, d):
    from ..functions.scalar import parse_locale_number

    return panel(spark, d).withColumn("valor", parse_locale_number(F.col("valor")))


@query(
    "D22_panel_features_mean",
    _PANEL
    + ", y AS (SELECT codigo_entidad, indicador, anno, avg(cents) AS m FROM pan GROUP BY 1, 2, 3) SELECT codigo_entidad, "
    + ", ".join(f"round(avg(CASE WHEN indicador = '{n}' THEN m END), 6) AS {a}" for n, a in _IND.items())
    + " FROM y GROUP BY codigo_entidad",
)
def d22(spark, d):
    out = Pn.panel_features(_numeric(spark, d), "codigo_entidad", "indicador", "valor", "anno", _IND)
    return rounded(out, **{a: 6 for a in _IND.values()})


_PERIODS = (
    _PANEL
    + """, k AS (SELECT * FROM pan WHERE indicador IN ('PROMO', 'SMALL', 'LARGE')),
r AS (SELECT min(anno) AS lo, max(anno) AS hi, floor(count(DISTINCT anno) / 2) AS k FROM k),
t AS (SELECT codigo_entidad, CAST(greatest(1, ceil((anno - lo) * r.k / (hi - lo))) AS INTEGER) AS period, """
    + ", ".join(f"avg(CASE WHEN indicador = '{n}' THEN cents END) AS {a}" for n, a in _IND.items())
    + " FROM k, r GROUP BY 1, 2)"
)


@query(
    "D22_panel_features_absolute",
    _PERIODS
    + " SELECT codigo_entidad, "
    + ", ".join(
        f"round(coalesce(max(CASE WHEN period = {p} THEN {a} END), 0), 6) AS {a}_{p}" for a in _IND.values() for p in (1, 2, 3)
    )
    + " FROM t GROUP BY codigo_entidad",
)
def d22b(spark, d):
    out = Pn.panel_features(_numeric(spark, d), "codigo_entidad", "indicador", "valor", "anno", _IND, "abs")
    return rounded(out, **{c: 6 for c in out.columns if c != "codigo_entidad"})


@query(
    "D22_panel_features_relative",
    _PERIODS
    + ", j AS (SELECT t.codigo_entidad, t.period, "
    + ", ".join(f"round_even(t.{a} / q.{a} - 1, 4) * 100 AS {a}_r" for a in _IND.values())
    + " FROM t JOIN t q ON t.codigo_entidad = q.codigo_entidad AND t.period = q.period + 1) SELECT codigo_entidad, "
    + ", ".join(
        f"round(coalesce(max(CASE WHEN period = {p} THEN {a}_r END), 0), 6) AS {a}_r_{p}" for a in _IND.values() for p in (2, 3)
    )
    + " FROM j GROUP BY codigo_entidad",
)
def d22c(spark, d):
    out = Pn.panel_features(_numeric(spark, d), "codigo_entidad", "indicador", "valor", "anno", _IND, "rel")
    return rounded(out, **{c: 6 for c in out.columns if c != "codigo_entidad"})


@query(
    "D23_hierarchy_paths",
    """WITH RECURSIVE e AS (
SELECT NULL AS p, 'r' || r_regionkey AS node, r_name AS label FROM region
UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, n_name FROM nation
UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, s_name FROM supplier
UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, c_name FROM customer),
w AS (SELECT node, node AS root, 0 AS depth, label AS path FROM e WHERE p IS NULL
UNION ALL SELECT e.node, w.root, w.depth + 1, w.path || ' > ' || e.label FROM e JOIN w ON e.p = w.node)
SELECT node, root, CAST(depth AS INTEGER) AS depth, path FROM w""",
)
def d23(spark, d):
    def edges(name, parent, node, label):
        return table(spark, d, name).select(parent.alias("parents"), node.alias("ids"), F.col(label).alias("info"))

    def ident(prefix, col):
        return F.concat(F.lit(prefix), F.col(col).cast("string"))

    all_edges = (
        edges("region", F.lit(""), ident("r", "r_regionkey"), "r_name")
        .unionByName(edges("nation", ident("r", "n_regionkey"), ident("n", "n_nationkey"), "n_name"))
        .unionByName(edges("supplier", ident("n", "s_nationkey"), ident("s", "s_suppkey"), "s_name"))
        .unionByName(edges("customer", ident("n", "c_nationkey"), ident("c", "c_custkey"), "c_name"))
    )
    return Pn.hierarchy_paths(all_edges, "parents", "ids", "info")
