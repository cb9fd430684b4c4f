"""Cleaning jobs over the raw contract view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..plans import identity as I
from ..plans import places as P
from ..plans import quality as Q
from ..session import cut_lineage
from ..sources.contracts import contracts, table
from ..sources.raw_contracts import raw_contracts, raw_sql
from .base import C, query, rounded

_D1_COLUMNS = [
    "nit_entidad",
    "nombre_entidad",
    "valor_total_con_adiciones",
    "moneda",
    "ruta_web",
    "tipo_proceso",
    "regimen_contratacion",
    "tipo_contrato",
    "nombre_grupo",
    "fecha_firma_contrato",
    "plazo_ejec_contrato",
    "rango_ejec_contrato",
    "tiempo_adiciones_dias",
    "tiempo_adiciones_meses",
]


@query(
    "D1_standardize_contracts",
    f"""WITH raw AS ({raw_sql(_D1_COLUMNS)}),
twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE tiempo_adiciones_dias = 0)
SELECT DISTINCT nit_entidad, split_part(nombre_entidad, ' - ', 2) AS nombre_entidad, valor_total_con_adiciones,
replace(ruta_web, 'https://www.contratos.gov.co/consultas/detalleProceso.do?numConstancia=', '') AS ruta_web,
CASE WHEN tipo_proceso LIKE 'Licitación%' THEN 1 WHEN tipo_proceso LIKE 'Selección%' THEN 2 WHEN tipo_proceso LIKE '%Directa%' THEN 4
  WHEN tipo_proceso LIKE '%Mínima%' THEN 5 ELSE 7 END AS tipo_proceso_cod,
CASE WHEN regimen_contratacion = 'Régimen Especial' THEN 1 WHEN regimen_contratacion IS NOT NULL THEN 0 END AS es_regimen_especial,
CASE tipo_contrato WHEN 'Prestación de Servicios' THEN 2 WHEN 'Suministro' THEN 5 WHEN 'Obra' THEN 6 WHEN 'Interventoría' THEN 7
  WHEN 'Compraventa' THEN 3 END AS tipo_contrato_cod,
CASE WHEN moneda = 'Dólares (USD)' THEN 0 ELSE 1 END AS son_cop,
CASE WHEN rango_ejec_contrato = 'M' THEN plazo_ejec_contrato * 30 ELSE plazo_ejec_contrato END AS plazo_ejec_contrato,
tiempo_adiciones_dias + tiempo_adiciones_meses * 30 AS adiciones_dias,
CASE left(nombre_grupo, 3) WHEN '[B]' THEN '2' WHEN '[D]' THEN '4' WHEN '[E]' THEN '5' WHEN '[F]' THEN '6' END AS nombre_grupo,
CAST(fecha_firma_contrato AS DATE) AS fecha_firma_contrato
FROM twice WHERE year(CAST(fecha_firma_contrato AS DATE)) <= 2000""",
)
def d1(spark, d):
    raw = raw_contracts(spark, d, _D1_COLUMNS)
    # repeat part of the records so that duplicate removal has work to do
    copies = F.when(F.col("tiempo_adiciones_dias") == 0, F.lit(2)).otherwise(1)
    twice = raw.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    return Q.standardize_contracts(twice, last_year=2000)


_RATES = """, x AS (SELECT *, process_value / val * 100 AS process_rate, addition / val * 100 AS addition_rate FROM c),
a AS (SELECT *, val % 10 = 0 AND val > 0 AS round_value, process_rate <= 25 OR process_rate >= 250 AS odd_process_rate,
addition_rate <> 0 AND (addition_rate <= 3 OR addition_rate >= 150) AS odd_addition_rate FROM x)"""
_RULES = {"unit": 10}


@query(
    "D2_value_anomalies",
    C
    + _RATES
    + """ SELECT order_id, line_no, val, round(process_rate, 6) AS process_rate, round(addition_rate, 6) AS addition_rate,
round_value, odd_process_rate, odd_addition_rate FROM a""",
)
def d2(spark, d):
    df = contracts(spark, d, ["order_id", "line_no", "val", "process_value", "addition"])
    out = Q.value_anomalies(df, "val", "process_value", "addition", **_RULES).drop("process_value", "addition")
    return rounded(out, process_rate=6, addition_rate=6)


_DECILE = "CASE " + " ".join(
    f"WHEN val <= (SELECT quantile_cont(val, {i / 10}) FROM c) THEN '{label}'" for i, label in enumerate("abcdefghij", 1)
) + " END"


@query(
    "D3_anomaly_by_decile",
    C
    + _RATES
    + f""", t AS (SELECT *, {_DECILE} AS decile FROM a)
SELECT decile, """
    + ", ".join(
        f"CAST(count(CASE WHEN {r} THEN 1 END) AS BIGINT) AS n_{r}, round(100.0 * count(CASE WHEN {r} THEN 1 END) / count(*), 6) AS p_{r}"
        for r in ("round_value", "odd_process_rate", "odd_addition_rate")
    )
    + " FROM t GROUP BY decile",
)
def d3(spark, d):
    df = contracts(spark, d, ["val", "process_value", "addition"])
    rules = Q.anomaly_rules("val", "process_value", "addition", **_RULES)
    return rounded(Q.anomaly_by_decile(df, "val", rules), **{f"p_{r}": 6 for r in rules})


_CHECKED = """, v AS (SELECT CAST(o_orderkey AS VARCHAR) AS ruta_web, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS e1,
CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS e2, 0 AS e3,
CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 10 ELSE 1 END AS p_real,
CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 100 END AS c_real FROM orders)"""
_D4 = (
    "WITH k AS (SELECT CAST(l_orderkey AS VARCHAR) AS ruta_web, o_totalprice AS cuantia_proceso, "
    "l_extendedprice - l_extendedprice * l_discount AS cuantia_contrato, l_extendedprice * l_discount AS valor_adiciones, "
    "l_extendedprice AS valor_total_con_adiciones, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 0 ELSE 1 END AS son_cop "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"
    + _CHECKED
    + """, u AS (SELECT ruta_web FROM k GROUP BY 1 HAVING count(*) > 1),
f AS (SELECT k.ruta_web, CASE WHEN v.p_real IS NULL OR v.p_real = 1 THEN k.cuantia_proceso ELSE v.p_real END AS p,
      coalesce(v.c_real, k.cuantia_contrato) AS c, k.valor_adiciones AS a
      FROM k JOIN v USING (ruta_web) WHERE e1 + e2 + e3 > 0 AND ruta_web NOT IN (SELECT ruta_web FROM u)),
z AS (SELECT k.ruta_web, k.son_cop, coalesce(f.p, k.cuantia_proceso) AS cuantia_proceso, coalesce(f.c, k.cuantia_contrato) AS cuantia_contrato,
      coalesce(f.a, k.valor_adiciones) AS valor_adiciones, coalesce(f.c + f.a, k.valor_total_con_adiciones) AS valor_total_con_adiciones
      FROM k LEFT JOIN f USING (ruta_web))
SELECT ruta_web, son_cop, cuantia_proceso, round(cuantia_contrato, 4) AS cuantia_contrato, round(valor_adiciones, 4) AS valor_adiciones,
round(valor_total_con_adiciones, 4) AS valor_total_con_adiciones FROM z WHERE valor_total_con_adiciones > 3000 OR son_cop <> 1"""
)


@query("D4_correct_values", _D4)
def d4(spark, d):
    cols = ["cuantia_proceso", "cuantia_contrato", "valor_adiciones", "valor_total_con_adiciones", "ruta_web", "moneda"]
    df = raw_contracts(spark, d, cols)
    df = df.withColumns(
        {
            "ruta_web": S.remove_all(F.col("ruta_web"), Q.URL_PREFIX),
            "son_cop": S.flag(F.col("moneda") != Q.FOREIGN_CURRENCY),
        }
    ).drop("moneda")
    o = table(spark, d, "orders")
    wrong_process, wrong_value = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    checked = o.select(
        F.col("o_orderkey").cast("string").alias("ruta_web"),
        S.flag(wrong_process).alias("error_cuantia_proceso"),
        S.flag(wrong_value).alias("error_cuantia_contrato"),
        F.lit(0).alias("error_adicion"),
        F.when(wrong_process, F.col("o_totalprice") / 10).otherwise(1.0).alias("cuantia_proceso_real"),
        F.when(wrong_value, F.col("o_totalprice") / 100).alias("cuantia_contrato_real"),
    )
    out = Q.correct_values(df, checked, low=3000)
    return rounded(out, cuantia_contrato=4, valor_adiciones=4, valor_total_con_adiciones=4)


@query(
    "D4_review_high_values",
    C
    + """, u AS (SELECT order_id FROM c GROUP BY 1 HAVING count(*) > 1), seen AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
SELECT order_id, val, round(process_value / val * 100, 6) AS process_rate FROM c
WHERE val >= (SELECT quantile_cont(val, 0.9) FROM c) AND order_id NOT IN (SELECT * FROM u) AND order_id NOT IN (SELECT * FROM seen)""",
)
def d4b(spark, d):
    df = contracts(spark, d, ["order_id", "val", "process_value", "addition"])
    seen = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_id"))
    out = Q.review_high_values(df, "val", "process_value", "addition", "order_id", seen)
    return rounded(out.select("order_id", "val", "process_rate"), process_rate=6)


# ---------------------------------------------------------------- identities


@query(
    "D5_assign_surrogates",
    f"""WITH raw AS ({raw_sql(["nit_entidad", "nombre_entidad"])}),
t AS (SELECT nombre_entidad, 'ND' || row_number() OVER (ORDER BY nombre_entidad) AS nd FROM
      (SELECT DISTINCT nombre_entidad FROM raw WHERE regexp_matches(nit_entidad, '[A-Za-z]')))
SELECT nombre_entidad, coalesce(nd, nit_entidad) AS nit_entidad, CAST(count(*) AS BIGINT) AS n FROM raw LEFT JOIN t USING (nombre_entidad)
GROUP BY 1, 2""",
)
def d5(spark, d):
    raw = raw_contracts(spark, d, ["nit_entidad", "nombre_entidad"])
    out = I.assign_surrogates(raw, "nombre_entidad", "nit_entidad")
    return out.groupBy("nombre_entidad", "nit_entidad").agg(F.count("*").alias("n"))


@query(
    "D5_near_registered",
    f"""WITH raw AS ({raw_sql(["nit_entidad", "nombre_entidad"])}),
a AS (SELECT DISTINCT nombre_entidad FROM raw WHERE regexp_matches(nit_entidad, '[A-Za-z]')),
b AS (SELECT DISTINCT nombre_entidad AS registered_name, nit_entidad FROM raw WHERE nombre_entidad NOT IN (SELECT * FROM a)),
m AS (SELECT *, round(1 - jaro_similarity(nombre_entidad, registered_name), 9) AS dist FROM a, b
      WHERE 1 - jaro_similarity(nombre_entidad, registered_name) <= 0.1),
r AS (SELECT *, rank() OVER (PARTITION BY nombre_entidad ORDER BY dist) AS rk FROM m)
SELECT nombre_entidad, registered_name, nit_entidad, dist FROM r WHERE rk = 1""",
)
def d5b(spark, d):
    raw = raw_contracts(spark, d, ["nit_entidad", "nombre_entidad"])
    out = I.near_registered(raw, "nombre_entidad", "nit_entidad")
    return out.select("nombre_entidad", "registered_name", "nit_entidad", F.round("distance", 9).alias("dist"))


_RAW_ID = ["id_contratista", "razon_social_contratista", "id_representante_legal", "nombre_representante_legal"]


def _letters(c: str) -> str:
    return f"upper(strip_accents(regexp_replace({c}, '[^\\p{{L}}]', '', 'g')))"


def _digits(c: str) -> str:
    return f"try_cast(regexp_replace({c}, '[^0-9]', '', 'g') AS DECIMAL(38, 0))"


_STREET = "|".join(I.STREET_WORDS)
_D6 = (
    f"WITH raw AS ({raw_sql(_RAW_ID)}), g AS (SELECT {', '.join(_RAW_ID)}, CAST(count(*) AS BIGINT) AS n FROM raw GROUP BY 1, 2, 3, 4), "
    f"""e AS (SELECT *, {_digits('id_contratista')} AS id_d, {_letters('id_contratista')} AS id_a,
{_digits('razon_social_contratista')} AS no_d, {_letters('razon_social_contratista')} AS no_a,
{_digits('id_representante_legal')} AS ri_d, {_letters('nombre_representante_legal')} AS rn_a,
{_digits('nombre_representante_legal')} AS rn_d FROM g),
i AS (SELECT *, CASE WHEN id_d > 180000 AND NOT coalesce(id_a IN ({', '.join(repr(w) for w in I.STREET_WORDS)}), false) THEN id_d
WHEN id_a = rn_a AND no_d = ri_d THEN ri_d WHEN ri_d = rn_d AND ri_d > 1000 THEN ri_d WHEN ri_d > 100000 THEN ri_d ELSE 1 END AS id_new,
CASE WHEN coalesce(no_a = '', true) AND id_a = rn_a AND id_a <> '' THEN rn_a
WHEN coalesce(no_a = '', true) AND id_d = ri_d AND rn_a <> '' THEN rn_a
WHEN regexp_matches(no_a, '{_STREET}') AND no_d IS NULL THEN no_a
WHEN regexp_matches(no_a, '{_STREET}') THEN upper(regexp_replace(razon_social_contratista, '[^\\p{{L}}|0-9]', '', 'g'))
WHEN NOT regexp_matches(no_a, '{_STREET}') THEN no_a END AS name_new FROM e)"""
)


@query(
    "D6_repair_identity",
    _D6 + f" SELECT {', '.join(_RAW_ID)}, n, CAST(id_new AS BIGINT) AS id_new, name_new FROM i",
)
def d6(spark, d):
    raw = raw_contracts(spark, d, _RAW_ID).groupBy(*_RAW_ID).agg(F.count("*").alias("n"))
    out = I.repair_identity(raw, *_RAW_ID)
    return out.select(*_RAW_ID, "n", F.col("id_new").cast("bigint").alias("id_new"), "name_new")


_D7 = (
    _D6
    + """, u AS (SELECT id_new, name_new, sum(n) AS n FROM i GROUP BY 1, 2),
t1 AS (SELECT id_new, name_new, n * 100.0 / sum(n) OVER (PARTITION BY id_new) AS p, count(*) OVER (PARTITION BY id_new) AS k,
       row_number() OVER (PARTITION BY id_new ORDER BY n DESC, name_new) AS rn FROM u WHERE id_new <> 1),
w1 AS (SELECT id_new, name_new AS dom FROM t1 WHERE rn = 1 AND k > 1 AND ((k > 2 AND p > 8) OR p > 50)),
u2 AS (SELECT u.*, coalesce(w1.dom, u.name_new) AS name_std FROM u LEFT JOIN w1 USING (id_new)),
t2 AS (SELECT name_std, id_new, n * 100.0 / sum(n) OVER (PARTITION BY name_std) AS p,
       row_number() OVER (PARTITION BY name_std ORDER BY n DESC, id_new) AS rn FROM u2),
k2 AS (SELECT name_std, count(DISTINCT id_new) AS k FROM u2 GROUP BY 1),
w2 AS (SELECT t2.name_std, t2.id_new AS dom FROM t2 JOIN k2 ON t2.name_std IS NOT DISTINCT FROM k2.name_std
       WHERE rn = 1 AND k > 1 AND ((k > 2 AND p > 4) OR p > 50)),
u3 AS (SELECT u2.id_new, u2.name_new, u2.name_std, coalesce(w2.dom, u2.id_new) AS id_std
       FROM u2 LEFT JOIN w2 ON u2.name_std IS NOT DISTINCT FROM w2.name_std),
s AS (SELECT i.*, u3.id_std, u3.name_std FROM i LEFT JOIN u3 ON i.id_new = u3.id_new AND i.name_new IS NOT DISTINCT FROM u3.name_new)"""
)


@query(
    "D7_resolve_dominant",
    _D7 + f" SELECT {', '.join(_RAW_ID)}, CAST(id_std AS BIGINT) AS id_std, name_std FROM s",
)
def d7(spark, d):
    raw = raw_contracts(spark, d, _RAW_ID).groupBy(*_RAW_ID).agg(F.count("*").alias("n"))
    out = I.resolve_identities(I.repair_identity(raw, *_RAW_ID), _RAW_ID)
    return out.withColumn("id_std", F.col("id_std").cast("bigint"))


@query(
    "D7_standardize_suppliers",
    _D7
    + f""", v AS ({raw_sql([*_RAW_ID, "valor_total_con_adiciones"])})
SELECT CAST(s.id_std AS BIGINT) AS id_std, s.name_std, CAST(count(*) AS BIGINT) AS n, round(sum(v.valor_total_con_adiciones), 2) AS total
FROM v LEFT JOIN s ON """
    + " AND ".join(f"v.{c} IS NOT DISTINCT FROM s.{c}" for c in _RAW_ID)
    + " GROUP BY 1, 2",
)
def d7b(spark, d):
    raw = raw_contracts(spark, d, [*_RAW_ID, "valor_total_con_adiciones"])
    out = I.standardize_suppliers(raw, *_RAW_ID)
    out = out.groupBy(F.col("id_std").cast("bigint").alias("id_std"), "name_std").agg(
        F.count("*").alias("n"), F.sum("valor_total_con_adiciones").alias("total")
    )
    return rounded(out, total=2)


# ---------------------------------------------------------------- places


def _key(c: str) -> str:
    return f"upper(regexp_replace(strip_accents({c}), '[\\p{{P}}\\s]', '', 'g'))"


_GAZ = "gaz AS (SELECT p_type AS g_dept, p_name AS g_place, CAST(min(p_partkey) AS BIGINT) AS code FROM part GROUP BY 1, 2)"
_ALLOC = (
    f"""raw AS ({raw_sql(["municipio_ejecucion", "valor_total_con_adiciones", "id_contratista"])}),
e AS (SELECT *, list_filter(string_split(municipio_ejecucion, ';'), lambda x: x <> '') AS l FROM raw),
x AS (SELECT id_contratista, valor_total_con_adiciones / len(l) AS v, regexp_extract(unnest(l), '^([^/|(]*)', 1) AS t FROM e),
y AS (SELECT id_contratista, v, CASE WHEN instr(t, ' - ') > 0 THEN substr(t, 1, instr(t, ' - ') - 1) END AS department,
      CASE WHEN instr(t, ' - ') > 0 THEN substr(t, instr(t, ' - ') + 3) ELSE t END AS place FROM x)"""
)
_PLACES = (
    f"""{_ALLOC}, {_GAZ}, q AS (SELECT DISTINCT department, place FROM y),
k AS (SELECT *, {_key('department')} AS dk, {_key('place')} AS pk FROM q),
h AS (SELECT DISTINCT {_key('g_dept')} AS gd, {_key('g_place')} AS gp, code FROM gaz),
m AS (SELECT department, place, dk, pk, code, row_number() OVER (PARTITION BY department, place
      ORDER BY round((1 - jaro_similarity(pk, gp) + 1 - jaro_similarity(dk, gd)) / 2, 12), code) AS rn
      FROM k, h WHERE 1 - jaro_similarity(pk, gp) <= 0.2 AND 1 - jaro_similarity(dk, gd) <= 0.2),
b AS (SELECT k.department, k.place, CASE k.dk || k.pk WHEN 'OSMALLRING' THEN 999 WHEN 'PROMOBLUERING' THEN 998 ELSE m.code END AS place_code
      FROM k LEFT JOIN m ON k.department = m.department AND k.place = m.place AND m.rn = 1)"""
)
_FIXES = {"OSMALLRING": 999, "PROMOBLUERING": 998}


_LISTS = "municipio_ejecucion"


def _codes(spark, d, places):
    part = table(spark, d, "part")
    gaz = part.groupBy("p_type", "p_name").agg(F.min("p_partkey").alias("code"))
    return P.resolve_places(places, "department", "place", gaz, "p_type", "p_name", "code", _FIXES)


@query("D8_resolve_places", f"WITH {_PLACES} SELECT * FROM b")
def d8(spark, d):
    return _codes(spark, d, P.place_list(raw_contracts(spark, d, [_LISTS]), _LISTS))


@query(
    "D9_allocate_places",
    f"""WITH {_PLACES}, t AS (SELECT id_contratista, place_code, sum(v) AS v FROM y LEFT JOIN b
ON y.department IS NOT DISTINCT FROM b.department AND y.place = b.place GROUP BY 1, 2)
SELECT id_contratista, place_code, round(v / sum(v) OVER (PARTITION BY id_contratista), 9) AS p FROM t""",
)
def d9(spark, d):
    actor, value = "id_contratista", "valor_total_con_adiciones"
    # equal parts of a sum are sums of equal parts: contracts are added up before their lists are taken apart
    totals = raw_contracts(spark, d, [_LISTS, value, actor]).groupBy(actor, _LISTS).agg(F.sum(value).alias(value))
    totals = cut_lineage(totals)
    listed = cut_lineage(P.place_list(totals, _LISTS))
    coded = P.attach_place_code(listed, "department", "place", _codes(spark, d, listed))
    parts = coded.groupBy(_LISTS, "place_code").agg((F.count("*") / F.max("n_listed")).alias("part"))
    rows = totals.join(parts, _LISTS).withColumn(value, F.col(value) * F.col("part"))
    return rounded(P.activity_shares(rows, actor, "place_code", value), p=9)


# ---------------------------------------------------------------- scorecard

_CARD = (
    C
    + _RATES
    + """, st AS (SELECT avg(val) AS m, stddev_samp(val) AS s FROM c),
bn AS (SELECT buyer_id, count(DISTINCT buyer_name) AS names, sum(val) AS v FROM {bsrc} GROUP BY 1),
sn AS (SELECT supplier_name, count(DISTINCT supplier_id) AS ids, sum(val) AS v FROM {ssrc} GROUP BY 1),
card AS (SELECT unnest([{names}]) AS indicador, unnest([{classes}]) AS clase, unnest([
 (SELECT CAST(count(*) AS DOUBLE) FROM c), (SELECT round(sum(val) / 1e6, 2) FROM c), (SELECT m FROM st), (SELECT s FROM st), (SELECT s / m * 100 FROM st),
 (SELECT count(*) FROM a WHERE round_value), (SELECT round(coalesce(sum(val), 0) / 1e6, 2) FROM a WHERE round_value),
 (SELECT count(*) FROM a WHERE odd_process_rate), (SELECT round(coalesce(sum(val), 0) / 1e6, 2) FROM a WHERE odd_process_rate),
 (SELECT count(*) FROM a WHERE odd_addition_rate), (SELECT round(coalesce(sum(val), 0) / 1e6, 2) FROM a WHERE odd_addition_rate),
 (SELECT count(*) FROM c, st WHERE (val - m) / s > 3 OR (val - m) / s < -3),
 (SELECT count(*) FROM bn), (SELECT coalesce(sum(names), 0) FROM bn WHERE names > 1), (SELECT round(coalesce(sum(v), 0) / 1e6, 2) FROM bn WHERE names > 1),
 (SELECT count(DISTINCT supplier_id) FROM {ssrc}), (SELECT count(*) FROM sn WHERE ids > 1), (SELECT round(coalesce(sum(v), 0) / 1e6, 2) FROM sn WHERE ids > 1)
 ]) AS valor)"""
)


def _card_sql(bsrc: str = "c", ssrc: str = "c") -> str:
    names = ", ".join(f"'{i}'" for i, _ in Q.SCORECARD)
    classes = ", ".join(f"'{k}'" for _, k in Q.SCORECARD)
    return _CARD.format(names=names, classes=classes, bsrc=bsrc, ssrc=ssrc)


def _card_input(spark, d):
    return contracts(
        spark, d, ["val", "process_value", "addition", "buyer_id", "buyer_name", "buyer_place", "supplier_id", "seg"]
    )


def _card(df):
    """Buyers go by their place and suppliers by their segment, so that names and ids do not match one to one."""
    return Q.quality_scorecard(
        df, "val", "process_value", "addition", "buyer_place", "buyer_name", "supplier_id", "seg", scale=1e6, unit=10
    )


_SRC = "(SELECT buyer_place AS buyer_id, buyer_name, val FROM c)", "(SELECT seg AS supplier_name, supplier_id, val FROM c)"


@query("D10_quality_scorecard", _card_sql(*_SRC) + " SELECT indicador, clase, round(valor, 4) AS valor FROM card")
def d10(spark, d):
    return rounded(_card(_card_input(spark, d)), valor=4)


_AFTER = _card_sql(*_SRC).replace("JOIN part ON l_partkey = p_partkey", "JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > 5000")


@query(
    "D11_compare_scorecards",
    f"""WITH before_card AS ({_card_sql(*_SRC)} SELECT * FROM card), after_card AS ({_AFTER} SELECT * FROM card)
SELECT b.indicador, b.clase, round(b.valor, 4) AS valor_inicial, round(a.valor, 4) AS valor_final,
CASE WHEN b.valor <> 0 THEN round_even((b.valor - a.valor) / b.valor * 100, 2) END AS cambio
FROM before_card b JOIN after_card a USING (indicador)""",
)
def d11(spark, d):
    df = _card_input(spark, d)
    out = Q.compare_scorecards(_card(df), _card(df.filter("val > 5000")))
    return rounded(out, valor_inicial=4, valor_final=4)


@query(
    "D12_identity_ambiguity",
    f"""WITH raw AS ({raw_sql(["razon_social_contratista", "id_contratista", "valor_total_con_adiciones"])}),
t AS (SELECT razon_social_contratista FROM raw GROUP BY 1 HAVING count(DISTINCT id_contratista) > 1)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM t) AS n_names, round(sum(valor_total_con_adiciones), 2) AS value,
round(100 * sum(valor_total_con_adiciones) / (SELECT sum(valor_total_con_adiciones) FROM raw), 6) AS pct_value
FROM raw WHERE razon_social_contratista IN (SELECT * FROM t)""",
)
def d12(spark, d):
    raw = raw_contracts(spark, d, ["razon_social_contratista", "id_contratista", "valor_total_con_adiciones"])
    out = Q.identity_ambiguity(raw, "razon_social_contratista", "id_contratista", "valor_total_con_adiciones")
    return rounded(out, value=2, pct_value=6)
