"""The whole way from raw records to the index, for buyers and suppliers."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..plans import chain
from ..plans import risk as R
from ..session import scratch_path
from ..sources.contracts import table
from ..sources.files import Snapshots
from ..sources.raw_contracts import RAW_EXPRESSIONS, raw_contracts, raw_sql
from .base import C, query, rounded
from .cleaning import _CHECKED, _D7, _RAW_ID
from .risk import _MONEY, _full_sql

_KEPT = [c for c in RAW_EXPRESSIONS if c != "dpto_mcpo_contratista"]
_SAME = ", ".join(
    c for c in _KEPT
    if c not in {"tipo_proceso", "regimen_contratacion", "tipo_contrato", "moneda", "rango_ejec_contrato", "tiempo_adiciones_dias",
                 "tiempo_adiciones_meses", "ruta_web", "nombre_entidad", "plazo_ejec_contrato", "nombre_grupo", "fecha_firma_contrato"}
)
_STANDARD = f"""WITH r0 AS ({raw_sql(_KEPT)}),
r1 AS (SELECT DISTINCT {_SAME}, split_part(nombre_entidad, ' - ', 2) AS nombre_entidad,
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
FROM r0 WHERE year(CAST(fecha_firma_contrato AS DATE)) <= 2000)"""
_CORRECTED = (
    _STANDARD
    + _CHECKED
    + """, su AS (SELECT ruta_web FROM r1 GROUP BY 1 HAVING count(*) > 1),
fx AS (SELECT DISTINCT r1.ruta_web, CASE WHEN v.p_real IS NULL OR v.p_real = 1 THEN r1.cuantia_proceso ELSE v.p_real END AS fp,
       coalesce(v.c_real, r1.cuantia_contrato) AS fc, r1.valor_adiciones AS fa
       FROM r1 JOIN v USING (ruta_web) WHERE e1 + e2 + e3 > 0 AND ruta_web NOT IN (SELECT ruta_web FROM su)),
r2 AS (SELECT r1.* REPLACE (coalesce(fx.fp, cuantia_proceso) AS cuantia_proceso, coalesce(fx.fc, cuantia_contrato) AS cuantia_contrato,
       coalesce(fx.fa, valor_adiciones) AS valor_adiciones, coalesce(fx.fc + fx.fa, valor_total_con_adiciones) AS valor_total_con_adiciones)
       FROM r1 LEFT JOIN fx USING (ruta_web)),
r3 AS (SELECT * FROM r2 WHERE valor_total_con_adiciones > 3000 OR son_cop <> 1),
nd AS (SELECT nombre_entidad, 'ND' || row_number() OVER (ORDER BY nombre_entidad) AS nd FROM
       (SELECT DISTINCT nombre_entidad FROM r3 WHERE regexp_matches(nit_entidad, '[A-Za-z]'))),
raw AS (SELECT r3.* REPLACE (coalesce(nd.nd, nit_entidad) AS nit_entidad) FROM r3 LEFT JOIN nd USING (nombre_entidad)), """
)
# the identity step's last table gets a name that the shares' working tables do not have
_IDENTIFIED = _CORRECTED + _D7[_D7.index("g AS (SELECT") :].replace("\ns AS (", "\nsid AS (")
_CONTRACTS = (
    _IDENTIFIED
    + """, c AS (SELECT raw.nit_entidad AS buyer_id, CAST(sid.id_std AS BIGINT) AS supplier_id, sid.name_std AS supplier_name,
valor_total_con_adiciones AS val, valor_adiciones AS addition, adiciones_dias AS ext_days, plazo_ejec_contrato AS term,
tipo_proceso_cod AS process_type, fecha_firma_contrato AS signed, nombre_familia AS family, coalesce(nombre_grupo, 'none') AS grp, n_nationkey AS place_code
FROM raw LEFT JOIN sid ON """
    + " AND ".join(f"raw.{c} IS NOT DISTINCT FROM sid.{c}" for c in _RAW_ID)
    + " LEFT JOIN nation ON n_name = split_part(municipio_entidad, '(', 1))"
)
_PLAIN = (
    "pnum_closed", "pval_closed", "pnum_winners", "pnum_extended", "pval_extended", "pnum_added", "pval_added", "num_hhi", "val_hhi",
    "pnum_ick", "pval_ick", "irc",
)
# means of whole cents are never half-way between two numbers of seven digits
_DIGITS = {**_MONEY, "val_mean": 7, **{c: 6 for c in _PLAIN}}
_BAND = "CASE WHEN irc / (SELECT max(irc) FROM idx) < 0.444 THEN 'Bajo' WHEN irc / (SELECT max(irc) FROM idx) < 0.744 THEN 'Medio' ELSE 'Alto' END"


def _sql(actor: str, other: str, n: int, m: int, k: int, carried: str) -> str:
    text = _full_sql(actor, other, n, m, k, f", min({carried}) AS {carried}").replace("'4-NOT SPECIFIED'", "4")
    text = text[len(C) :]
    ints = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("n_contracts", "n_families", "n_groups", "n_counterparts"))
    cols = ", ".join(f"round({c}, {d}) AS {c}" for c, d in _DIGITS.items())
    return _CONTRACTS + text + f" SELECT a AS {actor}, {carried}, {ints}, {cols}, {_BAND} AS irc_band FROM idx"


def _clean(spark, d):
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
    gazetteer = table(spark, d, "nation").select(
        F.concat(F.lit("DEPTO "), F.col("n_regionkey").cast("string")).alias("department"),
        F.col("n_name").alias("place"),
        F.col("n_nationkey").alias("code"),
    )
    data = Snapshots(spark, scratch_path(spark, "chain"), "contracts")
    out = chain.clean_contracts(raw_contracts(spark, d, _KEPT), checked, gazetteer, data, last_year=2000, low=3000)
    return out.withColumn("supplier_id", F.col("supplier_id").cast("bigint"))


def _index(spark, d, roles, carried):
    out = chain.risk_index(_clean(spark, d), replace(roles, carried=(carried,)))
    return rounded(out, **_DIGITS)


@query("L1_buyer_index", _sql("buyer_id", "supplier_id", 6, 5, 4, "place_code"))
def l1_buyers(spark, d):
    """Raw records of all contracts to the index of the buyers, with the code of their place."""
    return _index(spark, d, R.BUYERS, "place_code")


@query("L1_supplier_index", _sql("supplier_id", "buyer_id", 3, 2, 1, "supplier_name"))
def l1_suppliers(spark, d):
    """The same for suppliers, with their standard name."""
    return _index(spark, d, R.SUPPLIERS, "supplier_name")
