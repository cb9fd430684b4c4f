"""Raw contract records with the usual defects, derived from the test tables.

Each line item becomes one raw record in the source schema: free-text categories, ids mixed
with words, several places in one field, dates as text. Used to exercise the cleaning jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import table

# The expressions below are plain SQL that Spark and other engines read alike.

RAW_EXPRESSIONS = {
    "nit_entidad": "CASE WHEN s_nationkey = 3 THEN 'No registra' ELSE CAST(900000000 + s_suppkey AS STRING) END",
    "nombre_entidad": "concat('ANTIOQUIA - E.S.E. Hospital ', s_name)",
    "id_contratista": (
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('NIT ', CAST(800000000 + c_custkey AS STRING)) "
        "WHEN c_mktsegment = 'BUILDING' THEN 'No registra' "
        "WHEN c_mktsegment = 'FURNITURE' AND o_orderstatus = 'P' THEN concat('Calle ', CAST(200000 + c_custkey AS STRING)) "
        "ELSE CAST(800000000 + c_custkey AS STRING) END"
    ),
    "razon_social_contratista": (
        "CASE WHEN c_nationkey = 7 THEN '' "
        "WHEN c_nationkey = 5 THEN concat('Carrera ', CAST(c_custkey AS STRING)) "
        "WHEN o_orderstatus = 'P' THEN concat('Óptica ', translate(CAST(c_custkey AS STRING), '0123456789', 'ABCDEFGHIJ'), ' Ltda') "
        "ELSE concat('Óptica ', translate(CAST(c_custkey AS STRING), '0123456789', 'ABCDEFGHIJ')) END"
    ),
    "id_representante_legal": (
        "CASE WHEN c_nationkey = 7 THEN NULL ELSE concat('CC ', CAST(10000000 + c_nationkey * 1000 AS STRING)) END"
    ),
    "nombre_representante_legal": (
        "concat('José ', translate(CAST(c_nationkey AS STRING), '0123456789', 'ABCDEFGHIJ'))"
    ),
    "cuantia_proceso": "o_totalprice",
    "valor_adiciones": "l_extendedprice * l_discount",
    "cuantia_contrato": "l_extendedprice - l_extendedprice * l_discount",
    "valor_total_con_adiciones": "l_extendedprice",
    "moneda": "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Dólares (USD)' ELSE 'Peso Colombiano' END",
    "ruta_web": (
        "concat('https://www.contratos.gov.co/consultas/detalleProceso.do?numConstancia=', CAST(l_orderkey AS STRING))"
    ),
    "tipo_proceso": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Licitación Pública' WHEN '2-HIGH' THEN 'Selección Abreviada' "
        "WHEN '3-MEDIUM' THEN 'Contratación Mínima Cuantía' WHEN '4-NOT SPECIFIED' THEN 'Contratación Directa (Ley 1150)' "
        "ELSE 'Régimen Especial' END"
    ),
    "regimen_contratacion": (
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'Régimen Especial' WHEN o_orderpriority = '3-MEDIUM' THEN NULL "
        "ELSE 'Estatuto General de Contratación' END"
    ),
    "tipo_contrato": (
        "CASE p_type WHEN 'ECONOMY' THEN 'Prestación de Servicios' WHEN 'PROMO' THEN 'Suministro' WHEN 'SMALL' THEN 'Obra' "
        "WHEN 'LARGE' THEN 'Interventoría' WHEN 'MEDIUM' THEN 'Arrendamiento' ELSE 'Compraventa' END"
    ),
    "municipio_ejecucion": (
        "CASE WHEN l_linestatus = 'O' THEN concat(p_type, ' - ', p_name, ' (sede)') "
        "ELSE concat(p_type, ' - ', replace(p_name, 'i', 'í'), ';;', o_orderstatus, ' - ', p_name, ';', p_type, ' - ', p_name, '/otra') END"
    ),
    "nombre_grupo": (
        "CASE WHEN p_size < 10 THEN '[B] Materias Primas' WHEN p_size < 20 THEN '[D] Componentes y Suministros' "
        "WHEN p_size < 30 THEN '[E] Productos de Uso Final' WHEN p_size < 40 THEN '[F] Servicios' ELSE 'sin grupo' END"
    ),
    "nombre_familia": "p_name",
    "fecha_firma_contrato": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "plazo_ejec_contrato": "l_quantity",
    "rango_ejec_contrato": "CASE WHEN l_linestatus = 'O' THEN 'M' ELSE 'D' END",
    "tiempo_adiciones_dias": "CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END",
    "tiempo_adiciones_meses": "CAST(l_linenumber AS DOUBLE)",
    "municipio_entidad": "concat(n_name, '(cabecera)')",
    "departamento_entidad": "concat('DEPTO ', CAST(n_regionkey AS STRING))",
}

_FROM = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey"
)


def raw_sql(columns=None) -> str:
    """The raw view as one SELECT for the SQL equivalents."""
    names = columns or RAW_EXPRESSIONS
    return "SELECT " + ", ".join(f"{RAW_EXPRESSIONS[c]} AS {c}" for c in names) + " FROM " + _FROM


def raw_contracts(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """The raw view over the tables; unused columns are pruned from the scans.

    Each join on a large table moves the rows on its left: orders meet their customers before the line items do, the line
    items their parts while they are narrow, and the long names of the smallest tables come last.
    """

    def joined(df: DataFrame, name: str, left: str, right: str) -> DataFrame:
        return df.join(table(spark, sf_dir, name), F.col(left) == F.col(right), "inner")

    orders = joined(table(spark, sf_dir, "orders"), "customer", "o_custkey", "c_custkey")
    df = joined(table(spark, sf_dir, "lineitem"), "part", "l_partkey", "p_partkey")
    df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    df = joined(df, "supplier", "l_suppkey", "s_suppkey")
    df = joined(df, "nation", "s_nationkey", "n_nationkey")
    return df.select(*[F.expr(RAW_EXPRESSIONS[c]).alias(c) for c in columns or RAW_EXPRESSIONS])
