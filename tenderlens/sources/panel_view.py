"""Long indicator panel in the 13-column source layout, derived from the contract view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.panel import PANEL_COLUMNS
from .contracts import contracts, table

# Panel rows are (place, contract type, year, month) means in whole units, written the local way.
PANEL_SQL = """
SELECT CAST(n_regionkey AS VARCHAR) AS codigo_departamento, r_name AS departamento, n_nationkey AS codigo_entidad,
CASE WHEN n_nationkey < 5 THEN r_name ELSE n_name END AS entidad, 'Finanzas' AS dimension,
CASE contract_type WHEN 'PROMO' THEN 'SGP - Distribución asignaciones SGP por sectores'
  WHEN 'SMALL' THEN 'SGP - Porcentaje de ejecución presupuestal por sector' ELSE 'Operaciones' END AS subcategoria,
contract_type AS indicador, v AS cents, CAST(NULL AS VARCHAR) AS dato_cualitativo, year AS anno, month AS mes, 'contratos' AS fuente,
CASE contract_type WHEN 'LARGE' THEN 'Millones de pesos corrientes' WHEN 'MEDIUM' THEN NULL ELSE 'Pesos' END AS und_medida
FROM (SELECT buyer_place, contract_type, year, month, CAST(floor(sum(val) / count(*)) AS BIGINT) AS v FROM c GROUP BY 1, 2, 3, 4)
JOIN nation ON buyer_place = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with its values as text such as '45.123,0'."""
    c = contracts(spark, sf_dir, ["buyer_place", "contract_type", "year", "month", "val"])
    means = c.groupBy("buyer_place", "contract_type", "year", "month").agg(
        F.floor(F.sum("val") / F.count("*")).cast("bigint").alias("v")
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    df = means.join(nation, F.col("buyer_place") == F.col("n_nationkey"), "inner").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "inner"
    )
    kind = F.col("contract_type")
    text = F.concat(F.translate(F.format_number("v", 0), ",", "."), F.lit(",0"))
    rows = df.select(
        F.col("n_regionkey").cast("string"),
        "r_name",
        "n_nationkey",
        F.when(F.col("n_nationkey") < 5, F.col("r_name")).otherwise(F.col("n_name")),
        F.lit("Finanzas"),
        F.when(kind == "PROMO", "SGP - Distribución asignaciones SGP por sectores")
        .when(kind == "SMALL", "SGP - Porcentaje de ejecución presupuestal por sector")
        .otherwise("Operaciones"),
        kind,
        text,
        F.lit(None).cast("string"),
        "year",
        "month",
        F.lit("contratos"),
        F.when(kind == "LARGE", "Millones de pesos corrientes").when(kind != "MEDIUM", "Pesos"),
    )
    return rows.toDF(*PANEL_COLUMNS)
