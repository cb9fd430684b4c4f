"""Territorial indicator panels: clean-up, features, enrichment and indicator hierarchies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.aggregates import panel_mean, weighted_exposure
from ..operators.joins import keep_in
from ..operators.reshape import period_bins, widen, widen_many
from ..operators.windows import rate_of_change
from ..session import cut_lineage

# Column names of the territorial panel, in file order.
PANEL_COLUMNS = (
    "codigo_departamento",
    "departamento",
    "codigo_entidad",
    "entidad",
    "dimension",
    "subcategoria",
    "indicador",
    "valor",
    "dato_cualitativo",
    "anno",
    "mes",
    "fuente",
    "und_medida",
)
# Transfer subcategories and the prefix that tells their indicators apart.
TRANSFER_PREFIXES = {
    "SGP - Distribución asignaciones SGP por sectores": "abs - ",
    "SGP - Distribución porcentual de asignaciones SGP por sectores": "ppa - ",
    "SGP - Porcentaje de ejecución presupuestal por sector": "ppe - ",
}
UNIT_FACTORS = {"Millones de pesos corrientes": 1e6}
COUNTRY = "Colombia"
CAPITAL = "Bogotá"

# Education indicators kept for the models, with their short names.
EDUCATION = {
    "Cobertura neta en educación - Total": "ine_coberturaNeta",
    "Porcentaje de asistencia de 5 a 24 años Urbana (Censo)": "ine_porcentajeAsistencia",
    "Puntaje promedio Pruebas Saber 11 - Lectura crítica": "ine_pruebaLecturaCritica",
    "Puntaje promedio Pruebas Saber 11 - Matemáticas": "ine_pruebaLecturaMatematicas",
    "Tasa de deserción intra-anual del sector oficial en educación básica y media "
    "(Desde transición hasta once)": "ine_tasaDesercion",
    "Tasa de repitencia del sector oficial en educación básica y media "
    "(Desde transición hasta once)": "ine_tasaRepitencia",
    "Tasa de Analfabetismo (Censo)": "ine_tasaAnalfabetismo",
}
# Public-finance indicators kept for the models, with their short names.
FINANCE = {
    "Ingresos totales": "inf_ingresos_m",
    "Financiamiento": "inf_financiamiento_m",
    "Indicador de desempeño fiscal": "inf_desempennofiscal_m",
    "Índice de gestión de proyectos de regalías (IGPR)": "inf_igpr_m",
    "Número total de proyectos": "inf_nproyectos_m",
    "ppa - Educación": "inf_peducacion_m",
    "ppa - Salud": "inf_psalud_m",
    "Regalías per cápita (Valor efectivamente girado al municipio)": "inf_regaliaspc_m",
    "Valor del número total de proyectos": "inf_vproyectos_m",
}


def clean_panel(df: DataFrame, years: tuple[int, int] = (2014, 2019)) -> DataFrame:
    """Year range, distinct indicator names, numeric values in single units."""
    c = F.col
    out = df.drop("dimension", "dato_cualitativo").filter(c("anno").between(*years))
    out = out.withColumn("indicador", S.prefix_by(c("indicador"), c("subcategoria"), TRANSFER_PREFIXES))
    number = S.parse_locale_number(c("valor"))
    return out.withColumn("valor", S.scale_units(number, c("und_medida"), UNIT_FACTORS))


def split_levels(
    df: DataFrame, parent: str, child: str, root: str = COUNTRY, also: Sequence[str] = (CAPITAL,)
) -> dict[str, DataFrame]:
    """Country, department and municipality rows.

    Places in ``also`` are department and municipality at once; they enter the municipal set once.
    """
    p, m = F.col(parent), F.col(child)
    return {
        "country": df.filter(p == root),
        "department": df.filter((p == m) & (p != root)),
        "municipality": df.filter((p != m) | S.in_set(p, also)),
    }


def level_of(parent: Column, child: Column, root: str, also: Sequence[str] = ()) -> Column:
    """The level(s) a row belongs to, as an array."""
    return F.array_compact(
        F.array(
            F.when(parent == root, F.lit("country")),
            F.when((parent == child) & (parent != root), F.lit("department")),
            F.when((parent != child) | S.in_set(parent, also), F.lit("municipality")),
        )
    )


def panel_features(
    df: DataFrame,
    place: str,
    name: str,
    value: str,
    year: str,
    indicators: Mapping[str, str],
    mode: str = "mean",
    width: int = 2,
) -> DataFrame:
    """Features per place from a long panel; ``indicators`` maps panel names to feature names.

    ``mean``: yearly mean, then mean over the years. ``abs``: mean per period, one column per
    period. ``rel``: change between consecutive periods, one column per period.
    """
    short = list(indicators.values())
    kept = df.filter(F.col(name).isin(list(indicators)))
    if mode == "mean":
        yearly = kept.groupBy(place, name, year).agg(F.avg(value).alias("__v"))
        wide = widen(yearly, [place, year], name, "__v", list(indicators)).withColumnsRenamed(dict(indicators))
        return panel_mean(wide, [place], short)
    kept, periods = period_bins(kept, year, width)
    by_period = kept.groupBy(place, "period").agg(
        *[F.avg(F.when(F.col(name) == n, F.col(value))).alias(a) for n, a in indicators.items()]
    )
    if mode == "abs":
        wide = widen_many(by_period, [place], "period", short, periods)
    elif mode == "rel":
        rates = rate_of_change(by_period, [place], "period", short)
        wide = widen_many(rates, [place], "period", [f"{s}_r" for s in short], periods[1:])
    else:
        raise ValueError("mode is 'mean', 'abs' or 'rel'")
    return S.fill_non_finite(wide, 0, [c for c in wide.columns if c != place])


def enrich_buyers(buyers: DataFrame, place: str, panels: Mapping[str, DataFrame]) -> DataFrame:
    """Attach place features to buyers; each panel is keyed by ``place``."""
    out = buyers
    for panel in panels.values():
        out = out.join(panel, place, "left")
    return out


def enrich_suppliers(
    activity: DataFrame, actors: DataFrame, panel: DataFrame, actor: str, place: str, weight: str, cols: Sequence[str]
) -> DataFrame:
    """Place features of the selected suppliers, weighted by their activity share."""
    return weighted_exposure(keep_in(activity, actors.select(actor), actor), panel, actor, place, weight, cols)


def hierarchy_paths(edges: DataFrame, parent: str, node: str, label: str) -> DataFrame:
    """Node, root, depth and path of every node below the roots of an edge list.

    Pointer doubling: every node starts with the stretch of itself alone, and in each round a stretch is put below the
    stretches of the node above it, so a chain of n levels takes log2(n) rounds of one equality join. A node with several
    parents has a row per path; one whose ancestors end without a root has none. A cycle is an error.
    """
    e = edges.select(
        F.nullif(F.col(parent).cast("string"), F.lit("")).alias("__up"),
        F.col(node).cast("string").alias("node"),
        F.col(label).cast("string").alias("label"),
    )
    now = cut_lineage(e.select("node", "__up", F.col("label").alias("path"), F.array("node").alias("__nodes"), F.lit(False).alias("__again")))
    while True:
        # no row yet knows more than what the next round reads: one written table per round
        open_, again = now.agg(F.count("__up"), F.max("__again")).first()
        if again:
            raise ValueError("the hierarchy is cyclic")
        if not open_:
            break
        above = now.select(
            F.col("node").alias("__at"), F.col("__up").alias("__next"), F.col("path").alias("__path"), F.col("__nodes").alias("__before")
        )
        longer = now.where("__up is not null").join(above, F.col("__up") == F.col("__at")).select(
            "node",
            F.col("__next").alias("__up"),
            F.concat_ws(" > ", "__path", "path").alias("path"),
            F.concat("__before", "__nodes").alias("__nodes"),
            F.arrays_overlap("__before", "__nodes").alias("__again"),
        )
        now = cut_lineage(now.where("__up is null").unionByName(longer))
    return now.select("node", F.col("__nodes")[0].alias("root"), (F.size("__nodes") - 1).alias("depth"), "path")
