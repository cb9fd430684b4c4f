"""Place codes by fuzzy gazetteer matching, and allocation of contract value to places."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.fuzzy import nearest_join
from ..operators.joins import join_null_safe, override
from ..operators.windows import share_of_total
from ..session import cut_lineage

TOLERANCE = 0.2

# Place keys (department + place) with their official code.
BUYER_PLACE_FIXES = {
    "SUCRESINCE": 70742,
    "PUTUMAYOPUERTOLEGUIZAMO": 86573,
    "ANTIOQUIASANPEDRODELOSMILAGROS": 5664,
    "CESARMANAUREBALCONDELCESAR": 20443,
    "NORTEDESANTANDERSANJOSEDECUCUTA": 54001,
    "TOLIMASANSEBASTIANDEMARIQUITA": 73443,
}
# Further keys seen among places of execution.
EXECUTION_PLACE_FIXES = {
    **BUYER_PLACE_FIXES,
    "CALDASMONTEBONITO": 17446,
    "COLOMBIATODOELPAIS": 0,
    "METAMEDELLINDEARIARI": 50251,
    "METASA": 50680,
    "NORTEDESANTANDERSALAZARDELASPALMAS": 54660,
    "NORTEDESANTANDERSANTODOMIGODESILOS": 54743,
    "OTROSPAISESOTRASCIUDADES": 1,
    "SANANDRESPROVIDENCIAYSANTACATALINAPROVIDENCIA": 88564,
    "SANANDRESPROVIDENCIAYSANTACATALINASANANDRES": 88001,
    "CALDASARAUCA": 17524,
    "CALDASBOLIVIA": 17541,
    "CUNDINAMARCATOLEMAIDA": 25488,
    "LAGUAJIRAPUERTOBOLIVAR": 44847,
    "MAGDALENAELDIFICIL": 47058,
    "NARINOBERRUECOS": 52051,
    "NARINOBOCASDESATINGA": 52490,
    "TOLIMAGUAYABAL": 73055,
    "NAVALLEDELCAUCA": 76001,
}


def resolve_places(
    df: DataFrame,
    dept: str,
    place: str,
    gazetteer: DataFrame,
    g_dept: str,
    g_place: str,
    g_code: str,
    overrides: Mapping[str, int] | None = None,
    max_dist: float = TOLERANCE,
    code: str = "place_code",
) -> DataFrame:
    """One row per distinct (department, place) of ``df`` with its gazetteer code or NULL.

    Both keys must be within the tolerance; the smallest mean distance wins, then the smallest
    code. Matching runs on distinct places only, and only those without an equal one in the gazetteer are searched around.
    """
    seen = cut_lineage(df.select(dept, place).distinct()).withColumns(
        {"__dk": S.place_key(F.col(dept)), "__pk": S.place_key(F.col(place))}
    )
    known = gazetteer.select(
        S.place_key(F.col(g_dept)).alias("__gd"), S.place_key(F.col(g_place)).alias("__gp"), F.col(g_code).alias(code)
    ).distinct()
    best = nearest_join(seen, known, [("__pk", "__gp"), ("__dk", "__gd")], max_dist, tie=code)
    if overrides:
        best = override(best, [F.col("__dk"), F.col("__pk")], code, overrides)
    return best.select(dept, place, code)


def attach_place_code(df: DataFrame, dept: str, place: str, codes: DataFrame) -> DataFrame:
    """Join the resolved codes back; missing departments match missing departments.

    The codes, one row per distinct place, are written first: a written table has a size that Spark knows, so the
    contracts are not dealt by place for the sake of a few codes.
    """
    return join_null_safe(df, cut_lineage(codes), [dept, place], "left")


def place_list(df: DataFrame, places: str, sep: str = ";") -> DataFrame:
    """Each distinct list of places taken apart: the list, its number of places, and a row per place named in it.

    Contracts share few lists, so patterns are applied to lists and not to contracts.
    """
    texts = df.select(places).where(F.col(places).isNotNull()).distinct()
    listed = F.filter(F.split(F.col(places), sep, -1), lambda x: x != "")
    out = texts.withColumn("__list", listed).withColumn("n_listed", F.size("__list")).withColumn("__raw", F.explode("__list"))
    dept, place = S.split_place(S.cut_before_note(F.col("__raw")))
    return out.select(places, "n_listed", dept.alias("department"), place.alias("place"))


def explode_places(df: DataFrame, places: str, value: str, sep: str = ";") -> DataFrame:
    """One row per named place with an equal part of the contract value."""
    return df.join(place_list(df, places, sep), places).withColumn(value, F.col(value) / F.col("n_listed")).drop("n_listed")


def activity_shares(allocated: DataFrame, actor: str, place: str, value: str) -> DataFrame:
    """Share of each actor's value per place."""
    totals = allocated.groupBy(actor, place).agg(F.sum(value).alias("value"))
    return share_of_total(totals, [actor], "value", "p").select(actor, place, "p")
