"""From raw contract records to the risk index of their actors, step by step through one named dataset."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..sources.files import Snapshots
from . import identity, places, quality, risk

#: The code of closed procurement, and the raw columns of an actor's identity.
CLOSED = (4,)
IDENTITY = ("id_contratista", "razon_social_contratista", "id_representante_legal", "nombre_representante_legal")

#: Columns that the indicators read, by their names in the cleaned records
_COLUMNS = {
    "buyer_id": "nit_entidad",
    "supplier_id": "id_std",
    "supplier_name": "name_std",
    "val": "valor_total_con_adiciones",
    "addition": "valor_adiciones",
    "ext_days": "adiciones_dias",
    "term": "plazo_ejec_contrato",
    "process_type": "tipo_proceso_cod",
    "signed": "fecha_firma_contrato",
    "family": "nombre_familia",
    "grp": "nombre_grupo",
    "place_code": "place_code",
}


def clean_contracts(raw: DataFrame, checked: DataFrame, gazetteer: DataFrame, data: Snapshots, last_year: int = 2019, low: float = 5e5) -> DataFrame:
    """Standardised, corrected, identified and placed contracts.

    ``checked`` are the validated values, ``gazetteer`` has (department, place, code). Each version of ``data`` is read by name
    by the steps after it; a step that fails leaves the version before. The first version has the recoded records, the
    second the distinct and corrected ones, both with all columns. Places and identities are both looked up in the
    second, so the contracts move once, with the columns that the indicators read; that third version is returned, under
    the names that the indicators use.
    """

    def step(df: DataFrame) -> DataFrame:
        data.write(df)
        return data.read()

    standard = quality.standardize_contracts(raw, last_year, write=step)
    rows = step(quality.correct_values(standard, checked, low)).withColumn("__place", S.cut_before_note(F.col("municipio_entidad")))
    codes = places.resolve_places(rows, "departamento_entidad", "__place", gazetteer, "department", "place", "code")
    named = identity.assign_surrogates(rows, "nombre_entidad", "nit_entidad")
    placed = places.attach_place_code(named, "departamento_entidad", "__place", codes)
    kept = [c for c in _COLUMNS.values() if c in placed.columns]
    identified = identity.standardize_suppliers(placed.select(*kept, *IDENTITY), *IDENTITY)
    return step(identified.select(*[F.col(c).alias(n) for n, c in _COLUMNS.items()]))


def risk_index(contracts: DataFrame, roles: risk.Roles) -> DataFrame:
    """Indicators of one kind of actor with its carried attributes, the composite index and its band."""
    return risk.composite_index(risk.actor_indicators(contracts, replace(roles, closed=CLOSED)))
