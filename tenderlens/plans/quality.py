"""Contract standardisation, value anomalies, corrections and the quality scorecard."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.aggregates import n_distinct, share
from ..operators.joins import apply_corrections, join_null_safe, keep_in, keep_out, natural_join
from ..operators.quantiles import quantile_struct
from ..operators.reshape import quantile_bucket
from ..session import cut_lineage

# Category patterns (lower-case text) and their codes.
PROCESS_CODES = (
    ("licitación públ|obra públ|subasta", 1),
    ("selección abreviada", 2),
    ("concurso de méri", 3),
    ("contratación dir|dos pa", 4),
    ("mínima cuantía", 5),
    ("público privada", 6),
    ("régimen especial", 7),
)
CONTRACT_CODES = (
    ("marco|agregación de deman", 1),
    ("prestación de servicios", 2),
    ("compraventa", 3),
    ("concesión", 4),
    ("suministro", 5),
    ("obra", 6),
    ("interventoría|consultoría", 7),
    ("otro|no definido", 8),
)
SPECIAL_REGIME = "Régimen Especial"
FOREIGN_CURRENCY = "Dólares (USD)"
URL_PREFIX = r"https://www\.contratos\.gov\.co/consultas/detalleProceso\.do\?numConstancia="
DECILES = tuple(i / 10 for i in range(11))
DECILE_LABELS = tuple("abcdefghij")


def group_codes(compat: bool = False) -> tuple[tuple[str, str], ...]:
    """Codes of the goods groups [A]..[G].

    ``compat`` matches the capital letter anywhere in the text instead of the bracketed mark.
    """
    letters = "ABCDEFG"
    return tuple((f"[{x}]" if compat else rf"\[{x}\]", str(i)) for i, x in enumerate(letters, 1))


def standardize_contracts(
    df: DataFrame, last_year: int = 2019, compat: bool = False, write: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """Recode categories, unify terms, parse dates, drop duplicates and late years.

    Expects the raw contract columns; see ``RAW_CONTRACT_SCHEMA``. Duplicates leave by ``drop_duplicates``, for which
    ``write`` writes the recoded rows and reads them back.
    """
    c = F.col
    # lower-case once, not once per pattern
    out = df.withColumns({"tipo_proceso": F.lower("tipo_proceso"), "tipo_contrato": F.lower("tipo_contrato")})
    out = out.withColumns(
        {
            "ruta_web": S.remove_all(c("ruta_web"), URL_PREFIX),
            "nombre_entidad": S.nth_part(c("nombre_entidad"), " - ", 2),
            "tipo_proceso_cod": S.recode_regex(c("tipo_proceso"), PROCESS_CODES),
            "es_regimen_especial": S.flag(c("regimen_contratacion") == SPECIAL_REGIME),
            "tipo_contrato_cod": S.recode_regex(c("tipo_contrato"), CONTRACT_CODES),
            "son_cop": S.flag(c("moneda") != FOREIGN_CURRENCY),
            "plazo_ejec_contrato": S.term_days(c("plazo_ejec_contrato"), c("rango_ejec_contrato")),
            "adiciones_dias": S.extension_days(c("tiempo_adiciones_dias"), c("tiempo_adiciones_meses")),
            "nombre_grupo": S.recode_regex(c("nombre_grupo"), group_codes(compat)),
            "fecha_firma_contrato": S.parse_ymd(c("fecha_firma_contrato")),
        }
    ).drop(
        "tipo_proceso",
        "regimen_contratacion",
        "tipo_contrato",
        "moneda",
        "rango_ejec_contrato",
        "tiempo_adiciones_dias",
        "tiempo_adiciones_meses",
    )
    # the year test comes first: it shrinks what the duplicate removal has to write
    return drop_duplicates(out.filter(F.year("fecha_firma_contrato") <= last_year), write)


def drop_duplicates(df: DataFrame, write: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """Distinct rows of a wide table with few duplicates, without dealing all of its rows.

    The rows are written once, by ``write``. Hashes that occur more than once are counted and written; only rows with such a hash are
    compared as a whole, so two rows that merely share one both stay. Without room for a broadcast of these hashes the
    rows are dealt by hash, once for both halves.
    """
    rows = write(df)
    names = rows.columns
    rows = rows.withColumn("__hash", F.xxhash64(*names))
    repeated = rows.groupBy("__hash").agg(F.count("*").alias("__n")).filter(F.col("__n") > 1)
    repeated = cut_lineage(repeated.select("__hash", F.lit(True).alias("__seen")))
    marked = rows.join(repeated, "__hash", "left")
    once, several = marked.filter(F.col("__seen").isNull()), marked.filter(F.col("__seen"))
    return once.select(*names).unionByName(several.select(*names).distinct())


RAW_CONTRACT_SCHEMA = (
    "nit_entidad string, nombre_entidad string, tipo_id_contratista string, id_contratista string, "
    "razon_social_contratista string, tipo_doc_representate_legal string, id_representante_legal string, "
    "nombre_representante_legal string, cuantia_proceso double, valor_adiciones double, cuantia_contrato double, "
    "valor_total_con_adiciones double, moneda string, ruta_web string, tipo_proceso string, "
    "regimen_contratacion string, tipo_contrato string, municipio_ejecucion string, nombre_grupo string, "
    "nombre_familia string, dpto_mcpo_contratista string, fecha_firma_contrato string, plazo_ejec_contrato double, "
    "rango_ejec_contrato string, tiempo_adiciones_dias double, tiempo_adiciones_meses double, "
    "municipio_entidad string, departamento_entidad string"
)


# ---------------------------------------------------------------- anomalies


def anomaly_rules(
    value: str,
    process: str,
    addition: str,
    unit: float = 1e9,
    process_cuts: tuple[float, float] = (25, 250),
    addition_cuts: tuple[float, float] = (3, 150),
) -> dict[str, Column]:
    """Boolean rules; an undefined rate is not an anomaly, an infinite one is."""
    rate_p = S.pct(F.col(process), F.col(value))
    rate_a = S.pct(F.col(addition), F.col(value))
    off_p = (rate_p <= process_cuts[0]) | (rate_p >= process_cuts[1])
    off_a = (rate_a != 0) & ((rate_a <= addition_cuts[0]) | (rate_a >= addition_cuts[1]))
    return {
        "round_value": F.coalesce(S.is_multiple_of(F.col(value), unit), F.lit(False)),
        "odd_process_rate": F.coalesce(off_p, F.lit(False)),
        "odd_addition_rate": F.coalesce(off_a, F.lit(False)),
    }


def value_anomalies(df: DataFrame, value: str, process: str, addition: str, **kw) -> DataFrame:
    """Add both rates and the three anomaly flags to each contract."""
    return df.withColumns(
        {
            "process_rate": S.pct(F.col(process), F.col(value)),
            "addition_rate": S.pct(F.col(addition), F.col(value)),
            **anomaly_rules(value, process, addition, **kw),
        }
    )


def anomaly_by_decile(df: DataFrame, value: str, rules: Mapping[str, Column]) -> DataFrame:
    """Number and share of anomalies per value decile and rule."""
    marked = quantile_bucket(df.withColumns(dict(rules)), value, DECILES, DECILE_LABELS, "decile")
    grouped = marked.groupBy("decile").agg(
        *[F.count_if(F.col(r)).alias(f"n_{r}") for r in rules],
        *[share(F.col(r)).alias(f"p_{r}") for r in rules],
    )
    return grouped


# ---------------------------------------------------------------- corrections


def shared_urls(df: DataFrame, url: str) -> DataFrame:
    """Urls used by more than one contract."""
    return df.groupBy(url).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def _errors() -> Column:
    return F.col("error_cuantia_proceso") + F.col("error_cuantia_contrato") + F.col("error_adicion")


def correction_table(df: DataFrame, checked: DataFrame, url: str = "ruta_web") -> DataFrame:
    """Corrections that apply: validated, with an error, and to a url of a single contract."""
    cols = ["cuantia_proceso", "cuantia_contrato", "valor_adiciones", "valor_total_con_adiciones", url]
    c = F.col
    hits = natural_join(df.select(*cols), checked).filter(_errors() > 0)
    hits = keep_out(hits, shared_urls(df, url), url)
    real = c("cuantia_proceso_real")
    return hits.select(
        url,
        F.when(real.isNull() | (real == 1), c("cuantia_proceso")).otherwise(real).alias("cuantia_proceso_real"),
        F.coalesce("cuantia_contrato_real", "cuantia_contrato").alias("cuantia_contrato_real"),
        c("valor_adiciones").alias("valor_adicion_real"),
    ).distinct()


def correct_values(df: DataFrame, checked: DataFrame, low: float = 5e5, url: str = "ruta_web") -> DataFrame:
    """Overwrite wrong values from the validated table, then drop low values in local currency.

    Only contracts whose url may have a correction meet the validated values; the others stay where they are. The urls of a
    single contract with an error are written as hashes of four bytes: a url that shares the hash of another one is
    only looked up in vain.
    """
    single = df.groupBy(url).agg(F.count("*").alias("__n")).filter(F.col("__n") == 1)
    wrong = keep_in(single, checked.filter(_errors() > 0), url)
    wrong = cut_lineage(wrong.select(F.hash(url).alias("__hash")).distinct())
    hashed = df.withColumn("__hash", F.hash(url))
    rest = keep_out(hashed, wrong, "__hash").select(*df.columns)
    some = cut_lineage(keep_in(hashed, wrong, "__hash").select(*df.columns))
    fixed = apply_corrections(
        some,
        correction_table(some, checked, url),
        url,
        {
            "cuantia_proceso": "cuantia_proceso_real",
            "cuantia_contrato": "cuantia_contrato_real",
            "valor_adiciones": "valor_adicion_real",
        },
        derive={"valor_total_con_adiciones": F.col("cuantia_contrato") + F.col("valor_adiciones")},
    )
    out = rest.unionByName(fixed)
    return out.filter((F.col("valor_total_con_adiciones") > low) | (F.col("son_cop") != 1))


def review_high_values(
    df: DataFrame, value: str, process: str, addition: str, url: str, reviewed: DataFrame, p: float = 0.9
) -> DataFrame:
    """Contracts from the p-quantile upwards that nobody has reviewed, with their rates."""
    q = quantile_struct(df, value, {"cut": p})
    rest = keep_out(keep_out(df, reviewed, url), shared_urls(df, url), url)
    return value_anomalies(rest.filter(F.col(value) >= q["cut"]), value, process, addition)


# ---------------------------------------------------------------- scorecard


def identity_ambiguity(df: DataFrame, name: str, ident: str, value: str) -> DataFrame:
    """Names with several ids: how many, the value involved and its share."""
    ids = df.groupBy(name).agg(n_distinct(ident).alias("ids")).filter(F.col("ids") > 1)
    n = ids.agg(F.count("*").alias("n")).scalar()
    total = df.agg(F.sum(value).alias("v")).scalar()
    hit = join_null_safe(df, ids, [name], "left_semi").agg(F.sum(value).alias("v"))
    return hit.select(
        n.alias("n_names"),
        F.coalesce("v", F.lit(0.0)).alias("value"),
        S.pct(F.coalesce("v", F.lit(0.0)), total).alias("pct_value"),
    )


# Scorecard indicators in report order.
SCORECARD = (
    ("Cantidad de contratos", "General"),
    ("Valor total de contratos", "General"),
    ("Media valor total", "General"),
    ("Desviación E. valor total", "General"),
    ("Coeficiente variación valor total", "General"),
    ("Cantidad contratos en racha de 9 ceros", "Posible error en valor"),
    ("Valor de contratos en racha de 9 ceros", "Posible error en valor"),
    ("Cantidad contratos en tasa alta/baja en valor proceso/cuantia", "Posible error en valor"),
    ("Valor de contratos en tasa alta/baja en valor proceso/cuantia", "Posible error en valor"),
    ("Cantidad contratos en tasa alta/baja en valor adicion/cuantia", "Posible error en valor"),
    ("Valor de contratos en tasa alta/baja en valor adicion/cuantia", "Posible error en valor"),
    ("Valores atípicos", "Posible error en valor"),
    ("Número de entidades", "Errores en identificacion de actores"),
    ("Cantidad contratos con nit de entidad no registrado", "Errores en identificacion de actores"),
    ("Valor de contratos con nit de entidad no registrado", "Errores en identificacion de actores"),
    ("Número de contratistas", "Errores en identificacion de actores"),
    ("Número de contratistas con varios nits", "Errores en identificacion de actores"),
    ("Valor de contratos involucrados en contratistas con varios nits", "Errores en identificacion de actores"),
)


def quality_scorecard(
    df: DataFrame,
    value: str,
    process: str,
    addition: str,
    buyer: str,
    buyer_name: str,
    supplier: str,
    supplier_name: str,
    scale: float = 1e12,
    unit: float = 1e9,
    unregistered: Column | None = None,
) -> DataFrame:
    """The eighteen data-quality indicators as (indicador, clase, valor).

    The columns that are needed are written once and then read for sums and flags, for outliers, which need the mean and
    sd, and for one (buyer, name) and one (supplier, name) pre-aggregate. ``unregistered`` marks rows
    of buyers without a registered id; by default these are the ids with more than one name.
    """
    rules = anomaly_rules(value, process, addition, unit=unit)
    # sums, outliers, buyers and suppliers each read it: the columns they need are written once
    marks = {} if unregistered is None else {"__unregistered": unregistered}
    names = dict.fromkeys((value, process, addition, buyer, buyer_name, supplier, supplier_name))
    df = cut_lineage(df.select(*names, *[c.alias(n) for n, c in marks.items()]))
    unregistered = F.col("__unregistered") if marks else None
    flags = df.withColumns(rules)
    v = F.col(value)

    def in_units(c: Column) -> Column:
        return F.round(F.coalesce(c, F.lit(0.0)) / scale, 2)

    base = flags.agg(
        F.count("*").cast("double").alias("i0"),
        in_units(F.sum(v)).alias("i1"),
        F.avg(v).alias("i2"),
        F.stddev_samp(v).alias("i3"),
        S.pct(F.stddev_samp(v), F.avg(v)).alias("i4"),
        *[
            e
            for k, r in zip((5, 7, 9), rules)
            for e in (
                F.count_if(F.col(r)).cast("double").alias(f"i{k}"),
                in_units(F.sum(F.when(F.col(r), v))).alias(f"i{k + 1}"),
            )
        ],
    )
    # One row, written: mean and sd are not computed a second time for the outliers.
    base = cut_lineage(base)
    s = base.select(F.struct(F.col("i2").alias("m"), F.col("i3").alias("s")).alias("s")).scalar()
    z = S.r_div(v - s["m"], s["s"])
    outliers = df.agg(F.count_if((z > 3) | (z < -3)).cast("double").alias("n")).scalar()

    mark = F.max(unregistered if unregistered is not None else F.lit(False)).alias("u")
    buyers = df.groupBy(buyer, buyer_name).agg(F.sum(v).alias("v"), mark)
    buyers = buyers.groupBy(buyer).agg(F.count("*").alias("names"), F.sum("v").alias("v"), F.max("u").alias("u"))
    bad = F.col("u") if unregistered is not None else F.col("names") > 1
    b = buyers.agg(
        F.struct(
            F.count("*").cast("double").alias("n"),
            F.coalesce(F.sum(F.when(bad, F.col("names"))), F.lit(0)).cast("double").alias("bad"),
            in_units(F.sum(F.when(bad, F.col("v")))).alias("v"),
        ).alias("b")
    ).scalar()

    pairs = df.groupBy(supplier, supplier_name).agg(F.sum(v).alias("v"))
    n_suppliers = pairs.select(supplier).distinct().agg(F.count("*").cast("double").alias("n")).scalar()
    names = pairs.groupBy(supplier_name).agg(F.count("*").alias("ids"), F.sum("v").alias("v"))
    several = F.col("ids") > 1
    m = names.agg(
        F.struct(
            F.count_if(several).cast("double").alias("n"), in_units(F.sum(F.when(several, F.col("v")))).alias("v")
        ).alias("m")
    ).scalar()

    values = [F.col(f"i{k}") for k in range(11)]
    values += [outliers, b["n"], b["bad"], b["v"], n_suppliers, m["n"], m["v"]]
    rows = [
        F.struct(F.lit(i).alias("indicador"), F.lit(c).alias("clase"), x.alias("valor"))
        for (i, c), x in zip(SCORECARD, values)
    ]
    return base.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def compare_scorecards(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before/after table with the relative improvement in percent."""
    ini, fin = F.col("valor_inicial"), F.col("valor_final")
    joined = before.select("indicador", "clase", F.col("valor").alias("valor_inicial")).join(
        after.select("indicador", F.col("valor").alias("valor_final")), "indicador", "inner"
    )
    return joined.withColumn("cambio", F.bround(S.r_div(ini - fin, ini) * 100, 2))
