"""Actor identities: surrogate ids, id and name repair, dominant-value voting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators.aggregates import n_distinct
from ..operators.joins import best_match, join_null_safe, keep_out
from ..operators.fuzzy import fuzzy_join
from ..operators.windows import with_row_id
from ..session import cut_lineage

# Words that mark a street address in a name field.
STREET_WORDS = ("CARRERA", "CRA", "KR", "CALLE", "CLL", "CLCRA", "AVENI", "MANZANACASA")
NO_ID = 1


# ---------------------------------------------------------------- unregistered buyers


def unregistered_names(df: DataFrame, name: str, ident: str) -> DataFrame:
    """Distinct names whose id field holds letters instead of an id."""
    return df.filter(F.col(ident).rlike(r"\p{IsAlphabetic}")).select(name).distinct()


def near_registered(df: DataFrame, name: str, ident: str, max_dist: float = 0.10) -> DataFrame:
    """Closest registered names of each unregistered one, ties kept, for review."""
    missing = unregistered_names(df, name, ident)
    known = keep_out(df.select(name, ident).distinct(), missing, name).withColumnRenamed(name, "registered_name")
    found = fuzzy_join(missing, known, [(name, "registered_name")], max_dist, "inner", least=True)
    return best_match(found, [name], "distance", tie=[], ties=True)


def assign_surrogates(df: DataFrame, name: str, ident: str, prefix: str = "ND") -> DataFrame:
    """Give unregistered buyers the ids ND1, ND2, ... in name order."""
    table = with_row_id(unregistered_names(df, name, ident), [F.col(name).asc()], "__n")
    table = table.select(name, F.concat(F.lit(prefix), F.col("__n").cast("string")).alias("__nd"))
    out = join_null_safe(df, table, [name], "left")
    return out.withColumn(ident, F.coalesce("__nd", ident)).drop("__nd")


# ---------------------------------------------------------------- supplier id and name repair


def decompose(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Split each field (column -> short name) into its number and its letters."""
    out = {}
    for col, short in fields.items():
        # whole numbers of up to 38 digits, so long ids keep every digit
        out[f"{short}_dig"] = S.digits_only(F.col(col)).try_cast("decimal(38,0)")
        out[f"{short}_alpha"] = S.name_key(S.letters_only(F.col(col)))
    return df.withColumns(out)


def repair_identity(
    df: DataFrame,
    ident: str,
    name: str,
    rep_id: str,
    rep_name: str,
    fixed_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``id_new`` and ``name_new`` from the first trustworthy source of each row."""
    d = decompose(df, {ident: "id", name: "nom", rep_id: "rid", rep_name: "rnom"})
    c = F.col
    id_new = (
        F.when((c("id_dig") > 180000) & ~S.in_set(c("id_alpha"), STREET_WORDS), c("id_dig"))
        .when((c("id_alpha") == c("rnom_alpha")) & (c("nom_dig") == c("rid_dig")), c("rid_dig"))
        .when((c("rid_dig") == c("rnom_dig")) & (c("rid_dig") > 1000), c("rid_dig"))
        .when(c("rid_dig") > 100000, c("rid_dig"))
        .otherwise(F.lit(NO_ID).cast("decimal(38,0)"))
    )
    street = c("nom_alpha").rlike("|".join(STREET_WORDS))
    empty = F.coalesce(c("nom_alpha") == "", F.lit(True))
    alnum = F.upper(S.remove_all(c(name), r"[^\p{IsAlphabetic}|0-9]"))
    name_new = (
        F.when(empty & (c("id_alpha") == c("rnom_alpha")) & (c("id_alpha") != ""), c("rnom_alpha"))
        .when(empty & (c("id_dig") == c("rid_dig")) & (c("rnom_alpha") != ""), c("rnom_alpha"))
        .when(street & c("nom_dig").isNull(), c("nom_alpha"))
        .when(street, alnum)
        .when(~street, c("nom_alpha"))
    )
    for key, value in (fixed_names or {}).items():
        name_new = F.when(c("id_alpha") == key, F.lit(value)).otherwise(name_new)
    return d.withColumns({"id_new": id_new, "name_new": name_new})


# ---------------------------------------------------------------- dominant values


def dominant_values(pairs: DataFrame, key: str, val: str, n: str) -> DataFrame:
    """Most frequent value per key with its share (%), for keys with several values.

    ``pairs`` has the rows to vote with their weights. Ties go to the smallest value, NULL last. Totals,
    counts and winner are all map-side partial aggregates, so the vote of a key shared by very
    many rows is not gathered in one task.
    """
    order = F.struct((-F.col(n)).alias("n"), F.col(val).isNull().alias("last"), F.col(val).alias("v"))
    top = pairs.groupBy(key).agg(
        F.min_by(F.struct(F.col(val).alias("v"), F.col(n).alias("n")), order).alias("t"),
        F.sum(n).alias("total"),
        n_distinct(val).alias("n_values"),
    )
    out = top.select(
        key, F.col("t.v").alias("dominant"), S.pct(F.col("t.n"), F.col("total")).alias("p"), "n_values"
    )
    return out.filter(F.col("n_values") > 1)


def resolve_dominant(
    pairs: DataFrame,
    key: str,
    val: str,
    n: str,
    min_p: float,
    many: int = 2,
    sure_p: float = 50.0,
    target: str = "resolved",
    skip: Column | None = None,
) -> DataFrame:
    """Replace ``val`` by the dominant value of its key where the vote is clear.

    Clear means a share above ``sure_p``, or above ``min_p`` with more than ``many`` values.
    ``skip`` excludes keys, such as a sentinel id shared by unrelated actors.
    """
    voters = pairs if skip is None else pairs.filter(~F.coalesce(skip, F.lit(False)))
    d = dominant_values(voters, key, val, n)
    clear = d.filter(((F.col("n_values") > many) & (F.col("p") > min_p)) | (F.col("p") > sure_p))
    clear = clear.select(key, F.col("dominant").alias("__dom"), F.lit(True).alias("__hit"))
    out = join_null_safe(pairs, clear, [key], "left")
    return out.withColumn(target, F.when(F.col("__hit"), F.coalesce("__dom", val)).otherwise(F.col(val))).drop(
        "__dom", "__hit"
    )


def resolve_identities(repaired: DataFrame, raw_keys: Sequence[str], n: str = "n") -> DataFrame:
    """Two voting passes: dominant name per id, then dominant id per name.

    ``repaired`` has one row per raw identity with ``id_new``, ``name_new`` and its number of
    contracts. Returns the raw identity with ``id_std`` and ``name_std``. The sentinel id takes
    no part in the first pass: its names belong to unrelated actors.

    Both passes read a table twice, to vote and to join the votes back, and the result joins the first table again: the
    repaired rows, their distinct pairs and the named pairs are written once each.
    """
    # only these columns; the numbers and letters of the fields are not needed any more
    repaired = cut_lineage(repaired.select(*raw_keys, "id_new", "name_new", F.col(n).alias("n")))
    unique = cut_lineage(repaired.groupBy("id_new", "name_new").agg(F.sum("n").alias("n")))
    named = resolve_dominant(
        unique, "id_new", "name_new", "n", min_p=8, target="name_std", skip=F.col("id_new") == NO_ID
    )
    named = cut_lineage(named)
    both = resolve_dominant(named, "name_std", "id_new", "n", min_p=4, target="id_std")
    both = both.select("id_new", "name_new", "id_std", "name_std")
    return join_null_safe(repaired, both, ["id_new", "name_new"], "left").select(*raw_keys, "id_std", "name_std")


def standardize_suppliers(
    contracts: DataFrame,
    ident: str,
    name: str,
    rep_id: str,
    rep_name: str,
    fixed_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Contracts with ``id_std`` and ``name_std``, joined back on the four raw fields."""
    raw = [ident, name, rep_id, rep_name]
    distinct = contracts.groupBy(*raw).agg(F.count("*").alias("n"))
    repaired = repair_identity(distinct, ident, name, rep_id, rep_name, fixed_names)
    return join_null_safe(contracts, resolve_identities(repaired, raw), raw, "left")
