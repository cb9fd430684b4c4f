"""Joins with R-compatible NULL matching, update joins and period joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL matches NULL; the left key columns are kept.

    Spark still hashes or sorts on null-safe equality, so this is not a nested loop.
    """
    tag = "__right_"
    renamed = right.withColumnsRenamed({k: tag + k for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(tag + k)) for k in keys])
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[tag + k for k in keys])


def combine(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Put tables with at most one row per key side by side (a full outer join on all of them).

    A union and one aggregate: one shuffle for any number of tables, and NULL is a key like any
    other. Columns besides the keys have different names in each table.
    """
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in keys]
    return out.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])


def left_join(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return left.join(right, key, "left")


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on every shared column."""
    shared = [c for c in left.columns if c in set(right.columns)]
    if not shared:
        raise ValueError("the two tables share no column")
    return left.join(right, shared, "inner")


def keep_in(df: DataFrame, members: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return df.join(members, key, "left_semi")


def keep_out(df: DataFrame, members: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``members``; a NULL key is kept."""
    return df.join(members, key, "left_anti")


def apply_corrections(
    df: DataFrame, fixes: DataFrame, key: str, cols: Mapping[str, str], derive: Mapping[str, Column] | None = None
) -> DataFrame:
    """Overwrite ``cols`` (column -> correction column) where ``fixes`` has a row for the key.

    Of several rows for a key the one with the smallest corrections counts, so no row is doubled. ``derive``
    recomputes columns of the corrected rows.
    """
    fix = F.min(F.struct(*[F.col(src).alias(f"__fix_{dst}") for dst, src in cols.items()])).alias("__f")
    marked = fixes.groupBy(key).agg(fix).select(key, "__f.*", F.lit(True).alias("__fixed"))
    out = df.join(marked, key, "left")
    out = out.withColumns({dst: F.when(F.col("__fixed"), F.col(f"__fix_{dst}")).otherwise(F.col(dst)) for dst in cols})
    if derive:
        out = out.withColumns({n: F.when(F.col("__fixed"), e).otherwise(F.col(n)) for n, e in derive.items()})
    return out.select(*df.columns)


def map_values(df: DataFrame, col: str, mapping: Mapping, target: str | None = None) -> DataFrame:
    """Recode through a literal dictionary; values outside it become NULL."""
    spark = df.sparkSession
    kind = dict(df.dtypes)[col]
    rows = [(k, v) for k, v in mapping.items()]
    names = spark.createDataFrame(rows, f"`{col}` {kind}, __mapped string")
    joined = df.join(names, col, "left")
    target = target or col
    order = df.columns if target in df.columns else [*df.columns, target]
    return joined.withColumn(target, F.col("__mapped")).select(*order)


def override(df: DataFrame, keys: Sequence[Column], target: str, fixes: Mapping[str, object]) -> DataFrame:
    """Force ``target`` to a constant where the concatenated key is listed in ``fixes``."""
    kind = dict(df.dtypes)[target]
    table = df.sparkSession.createDataFrame([(k, str(v)) for k, v in fixes.items()], "__key string, __value string")
    keyed = df.withColumn("__key", F.concat(*[F.coalesce(k.cast("string"), F.lit("NA")) for k in keys]))
    joined = keyed.join(table, "__key", "left")
    return joined.withColumn(target, F.coalesce(F.col("__value").cast(kind), F.col(target))).select(*df.columns)


def prior_period(df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str], suffix: str = "1") -> DataFrame:
    """Attach the values of period t-1 and drop rows that have no such period.

    ``df`` has one row per (keys, t), so each window holds at most one row per period.
    """
    w = Window.partitionBy(*keys).orderBy(t)
    out = df.withColumns({f"{c}{suffix}": F.lag(c).over(w) for c in cols} | {"__prev": F.lag(t).over(w)})
    return out.filter(F.col("__prev") == F.col(t) - 1).drop("__prev")


def match_keys(df: DataFrame, pairs: Sequence[tuple[str, str]], prefix: str = "key") -> DataFrame:
    """One boolean column per pair of columns telling whether they agree."""
    return df.withColumns({f"{prefix}{i}": F.col(a) == F.col(b) for i, (a, b) in enumerate(pairs, 1)})


def best_match(df: DataFrame, keys: Sequence[str], dist: str, tie: Sequence[str], ties: bool = False) -> DataFrame:
    """Closest candidate per key; ``ties=True`` keeps every candidate at the least distance.

    Both forms reduce inside each map task first, so a key with very many candidates is fine.
    """
    if ties:
        least = df.groupBy(*keys).agg(F.min(dist).alias("__least"))
        joined = join_null_safe(df, least, keys, "inner")
        return joined.filter(F.col(dist).eqNullSafe(F.col("__least"))).select(*df.columns)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(dist).isNull().alias("n"), F.col(dist).alias("d"), *[F.col(c) for c in tie])
    top = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__top"))
    return top.select(*keys, *[F.col("__top")[c].alias(c) for c in rest]).select(*df.columns)
