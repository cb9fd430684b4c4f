"""Exact dedup by skew-safe combining (DataFrame functions only).

Copies meet in three stages, each comparing digest *and* full content: within a map task, within one salt of the
digest (the salt is the task number, so a text copied a billion times leaves every task as one row), and over the
salts of a digest. No stage gathers the rows of a group, only counts and the best row so far.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CLASS, step

_WORD = Decimal(1 << 64)
_TOP = Decimal((1 << 63) - 1)


def _rank(n: Column, row_id: Column) -> Column:
    """Larger is better: more code points, then the smaller id. One decimal, so that it fits a hash aggregate."""
    high = n.cast("decimal(11,0)") * F.lit(_WORD).cast("decimal(20,0)")
    return (high + (F.lit(_TOP).cast("decimal(20,0)") - row_id.cast("decimal(20,0)"))).cast("decimal(38,0)")


def _row_id(rank: Column) -> Column:
    return (F.lit(_TOP).cast("decimal(20,0)") - rank % F.lit(_WORD).cast("decimal(20,0)")).cast("long")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64, digest: Column | None = None
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical without white space (NULL counts as empty). The row with the most code points,
    then the smallest id, stays. Rows with a NULL id count in ``group_size`` and never win over a row with an id.
    Rows repeating the winner's id in the same group are all ``kept``. Other columns are ignored; an empty table
    gives an empty result. ``digest`` (a function of column ``norm``) only narrows the search: texts that share a
    digest and differ stay apart.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("long").alias("row_id"),
        F.char_length(text).alias("n"),
        F.regexp_replace(text, BLANK_CLASS + "+", "").alias("norm"),
    )
    sha = F.sha2(F.col("norm"), 256)
    base = base.withColumn("digest", sha if digest is None else digest).withColumn("sha", sha if digest is not None else F.col("digest"))
    ranked = base.select("digest", "norm", _rank(F.col("n"), F.col("row_id")).alias("best"))

    salted = (
        ranked.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "norm")
        .agg(F.count("*").alias("rows"), F.max("best").alias("best"))
    )
    groups = salted.groupBy("digest", "norm").agg(F.sum("rows").alias("group_size"), F.max("best").alias("best"))
    groups = groups.withColumn("keep_id", _row_id(F.col("best"))).drop("best")
    # Narrow copy of the winners. It tells whether any digest stands for two texts; then rows find theirs by content.
    narrow = step(groups.select("digest", "keep_id", "group_size"), "exact-dedup")
    shared = narrow.groupBy("digest").count().where("count > 1").limit(1)
    if shared.isEmpty():
        joined = base.select("row_id", "digest", "sha").join(narrow, "digest")
    else:
        joined = base.join(groups, ["digest", "norm"])
    return joined.select(
        F.col("row_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("row_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
