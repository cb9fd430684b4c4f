"""The steps of the chain leave whole contracts where they are unless a step has something to change in them."""

from __future__ import annotations

import math
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tenderlens.plans import places, quality
from tenderlens.session import cut_lineage


@contextmanager
def broadcasts_below(spark, size):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain(df):
    return sorted((tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("alike", [False, True])
def test_duplicates_leave_without_dealing_all_rows(spark, monkeypatch, alike):
    if alike:  # rows that share a hash are compared as a whole
        monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    rows = [("a", 1.0), ("a", 1.0), ("a", None), (None, None), (None, None), ("b", math.nan), ("b", math.nan), ("c", 0.0), ("c", -0.0), ("d", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = quality.drop_duplicates(df)
    assert plain(out.withColumn("v", F.abs("v"))) == plain(df.distinct().withColumn("v", F.abs("v")))
    if not alike:
        assert "BroadcastHashJoin" in plan(out) and plan(out).count("Exchange hashpartitioning") == 1


def _contracts(spark, rows):
    names = "ruta_web string, cuantia_proceso double, cuantia_contrato double, valor_adiciones double, valor_total_con_adiciones double, son_cop int"
    return spark.createDataFrame(rows, names)


def _checked(spark, rows):
    names = "ruta_web string, error_cuantia_proceso int, error_cuantia_contrato int, error_adicion int, cuantia_proceso_real double, cuantia_contrato_real double"
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize("alike", [False, True])
def test_corrections_of_single_urls_only(spark, monkeypatch, alike):
    if alike:
        monkeypatch.setattr(quality.F, "hash", lambda *c: F.lit(7))
    df = _contracts(
        spark,
        [("one", 5.0, 4.0, 1.0, 5.0, 1), ("two", 5.0, 4.0, 1.0, 5.0, 1), ("two", 6.0, 4.0, 1.0, 5.0, 1), (None, 7.0, 4.0, 1.0, 5.0, 1),
         ("low", 8.0, 4.0, 1.0, 5.0, 1), ("foreign", 8.0, 4.0, 1.0, 5.0, 0), ("right", 9.0, 4.0, 1.0, 5.0, 1), ("unchecked", 9.0, 4.0, 1.0, 2.0, 1)],
    )
    checked = _checked(
        spark,
        [("one", 1, 0, 0, 50.0, None), ("one", 1, 0, 0, 40.0, 8.0), ("two", 1, 1, 0, 50.0, 9.0), (None, 1, 1, 0, 50.0, 9.0),
         ("low", 0, 1, 0, 1.0, 1.0), ("foreign", 0, 1, 0, None, 1.0), ("right", 0, 0, 0, 50.0, 9.0)],
    )
    assert plain(quality.correct_values(df, checked, low=3)) == plain(
        _contracts(
            spark,
            [("one", 40.0, 8.0, 1.0, 9.0, 1), ("two", 5.0, 4.0, 1.0, 5.0, 1), ("two", 6.0, 4.0, 1.0, 5.0, 1), (None, 7.0, 4.0, 1.0, 5.0, 1),
             ("foreign", 8.0, 1.0, 1.0, 2.0, 0), ("right", 9.0, 4.0, 1.0, 5.0, 1)],
        )
    )


def test_contracts_without_a_correction_are_not_dealt_by_url(spark):
    df = spark.range(20_000).select(
        F.concat(F.lit("https://url/"), F.col("id").cast("string")).alias("ruta_web"),
        *[F.rand(i).alias(c) for i, c in enumerate(("cuantia_proceso", "cuantia_contrato", "valor_adiciones", "valor_total_con_adiciones"))],
        F.lit(1).alias("son_cop"),
    )
    df = cut_lineage(df)
    checked = cut_lineage(_checked(spark, [(f"https://url/{i}", 1, 0, 0, 50.0, 2.0) for i in range(5)]))
    with broadcasts_below(spark, "32k"):
        out = quality.correct_values(df, checked, low=0)
        # the first half is the contracts without a correction
        node = out._jdf.queryExecution().sparkPlan()
        assert "Union" in node.toString()
        while node.nodeName() != "Union":
            node = node.children().apply(0)
        rest = node.children().apply(0).toString()
        assert "BroadcastHashJoin" in rest and "SortMergeJoin" not in rest
        assert out.count() == 20_000 and out.filter(F.col("cuantia_proceso") == 50).count() == 5


def test_contracts_are_not_dealt_by_place(spark):
    rows = cut_lineage(spark.range(20_000).select((F.col("id") % 3).cast("string").alias("d"), (F.col("id") % 7).cast("string").alias("p"), F.rand(1).alias("v")))
    codes = rows.groupBy("d", "p").agg(F.max("v").alias("place_code"))
    with broadcasts_below(spark, "32k"):
        out = places.attach_place_code(rows, "d", "p", codes)
        assert "SortMergeJoin" not in plan(out) and "BroadcastHashJoin" in plan(out)
        assert out.filter(F.col("place_code") >= F.col("v")).count() == 20_000
