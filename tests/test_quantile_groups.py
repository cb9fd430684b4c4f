"""Groups come from the values themselves: no list of groups is made and joined to the quantiles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tenderlens.operators.quantiles import quantiles


def test_groups_without_a_value_need_no_list_of_groups(spark):
    rows = [("a", 1.0), ("a", 4.0), ("a", None), ("b", None), ("b", None), (None, 3.0), (None, float("nan")), ("c", float("nan")), ("d", math.inf), ("d", 2.0), ("d", 2.0)]
    df = spark.createDataFrame(rows * 2, "g string, v double")
    out = quantiles(df, ["g"], "v", {"q": 0.5, "low": 0.0})
    assert out.columns == ["g", "q", "low"]
    assert {r["g"]: (r["q"], r["low"]) for r in out.collect()} == {"a": (2.5, 1.0), "b": (None, None), None: (3.0, 3.0), "c": (None, None), "d": (2.0, 2.0)}
    # the groups are not listed apart and joined back
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "Join LeftOuter" not in plan
    empty = df.where(F.lit(False))
    assert quantiles(empty, ["g"], "v", {"q": 0.5}).count() == 0
    assert [tuple(r) for r in quantiles(empty, [], "v", {"q": 0.5}).collect()] == [(None,)]
    assert [tuple(r) for r in quantiles(df, [], "v", {"q": 0.5}).collect()] == [(2.5,)]
