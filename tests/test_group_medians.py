"""Medians of small groups travel once, and are those of the slices."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tenderlens.operators import quantiles as Q
from tenderlens.plans import risk as R
from tenderlens.session import cut_lineage


def test_small_and_large_groups_have_the_same_median(spark, monkeypatch):
    monkeypatch.setattr(Q, "SMALL", 5)
    rows = [("a", x) for x in (3.0, -1.0, None, 8.5)] + [("b", x) for x in (1.0, 2.0, 2.0, 7.0, 9.25, 4.0)] + [(None, float(x)) for x in range(9)]
    rows += [("n", None), ("x", math.nan), ("x", 4.0), ("i", math.inf), ("i", 1.0), ("z", -0.0), ("z", 0.0), ("y", math.nan)]
    df = cut_lineage(spark.createDataFrame(rows, "g string, v double"))
    got = {r["g"]: r["m"] for r in Q.median_by_size(df, ["g"], "v", "m").collect()}
    assert got == {r["g"]: r["m"] for r in Q.median(df, ["g"], "v", "m").collect()}
    assert got == {"a": 3.0, "b": 3.0, None: 4.0, "n": None, "x": 4.0, "i": math.inf, "z": 0.0, "y": None}
    assert Q.median_by_size(df.limit(0), ["g"], "v", "m").count() == 0


def test_pairs_of_actors_carry_rows_and_value_only(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(R, "pair_totals", lambda *a: seen.append(len(a)) or R_PAIRS(*a))
    rows = [(f"b{i % 2}", f"s{i % 7}", 1.0 + i, 0.5 * (i % 3), i % 4, 10, 4 if i % 5 == 0 else 1, None, f"f{i % 3}", "g") for i in range(40)]
    rows += [("b0", "s1", None, None, None, None, None, None, None, None), ("few", "s1", 1.0, 1.0, 1, 1, 4, None, "f", "g")]
    names = "buyer_id string, supplier_id string, val double, addition double, ext_days int, term int, process_type int, signed date, family string, grp string"
    df = cut_lineage(spark.createDataFrame(rows, names))
    r = R.Roles("buyer_id", "supplier_id", closed=(4,))
    out = R.actor_indicators(df, r)
    assert seen == [4]
    flags = R.red_flags(df, r)
    assert out.columns[: len(flags.columns)] == flags.columns
    key = F.col("buyer_id")
    for c in flags.columns[1:]:
        a, b = ({x[0]: x[1] for x in t.select(key, c).collect()} for t in (out, flags))
        assert a.keys() == b.keys() == {"b0", "b1"} and all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a), c


R_PAIRS = R.pair_totals
