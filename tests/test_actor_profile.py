"""Profile of actors: distinct counts travel as pairs of columns, with NULL actors and NULL values."""

from __future__ import annotations

import statistics

from pyspark.sql import functions as F

from tenderlens.operators.aggregates import actor_profile


def test_profile_without_copies_of_the_rows(spark):
    rows = [(a, float(i % 7), f, i % 3 if a else None) for i, (a, f) in enumerate([(1, "x"), (1, None), (2, "x"), (None, "y"), (None, None), (2, "x"), (1, "z"), (3, None)] * 3)]
    df = spark.createDataFrame(rows, "a int, v double, f string, g int")
    got = actor_profile(df, ["a"], "v", {"n_f": "f", "n_g": F.col("g") % 2, "n_a": "a"}, extra=[F.max("f")], extra_names=["top"])
    assert got.columns == ["a", "n_contracts", "val_contracts", "val_mean", "val_median", "val_sd", "n_f", "n_g", "n_a", "top"]
    # an Expand sends every row once per distinct count, with room for all sums
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for a in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == a]
        v = [r[1] for r in own]
        n_g = len({r[3] if r[3] is None else r[3] % 2 for r in own})
        want[a] = (len(own), sum(v), statistics.median(v), len({r[2] for r in own}), n_g, 1, max((r[2] for r in own if r[2]), default=None))
    assert {r["a"]: (r["n_contracts"], r["val_contracts"], r["val_median"], r["n_f"], r["n_g"], r["n_a"], r["top"]) for r in got.collect()} == want
    plain = actor_profile(df, ["a"], "v", {}, with_median=False)
    assert plain.columns == ["a", "n_contracts", "val_contracts", "val_mean", "val_sd"] and plain.count() == 4
