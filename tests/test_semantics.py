"""Hand-computed frames: NULL, infinity, ties, bins, votes and distances."""

from __future__ import annotations

import math

import pandas as pd
import pytest
from frames import rows
from pyspark.sql import functions as F

from tenderlens.functions import scalar as S
from tenderlens.functions.jaro import jaro_distances
from tenderlens.operators import aggregates as A
from tenderlens.operators import concentration as K
from tenderlens.operators import joins as J
from tenderlens.operators import reshape as Rs
from tenderlens.operators import stats as St
from tenderlens.operators import windows as Wn
from tenderlens.operators.fuzzy import fuzzy_join, similar_texts
from tenderlens.operators.quantiles import quantiles
from tenderlens.plans import identity as I
from tenderlens.plans import panel as Pn
from tenderlens.plans import places as P
from tenderlens.plans import quality as Q
from tenderlens.plans import risk as R


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_division_by_zero(spark):
    df = frame(spark, [(0.0, 0.0), (5.0, 0.0), (-5.0, 0.0), (10.0, 4.0), (None, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(S.r_div(F.col("a"), F.col("b"))).collect()]
    assert got == [None, math.inf, -math.inf, 2.5, None]


def test_anomaly_flags_on_undefined_and_infinite_rates(spark):
    df = frame(spark, [(0.0, 0.0), (0.0, 5.0), (4.0, 10.0)], "v double, p double").withColumn("a", F.lit(0.0))
    out = Q.value_anomalies(df, "v", "p", "a").select("odd_process_rate").collect()
    assert [r[0] for r in out] == [False, True, True]


def test_fill_keeps_negative_infinity(spark):
    df = frame(spark, [(math.inf,), (-math.inf,), (math.nan,), (None,), (1.0,)], "x double")
    assert [r[0] for r in S.fill_non_finite(df, 0).collect()] == [0.0, -math.inf, 0.0, 0.0, 1.0]


def test_membership_is_false_for_null(spark):
    df = frame(spark, [("a",), (None,)], "x string")
    assert [r[0] for r in df.select(~S.in_set(F.col("x"), ["a"])).collect()] == [False, True]


def test_null_key_join(spark):
    a, b = frame(spark, [(None, 1), ("k", 2)], "k string, x int"), frame(spark, [(None, 9)], "k string, y int")
    assert rows(J.join_null_safe(a, b, ["k"]), "x", "y") == [(1, 9), (2, None)]
    assert rows(J.left_join(a, b, "k"), "x", "y") == [(1, None), (2, None)]


def test_combine_treats_null_as_a_key(spark):
    a, b = frame(spark, [(None, 1), ("k", 2)], "k string, x int"), frame(spark, [(None, 9)], "k string, y int")
    assert rows(J.combine(["k"], a, b), "k", "x", "y") == [(None, 1, 9), ("k", 2, None)]


def test_anti_join_keeps_null(spark):
    a, b = frame(spark, [(None,), ("a",), ("b",)], "k string"), frame(spark, [("a",), (None,)], "k string")
    assert rows(J.keep_out(a, b, "k")) == [(None,), ("b",)]


def test_distinct_count_with_null(spark):
    df = frame(spark, [("a",), ("a",), (None,)], "x string")
    assert df.agg(A.n_distinct("x")).first()[0] == 2
    assert df.agg(A.sum_strict(F.col("x").isNull().cast("int"))).first()[0] == 1


def test_strict_sum(spark):
    df = frame(spark, [(1, 2.0), (1, None), (2, 3.0)], "g int, x double")
    assert rows(df.groupBy("g").agg(A.sum_strict("x").alias("s")), "g", "s") == [(1, None), (2, 3.0)]


SHARES = [("A", "x", 50.0), ("A", "x", 50.0), ("A", "y", 100.0), ("A", "z", 200.0)]


def test_concentration_by_hand(spark):
    df = frame(spark, SHARES, "b string, s string, v double")
    h = K.hhi(df, "b", "s", "v").first()
    assert (h["num_hhi"], h["val_hhi"]) == (37.5, 37.5)
    one, four = (K.concentration_ratio(df, "b", "s", "v", k).first() for k in (1, 4))
    assert (one["pnum_ick"], one["pval_ick"], four["pnum_ick"], four["pval_ick"]) == (50.0, 50.0, 100.0, 100.0)


def test_concentration_counts_null_counterpart_and_null_actor(spark):
    df = frame(spark, [(None, "x", 1.0), (None, None, 1.0), ("A", "x", 3.0)], "b string, s string, v double")
    got = {r["b"]: (r["num_hhi"], r["pnum_ick"]) for r in _hhi_and_ratio(df).collect()}
    assert got == {None: (50.0, 100.0), "A": (100.0, 100.0)}


def _hhi_and_ratio(df):
    return J.combine(["b"], K.hhi(df, "b", "s", "v"), K.concentration_ratio(df, "b", "s", "v", 2))


def test_invariants_on_the_tables(spark, sf_dir):
    from tenderlens.sources.contracts import contracts

    df = contracts(spark, sf_dir, ["buyer_id", "supplier_id", "val"])
    h = K.hhi(df, "supplier_id", "buyer_id", "val")
    one = K.concentration_ratio(df, "supplier_id", "buyer_id", "val", 1, ["n1", "v1"])
    four = K.concentration_ratio(df, "supplier_id", "buyer_id", "val", 4, ["n4", "v4"])
    bad = J.combine(["supplier_id"], h, one, four).filter(
        "not (num_hhi > 0 and num_hhi <= 100.0000001 and n1 <= n4 + 1e-9 and n4 <= 100.0000001 and v1 <= v4 + 1e-9 "
        "and num_hhi >= n1 * n1 / 100 - 1e-9 and val_hhi >= v1 * v1 / 100 - 1e-9)"
    )
    assert bad.count() == 0


def test_quantiles(spark):
    df = spark.range(1, 11).select(F.col("id").cast("double").alias("v"))
    got = quantiles(df, [], "v", {"a": 0.1, "b": 0.9, "c": 0.0, "d": 1.0}).first()
    assert [round(x, 9) for x in got] == [1.9, 9.1, 1.0, 10.0]


def test_quantile_selection_on_hard_values(spark):
    values = [None, -3.5, -3.5, 0.0, 1e-9, 1e-9, 1e12, -1e12, 7.0, 7.0, 7.0, 7.25]
    data = [("g", v) for v in values] + [(None, 2.0), ("empty", None)] + [("hot", float(i % 97)) for i in range(5000)]
    df = frame(spark, data, "g string, v double")
    probs = {"lo": 0.05, "q1": 0.25, "med": 0.5, "hi": 0.93}
    plain = df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
    a = rows(plain, "g", *probs)
    b = rows(quantiles(df, ["g"], "v", probs), "g", *probs)
    assert len(a) == len(b) == 4
    for x, y in zip(a, b):
        assert x[0] == y[0]
        assert all(p == q or math.isclose(p, q, rel_tol=1e-12) for p, q in zip(x[1:], y[1:]))


def test_hot_group_stays_whole(spark):
    """One actor holds a third of the rows: results equal the plain formulas."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("a"),
        (F.col("id") % 997).alias("c"),
        (F.col("id") % 1013).cast("double").alias("v"),
    )
    plain = df.groupBy("a", "c").agg(F.count("*").alias("n")).groupBy("a").agg(
        (F.sum(F.col("n") * F.col("n")) / F.pow(F.sum("n"), F.lit(2)) * 100).alias("h")
    )
    joined = K.hhi(df, "a", "c", "v").join(plain, "a")
    assert joined.filter(F.abs(F.col("num_hhi") - F.col("h")) > 1e-9).count() == 0
    assert joined.count() == df.select("a").distinct().count()
    direct = df.groupBy("a").agg(F.percentile("v", 0.5).alias("m"))
    picked = quantiles(df, ["a"], "v", {"m": 0.5})
    assert rows(direct) == rows(picked)


def test_top_k_limits_rows_before_the_shuffle(spark):
    df = frame(spark, SHARES, "b string, s string, v double")
    pairs = K.pair_totals(df, "b", "s", "v")
    plan = K.top_k_total(pairs, "b", "s", "n", 2, "t")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_cross_join_in_registered_plans(spark, sf_dir):
    import __spark_entry__ as entry

    for key in ("J8_fuzzy_join", "J9_fuzzy_left_join", "A26_density", "A25_histogram", "W8_zscore", "D17_composite_index"):
        plan = entry.queries()[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_period_bins(spark):
    df = frame(spark, [(y,) for y in range(2014, 2020)], "y int")
    out, bins = Rs.period_bins(df, "y")
    assert bins == [1, 2, 3] and [r["period"] for r in out.orderBy("y").collect()] == [1, 1, 2, 2, 3, 3]
    seven, bins = Rs.period_bins(frame(spark, [(y,) for y in range(1995, 2002)], "y int"), "y")
    assert bins == [1, 2, 3] and [r["period"] for r in seven.orderBy("y").collect()] == [1, 1, 1, 2, 2, 3, 3]
    single, bins = Rs.period_bins(frame(spark, [(2014,)], "y int"), "y")
    assert bins == [1] and single.first()["period"] == 1


def test_quantile_bucket_edges(spark):
    df = frame(spark, [(float(i),) for i in range(1, 11)], "v double")
    out = Rs.quantile_bucket(df, "v", Q.DECILES, Q.DECILE_LABELS).orderBy("v").collect()
    assert out[0]["bucket"] == "a" and out[-1]["bucket"] == "j"


def test_rate_of_change_gap_and_zero(spark):
    df = frame(spark, [("x", 1, 100.0), ("x", 2, 150.0), ("x", 3, 150.0), ("x", 5, 10.0), ("z", 1, 0.0), ("z", 2, 4.0)], "k string, t int, v double")
    out = Wn.rate_of_change(df, ["k"], "t", ["v"])
    assert rows(out, "k", "t", "v_r") == [("x", 2, 50.0), ("x", 3, 0.0), ("z", 2, math.inf)]
    assert rows(S.fill_non_finite(out, 0, ["v_r"]), "k", "v_r")[-1] == ("z", 0.0)


def test_row_ids_are_dense(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("name"))
    out = Wn.with_row_id(df, [F.asc("name")]).collect()
    want = {name: i for i, name in enumerate(sorted(r["name"] for r in out), 1)}
    assert all(r["row_id"] == want[r["name"]] for r in out)


def test_slices(spark):
    df = frame(spark, [("g", "b", 2), ("g", "a", 2), ("g", "c", 1), (None, "z", 5)], "g string, k string, n int")
    assert rows(Wn.slice_max(df, ["g"], "n", ["k"]), "g", "k") == [(None, "z"), ("g", "a")]
    ties = frame(spark, [("g", "b", 1), ("g", "a", 1), ("g", "c", 3)], "g string, k string, n int")
    assert rows(Wn.slice_min(ties, ["g"], "n"), "k") == [("a",), ("b",)]


# ---------------------------------------------------------------- text


def test_place_text(spark):
    df = frame(spark, [("Ñariño - San Pedro (2)",), ("Solo",)], "t string")
    dept, place = S.split_place(S.cut_before_note(F.col("t")))
    got = df.select(dept, place, S.place_key(place), S.place_key(dept)).collect()
    assert tuple(got[0]) == ("Ñariño", "San Pedro ", "SANPEDRO", "NARINO")
    assert got[1][0] is None and got[1][1] == "Solo"


def test_numbers_and_dates(spark):
    df = frame(spark, [("1.234,5", "2019-01-31"), ("x", "20190131"), ("", "2019/1/5"), ("-7", "bad")], "n string, d string")
    got = df.select(S.parse_locale_number(F.col("n")), S.parse_ymd(F.col("d")).cast("string")).collect()
    assert [tuple(r) for r in got] == [(1234.5, "2019-01-31"), (None, "2019-01-31"), (None, "2019-01-05"), (-7.0, None)]
    unit = frame(spark, [(2.0, "M"), (2.0, "other"), (2.0, None)], "v double, u string")
    assert [r[0] for r in unit.select(S.scale_units(F.col("v"), F.col("u"), {"M": 1e6})).collect()] == [2e6, 2.0, None]


def test_small_text_helpers(spark):
    df = frame(spark, [("a1b2", None)], "t string, n string")
    got = df.select(
        S.remove_first(F.col("t"), "[0-9]"),
        S.nth_part(F.col("t"), "-", 2),
        S.paste("_", F.col("t"), F.col("n")),
        S.truncate_label(F.lit("abcdefgh"), 6),
        S.fixed2(F.lit(1.005)),
    ).first()
    assert tuple(got)[:4] == ("ab2", "", "a1b2_NA", "abc...") and got[4] in ("1.00", "1.01")


def test_group_codes(spark):
    df = frame(spark, [("[D] Componentes",), ("[G] Terrenos, Edificios",)], "g string")
    strict = [r[0] for r in df.select(S.recode_regex(F.col("g"), Q.group_codes())).collect()]
    loose = [r[0] for r in df.select(S.recode_regex(F.col("g"), Q.group_codes(compat=True))).collect()]
    assert strict == ["4", "7"] and loose == ["3", "5"]


def test_term_days(spark):
    df = frame(spark, [(6.0, "M"), (130.0, "M"), (6.0, "D"), (6.0, None)], "t double, u string")
    assert [r[0] for r in df.select(S.term_days(F.col("t"), F.col("u"))).collect()] == [180.0, 130.0, 6.0, None]


def test_jaro_known_values():
    a = pd.Series(["MARTHA", "DWAYNE", "", "A", "abc", None])
    b = pd.Series(["MARHTA", "DUANE", "", "B", "", "x"])
    got = jaro_distances(a, b).tolist()
    assert [round(x, 4) for x in got[:5]] == [0.0556, 0.1778, 0.0, 1.0, 1.0] and math.isnan(got[5])


def test_fuzzy_join_against_brute_force(spark):
    """Blocking loses no pair: compare with all pairs of a small set of awkward names."""
    import itertools
    import random

    rng = random.Random(5)
    words = ["SANPEDRO", "SANPEDROS", "SANTAFE", "SANJOSEDECUCUTA", "CUCUTA", "A", "AB", "AAAAAAAA", "AAAAAAAB", "ÑANDU", "X1 Y2", ""]
    for _ in range(120):
        w = list(rng.choice(words[:5]))
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(w))
            w[i : i + 1] = rng.choice([[], [rng.choice("ABCDEO")], [w[i], rng.choice("AEIOU")]])
            if not w:
                break
        words.append("".join(w))
    words = sorted(set(words))
    pairs = list(itertools.product(words, words))
    dist = jaro_distances(pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs]))
    left = frame(spark, [(w,) for w in words], "x string")
    right = frame(spark, [(w,) for w in words], "y string")
    for limit in (0.0, 0.1, 0.2, 0.3):
        want = sorted(p for p, v in zip(pairs, dist) if v <= limit)
        got = sorted((r["x"], r["y"]) for r in similar_texts(left, "x", right, "y", limit, "d").collect())
        assert got == want, limit


def test_fuzzy_left_join_keeps_unmatched_and_null(spark):
    left = frame(spark, [(1, "ABCDEF"), (2, "ZZZZ"), (3, None)], "i int, x string")
    right = frame(spark, [("ABCDEG", 7)], "y string, code int")
    assert rows(fuzzy_join(left, right, [("x", "y")], 0.2, "left"), "i", "code") == [(1, 7), (2, None), (3, None)]


# ---------------------------------------------------------------- plans


def test_dominant_votes(spark):
    data = [(1, "N", 6), (1, "M", 4), (2, "P", 1), (2, "Q", 1), (3, "a", 1), (3, "b", 1), (3, None, 1)]
    df = frame(spark, data, "k int, v string, n int")
    out = I.resolve_dominant(df, "k", "v", "n", min_p=8)
    got = {(r["k"], r["v"]): r["resolved"] for r in out.collect()}
    assert got[1, "M"] == "N" and got[2, "P"] == "P" and got[2, "Q"] == "Q"
    assert {got[3, "a"], got[3, "b"], got[3, None]} == {"a"}


def test_sentinel_keeps_its_names(spark):
    data = [(1, "A", 9), (1, "B", 1), (1, "C", 1), (200000, "A", 1)]
    df = frame(spark, [(str(i), n, "r", "s", k, i, n) for i, n, k in data],
               "a string, b string, c string, d string, n int, id_new int, name_new string")
    out = I.resolve_identities(df, ["a", "b", "c", "d"])
    assert {r["name_std"] for r in out.filter("a = '1'").collect()} == {"A", "B", "C"}


def test_identity_repair_rules(spark):
    data = [
        ("NIT 900123456", "Empresa S.A.", "CC 1", "José"),
        ("Calle 200000", "Carrera 5", "12345678", "José"),
        (None, None, None, "Ana"),
        ("Ana", "", "CC 150000", "Ana"),
    ]
    df = frame(spark, data, "a string, b string, c string, d string")
    got = {r["a"]: (int(r["id_new"]), r["name_new"]) for r in I.repair_identity(df, "a", "b", "c", "d").collect()}
    assert got["NIT 900123456"] == (900123456, "EMPRESASA")
    assert got["Calle 200000"] == (12345678, "CARRERA5")
    assert got["Ana"] == (150000, "ANA")
    assert got[None] == (1, None)


def test_surrogates_follow_name_order(spark):
    df = frame(spark, [("B", "No registra"), ("A", "No registra"), ("C", "123"), ("A", "No registra")], "name string, nit string")
    out = rows(I.assign_surrogates(df, "name", "nit"), "name", "nit")
    assert out == [("A", "ND1"), ("A", "ND1"), ("B", "ND2"), ("C", "123")]


def test_allocation_sums_to_the_whole(spark):
    df = frame(spark, [("s", "A - x;B - y;B - y", 90.0), ("t", "A - x", 10.0)], "s string, m string, v double")
    out = P.explode_places(df, "m", "v")
    assert sorted(r["v"] for r in out.collect()) == [10.0, 30.0, 30.0, 30.0]
    shares = {(r["s"], r["place"]): r["p"] for r in P.activity_shares(out, "s", "place", "v").collect()}
    assert math.isclose(shares["s", "x"], 1 / 3) and math.isclose(shares["s", "y"], 2 / 3) and shares["t", "x"] == 1.0


def test_places_overrides_and_ties(spark):
    df = frame(spark, [("Sucre", "Since"), ("Sucre", "San Pedroo"), ("Nada", "Qwerty")], "d string, m string")
    gaz = frame(spark, [("SUCRE", "San Pedro", 5), ("SUCRE", "San Pedra", 4)], "gd string, gm string, code int")
    out = P.resolve_places(df, "d", "m", gaz, "gd", "gm", "code", P.BUYER_PLACE_FIXES)
    assert rows(out, "m", "place_code") == [("Qwerty", None), ("San Pedroo", 5), ("Since", 70742)]


GOLDEN = [
    (1391442, 1238316, 11), (51.47, 35.66, 30.72), (36993293.4752322, 28794196.315367, 22.16),
    (7773886800.131879, 1347154962.6948009, 82.67), (21014.313865665037, 4678.564207662383, 77.74), (139, 110, 20.86),
    (12.32, 1.45, 88.23), (31051, 28040, 9.7), (19.13, 6.15, 67.85), (2158, 2129, 1.34), (1.04, 0.55, 47.12),
    (94, 631, -571.28), (855, 898, -5.03), (51, 0, 100), (4.26, 0, 100), (291784, 233587, 19.95), (46313, 4528, 90.22),
    (18.52, 3.38, 81.75),
]


def test_published_scorecard_changes(spark):
    data = [(name, kind, float(a), float(b)) for (name, kind), (a, b, _) in zip(Q.SCORECARD, GOLDEN)]
    before = frame(spark, [(n, k, a) for n, k, a, _ in data], "indicador string, clase string, valor double")
    after = frame(spark, [(n, k, b) for n, k, _, b in data], "indicador string, clase string, valor double")
    got = {r["indicador"]: r["cambio"] for r in Q.compare_scorecards(before, after).collect()}
    assert got == {name: float(c) for (name, _), (_, _, c) in zip(Q.SCORECARD, GOLDEN)}


def test_levels_do_not_repeat_rows(spark):
    df = frame(spark, [("Colombia", "Colombia"), ("Cauca", "Cauca"), ("Cauca", "Cali"), ("Bogotá", "Bogotá")], "p string, m string")
    got = {k: v.count() for k, v in Pn.split_levels(df, "p", "m").items()}
    assert got == {"country": 1, "department": 2, "municipality": 2}


def test_hierarchy_cycle_is_reported(spark):
    df = frame(spark, [("", "a", "a"), ("a", "b", "b"), ("b", "c", "c")], "p string, i string, l string")
    assert rows(Pn.hierarchy_paths(df, "p", "i", "l"), "node", "path")[-1] == ("c", "a > b > c")
    loop = frame(spark, [("", "a", "a"), ("a", "b", "b"), ("b", "b", "b")], "p string, i string, l string")
    with pytest.raises(ValueError):
        Pn.hierarchy_paths(loop, "p", "i", "l")


def test_composite_bands(spark):
    df = frame(spark, [(1, 10.0), (2, 5.0), (3, 2.0)], "id int, x double")
    out = R.composite_index(df, ["x", "x"])
    assert rows(out, "id", "irc_band") == [(1, "Alto"), (2, "Medio"), (3, "Bajo")]


def test_constant_column_has_no_correlation(spark):
    df = frame(spark, [(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    got = {(r["var1"], r["var2"]): r["value"] for r in St.correlation_long(df, ["a", "b"]).collect()}
    assert got["a", "b"] is None and got["b", "b"] == 1.0


def test_density_integrates_to_one(spark):
    df = spark.range(2000).select((F.rand(3) * 10).alias("v"))
    out = St.density(df, "v", points=128).orderBy("grid").collect()
    step = out[1]["x"] - out[0]["x"]
    assert 0.9 < sum(r["density"] for r in out) * step <= 1.01


def test_model_metrics_by_hand(spark):
    from tenderlens.plans.models import test_metrics as metrics

    df = frame(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "prediction double, y double")
    got = metrics(df, "y").first()
    assert math.isclose(got["r2"], 1.0) and math.isclose(got["rmse"], math.sqrt(14 / 3))


def test_widen_many_leaves_null_keys_and_no_values(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (0, 1, 7.0), (0, 2, 9.0)], "a int, t int, v double")
    assert rows(Rs.widen_many(df, ["a"], "t", ["v"], [1, 2])) == [(None, 5.0, 0.0), (0, 7.0, 9.0)]
    assert rows(Rs.widen_many(df, ["a"], "t", ["v"], [])) == [(None,), (0,)]


def test_relative_periods_with_a_null_actor_and_with_one_period(spark):
    import datetime

    from tenderlens.plans import risk as R

    def contract(actor, other, year, val):
        return (actor, other, val, 0.0, 0, 1.0, "x", datetime.date(year, 5, 1), "f", "g")

    schema = "buyer_id int, supplier_id int, val double, addition double, ext_days int, term double, process_type string, signed date, family string, grp string"
    data = [contract(a, o, y, 10.0 * (y - 2009)) for a in (None, 0) for o in range(6) for y in range(2010, 2014)]
    out = R.indicators_by_period(spark.createDataFrame(data, schema), R.BUYERS, "rel")
    assert sorted(r["buyer_id"] is None for r in out.collect()) == [False, True]
    carried = R.Roles("buyer_id", "supplier_id", carried=("process_type",))
    for mode in ("abs", "rel"):
        wide = R.indicators_by_period(spark.createDataFrame(data, schema), carried, mode)
        assert {r["process_type"] for r in wide.collect()} == {"x"}
    assert {r["process_type"] for r in R.buyer_indicators(spark.createDataFrame(data, schema), carried).collect()} == {"x"}
    one = R.indicators_by_period(spark.createDataFrame([x for x in data if x[7].year == 2010], schema), R.BUYERS, "rel")
    assert not [c for c in one.columns if "_r_" in c] and one.count() == 0


def test_corrections_with_a_repeated_key_double_no_row(spark):
    from tenderlens.operators.joins import apply_corrections

    df = spark.createDataFrame([("u", 1.0), ("w", 2.0)], "url string, v double")
    fixes = spark.createDataFrame([("u", 9.0), ("u", 8.0)], "url string, real double")
    assert rows(apply_corrections(df, fixes, "url", {"v": "real"})) == [("u", 8.0), ("w", 2.0)]


def test_only_plain_decimal_numbers_are_numbers(spark):
    from tenderlens.functions.scalar import to_double

    texts = ["12D", "3f", "Infinity", "NaN", " -1.5 ", "2e3", ".5", "7.", "", "x", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["d"] for r in got.select("i", to_double(F.col("t")).alias("d")).orderBy("i").collect()]
    assert got == [None, None, None, None, -1.5, 2000.0, 0.5, 7.0, None, None, None]


def test_slice_max_takes_dates_and_text(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "b", 2), ("g", "b", 3), ("h", None, 4)], "g string, s string, k int")
    assert rows(Wn.slice_max(df, ["g"], "s", ["k"]), "g", "s", "k") == [("g", "b", 2), ("h", None, 4)]


def test_quantiles_of_nan_infinity_and_nothing(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, float("nan"))], "v double")
    assert tuple(quantiles(df, [], "v", {"m": 0.5, "x": 1.0}).first()) == (2.0, 3.0)
    ends = spark.createDataFrame([(v,) for v in (float("-inf"), 0.0, 5.0, float("inf"))], "v double")
    assert tuple(quantiles(ends, [], "v", {"a": 0.0, "m": 0.5, "z": 1.0}).first()) == (float("-inf"), 2.5, float("inf"))
    assert tuple(quantiles(df.limit(0), [], "v", {"m": 0.5}).first()) == (None,)


def test_least_squares_with_a_base_level(spark):
    import numpy as np

    from tenderlens.plans import models as M

    rng = np.random.default_rng(3)
    x, g = rng.normal(size=60), rng.integers(0, 3, 60)
    y = 2 + 3 * x + 5 * (g == 0) - 1 * (g == 1) + rng.normal(size=60)
    df = spark.createDataFrame([(i, float(a), "abc"[b], float(c)) for i, (a, b, c) in enumerate(zip(x, g, y))], "id int, x double, g string, y double")
    got = {r["term"]: r for r in M.coefficient_table(M.linear_regression(df, "y", ["id"]), df).collect()}
    design = np.column_stack([(x - x.mean()) / x.std(ddof=1), g == 0, g == 1, np.ones(60)]).astype(float)
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    s2 = ((y - design @ beta) ** 2).sum() / 56
    errors = np.sqrt(np.diag(s2 * np.linalg.inv(design.T @ design)))
    assert list(got) == ["x", "g=a", "g=b", "(intercept)"]
    for r, b, e in zip(got.values(), beta, errors):
        assert abs(r["estimate"] - b) < 1e-8 and abs(r["std_error"] - e) < 1e-8 and 0 <= r["p_value"] <= 1


def test_scratch_scope_removes_its_own_steps_only(spark, tmp_path):
    import os

    from tenderlens.session import cut_lineage, scratch_scope, shared_dir

    df = spark.range(5)
    kept = cut_lineage(df)
    before = set(os.listdir(shared_dir(spark)))
    with scratch_scope(spark):
        with scratch_scope(spark):
            cut_lineage(df)
            assert len(set(os.listdir(shared_dir(spark))) - before) == 1
        assert set(os.listdir(shared_dir(spark))) == before
        assert cut_lineage(df).count() == 5
    assert set(os.listdir(shared_dir(spark))) == before and kept.count() == 5
