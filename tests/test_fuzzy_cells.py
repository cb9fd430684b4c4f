"""Fuzzy join by cells of blocks: the pairs of brute force, also of texts that are all alike, and the nearest ones with ties."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from tenderlens.functions.jaro import jaro_distances
from tenderlens.operators import fuzzy
from tenderlens.plans import identity


def brute(left, right, most):
    pairs = [(a, b) for a in left for b in right]
    dist = jaro_distances(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    return {p: round(d, 12) for p, d in zip(pairs, dist) if d <= most}


def texts(n, seed):
    rnd = random.Random(seed)
    alike = [f"Hospital Supplier#{rnd.randrange(10**4):09d}" for _ in range(n)]
    words = ["".join(rnd.choices("aabcdeé中\U0001f600", k=rnd.randrange(1, 12))) for _ in range(n)]
    return sorted({*alike, *words, "", "x" * 300 + "y", "x" * 290, "İx"})


@pytest.mark.parametrize(("few", "blocks"), [(20_000, (512, 4096)), (20_000, (7, 11)), (0, (512, 4096))])
@pytest.mark.parametrize("swap", [False, True])
def test_pairs_of_brute_force(spark, monkeypatch, few, blocks, swap):
    monkeypatch.setattr(fuzzy, "_FEW", few)
    monkeypatch.setattr(fuzzy, "_SMALL_BLOCK", blocks[0])
    monkeypatch.setattr(fuzzy, "_LARGE_BLOCK", blocks[1])
    a, b = texts(12, 1), texts(60, 2)
    a, b = (b, a) if swap else (a, b)
    left = spark.createDataFrame([(t,) for t in [*a, None, a[-1]]], "x string")
    right = spark.createDataFrame([(t,) for t in [*b, None]], "y string")
    got = fuzzy.similar_texts(left, "x", right, "y", 0.15, "d")
    # texts that are all alike meet in hundreds of keys a pair: a small side goes without keys
    assert ("__key" in got._jdf.queryExecution().analyzed().toString()) == (few == 0)
    rows = [((r["x"], r["y"]), round(r["d"], 12)) for r in got.collect()]
    assert len(rows) == len(dict(rows)) and dict(rows) == brute(a, b, 0.15)


def test_bound_lets_all_near_pairs_pass():
    a, b = [[t for t in texts(40, s) if t] for s in (3, 4)]
    met = {(a[i], b[j]) for ii, jj in fuzzy._meet(a, b, 0.2) for i, j in zip(ii.tolist(), jj.tolist())}
    assert brute(a, b, 0.2).keys() <= met and len(met) < len(a) * len(b)
    assert list(fuzzy._meet(["a"], ["b"], 0.2)) == []


def test_nearest_with_ties(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "_AT_ONCE", 30)
    a, b = texts(15, 5), texts(80, 6)
    rows = [(t, "No registra") for t in a] + [(t, str(i)) for i, t in enumerate(b) if t not in a]
    known = [t for t in b if t not in a]
    got = {(r["x"], r["registered_name"]) for r in identity.near_registered(spark.createDataFrame(rows, "x string, id string"), "x", "id").collect()}
    near = brute(a, known, 0.1)
    best = {x: min(d for (z, _), d in near.items() if z == x) for x, _ in near}
    assert got == {(x, y) for (x, y), d in near.items() if d == best[x]}
    left, right = (spark.createDataFrame([(t, t) for t in c], f"{n} string, {n}2 string") for n, c in (("x", a), ("y", known)))
    assert 0 < fuzzy.fuzzy_join(left, right, [("x", "y")], 0.1, least=True).count() < len(near)
    with pytest.raises(ValueError, match="one pair"):
        fuzzy.fuzzy_join(left, right, [("x", "y"), ("x2", "y2")], 0.1, least=True)


@pytest.mark.parametrize("swap", [False, True])
def test_nearest_spares_most_distances(spark, monkeypatch, swap):
    """Texts that are all alike: the bound at the full radius lets all pairs pass, that at the nearest one only few."""
    rnd = random.Random(9)
    names = sorted({f"ANTIOQUIA - E.S.E. Hospital Supplier#{rnd.randrange(10**6):09d}" for _ in range(500)})
    a, b = (names[:40], names[40:]) if not swap else (names[40:], names[:40])
    near = brute(a, b, 0.1)
    best = {}
    for (x, _), d in near.items():
        best[x] = min(d, best.get(x, 1.0))
    left, right = (spark.createDataFrame([(t,) for t in c], f"{n} string") for n, c in (("x", a), ("y", b)))
    got = {(r["x"], r["y"]): round(r["d"], 12) for r in fuzzy.similar_texts(left, "x", right, "y", 0.1, "d", least=True).collect()}
    assert {p for p, d in near.items() if d == best[p[0]]} <= got.keys() and got.items() <= near.items()
    far = fuzzy.np.array([best[x] for x in a])
    small, large = (a, b) if len(a) < len(b) else (b, a)
    passed = lambda most: sum(len(i) for i, _ in fuzzy._meet(small, large, most))
    assert passed(far[:, None] if small is a else far[None, :]) < 0.2 * passed(0.1)
    first = {small[i] if not swap else large[j] for ii, jj in fuzzy._promising(small, large, 0.1, not swap) for i, j in zip(ii, jj)}
    assert first == set(a)
