"""Fuzzy joins on the Jaro distance without comparing every pair.

If two texts of lengths n and l have distance <= d, then with s = 1 - d they share at least
o = (3s - 1) * n * l / (n + l) characters (as a multiset), and neither is shorter than (3s - 2) times the other. Put
the characters of both in one order, rare ones first. Of the characters they share, take the first T + 1: they form T
neighbouring pairs. At most (n - o) / g of those have g or more foreign characters between them in the one text, and
(l - o) / g in the other. So with T above the sum of both, one pair stands at most g places apart in both texts, within the first
T + 1 + n - o characters of the one and T + 1 + l - o of the other. Candidates come from an equality join on such pairs.

Lengths fall into classes, each a quarter wider than the one before, and a text gives its pairs once per class that its
partners can be in: about g keys per character and class, linear in its length. T and g are chosen per pair of classes;
where texts share too few characters for it (very short ones, or very unequal ones), the key is a single character. No
partner is lost. Candidates are made distinct, and a bound by character counts goes before the distance.

Where one side has few texts, keys cost more than they save, above all where texts are alike and each pair meets in hundreds
of keys. There blocks of the small side meet blocks of the large one in cells; the bound, a few nanoseconds a pair, is taken
for all pairs of a cell, the distance for those it leaves. Where only the nearest are asked for, two passes over the cells spare most
distances: the first takes those of each text's most promising partners in a cell, the second, for each text, only
pairs whose bound reaches the least distance found.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jaro import jaro_distances, jaro_within
from ..session import cut_lineage
from .joins import join_null_safe

_EPS = 1e-9
#: Buckets in which characters are counted, so that the counts are a small table whatever the alphabet; places apart at most.
_BUCKETS, _MOST_APART = 4096, 6
#: Most texts of the smaller side for cells instead of keys; texts of a cell's two blocks on average; pairs compared at once; tasks.
_FEW, _SMALL_BLOCK, _LARGE_BLOCK, _AT_ONCE, _MOST_TASKS = 20_000, 512, 4096, 50_000, 400
#: Partners of a text in a cell whose distances tell how far to look for the nearest.
_PROMISING = 8


def _numbered(text: Column) -> Column:
    """Characters numbered by occurrence and hashed: sets of them intersect as the multisets of characters do."""
    # the one-element array binds the sorted characters once per text
    bound = F.transform(
        F.array(F.sort_array(F.split(text, ""))),
        lambda chars: F.transform(chars, lambda c, i: F.xxhash64(c, i - F.array_position(chars, c).cast("int") + 1)),
    )
    return bound[0]


def _bucket(token: Column) -> Column:
    return F.pmod(token, F.lit(_BUCKETS)).cast("int")


def _class(n: Column) -> Column:
    """Length class: single lengths up to 8, then each a quarter wider than the one before; 0 is the empty text."""
    return F.when(n <= 8, n).otherwise((8 + F.floor(F.log(n / 8.0) / math.log(1.25) + _EPS)).cast("int"))


def _plan(mine: dict[int, tuple[int, int]], theirs: dict[int, tuple[int, int]], s: float) -> list[tuple]:
    """(class, partner class, partner's least length, g, T) for all pairs of classes (class -> least and most length) that can
    hold partners; g = 0 stands for single characters."""
    c, r = 3 * s - 1, 3 * s - 2
    out = []
    for a, (a0, a1) in mine.items():
        for b, (b0, b1) in theirs.items():
            if a1 < r * b0 - _EPS or b1 < r * a0 - _EPS:
                continue
            n0, l0 = max(a0, math.ceil(r * b0 - _EPS)), max(b0, math.ceil(r * a0 - _EPS))
            n1, l1 = min(a1, math.floor(b1 / r + _EPS)), min(b1, math.floor(a1 / r + _EPS))
            share = math.ceil(c * n0 * l0 / (n0 + l0) - _EPS)
            # characters that need not be shared: largest for the longest text and its shortest partner
            miss = [
                math.floor(x - c * x * y / (x + y) + _EPS) for x, y in ((n1, max(b0, r * n1)), (l1, max(a0, r * l1)))
            ]
            ways = [(g, miss[0] // g + miss[1] // g + 1) for g in range(1, _MOST_APART + 1)]
            ways = [(g * (t + 1 + sum(miss)), g, t) for g, t in ways if t + 1 <= share]
            _, g, t = min(ways, default=(0, 0, 0))
            out.append((a, b, b0, g, t))
    return out


def _keys(texts: DataFrame, text: str, plan: list[tuple], s: float, left: bool) -> DataFrame:
    """A row per text and key. ``texts`` has the text, its ordered characters and its class."""
    c, r = 3 * s - 1, 3 * s - 2
    df = texts.join(texts.sparkSession.createDataFrame(plan, "__class int, __other int, __low int, __g int, __t int"), "__class")
    n = F.size("__chars")
    low = F.greatest(F.col("__low"), F.ceil(n * r - _EPS).cast("int"))
    miss = n - F.greatest(F.ceil(c * n * low / (n + low) - _EPS).cast("int"), F.lit(1))
    length = F.least(n, F.when(F.col("__g") == 0, miss + 1).otherwise(F.col("__t") + 1 + miss))
    df = df.withColumn("__first", F.slice("__chars", F.lit(1), F.greatest(length, F.lit(0))))
    pair = F.struct("__class", "__other") if left else F.struct("__other", "__class")
    size = F.size("__first")

    def apart(g):
        m = F.greatest(size - g, F.lit(0))
        return F.zip_with(F.slice("__first", F.lit(1), m), F.slice("__first", g + 1, m), lambda a, b: F.xxhash64(pair, a, b))

    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest("__g", F.lit(1))), apart))
    single = F.transform("__first", lambda a: F.xxhash64(pair, a))
    return df.select(text, F.explode(F.array_distinct(F.when(F.col("__g") == 0, single).otherwise(pairs))).alias("__key"))


def _tallies(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and how many characters of each of 64 classes of code points each text has (classes x texts)."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32) & 63
    row = np.repeat(np.arange(len(texts)), lengths)
    counts = np.bincount(codes * len(texts) + row, minlength=64 * len(texts)).reshape(64, -1)
    return lengths, counts.astype(np.uint8 if lengths.max(initial=0) < 256 else np.int32)


def _shared(small: list[str], large: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each place of ``small`` its text's length, how many characters it shares at most with each of ``large``, and their lengths."""
    (n, a), (k, b) = _tallies(small), _tallies(large)
    if a.dtype != b.dtype:
        a, b = a.astype(np.int32), b.astype(np.int32)
    for i, length in enumerate(n.tolist()):
        shared = np.zeros(len(large), a.dtype)
        for c in np.flatnonzero(a[:, i]).tolist():
            shared += np.minimum(b[c], a[c, i])
        yield i, length, shared, k


def _need(max_dist: float | np.ndarray, small: list[str], large: list[str]) -> np.ndarray:
    return np.broadcast_to(3 * (1 - np.asarray(max_dist, float)) - 1, (len(small), len(large)))


def _meet(small: list[str], large: list[str], max_dist: float | np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places that the character counts allow to be within ``max_dist``, some ten thousands at a time.

    ``max_dist`` is one number, or one per text of a side (a column for ``small``, a row for ``large``)."""
    need = _need(max_dist, small, large)
    lists, held = [], 0
    for i, length, shared, k in _shared(small, large):
        js = np.flatnonzero((shared > 0) & (shared >= need[i] / (1 / length + 1 / k) - 1e-6))
        lists.append((np.full(len(js), i), js))
        held += len(js)
        if held >= _AT_ONCE:
            yield tuple(np.concatenate(c) for c in zip(*lists))
            lists, held = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*lists))


def _promising(small: list[str], large: list[str], max_dist: float, of_small: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places: for each text of the one side, partners that the character counts allow to be nearest."""
    lists, need = [], 3 * (1 - max_dist) - 1
    best, at = np.full(len(large), -1.0), np.zeros(len(large), np.int64)
    for i, length, shared, k in _shared(small, large):
        alike = shared * (1 / length + 1 / k)
        if of_small:
            js = np.flatnonzero(alike >= max(alike.max() - 1e-9, need - 1e-6, 1e-6))[:_PROMISING]
            lists.append((np.full(len(js), i), js))
        else:
            nearer = alike > best
            best[nearer], at[nearer] = alike[nearer], i
    if not of_small:
        js = np.flatnonzero(best >= max(need - 1e-6, 1e-6))
        lists.append((at[js], js))
    i, j = (np.concatenate(c) for c in zip(*lists))
    for lo in range(0, len(i), _AT_ONCE):
        yield i[lo : lo + _AT_ONCE], j[lo : lo + _AT_ONCE]


def _cells(lt: DataFrame, x: str, rt: DataFrame, y: str, n_left: int, n_right: int, max_dist: float, name: str, least: bool) -> DataFrame:
    """All pairs of non-empty texts within ``max_dist``, from cells of blocks; with ``least`` only such pairs of a left text
    as no other pair compared at the same time is nearer."""
    far = F.lit(float(max_dist))
    lt = lt.withColumn("__far", far)
    if least:
        nearest = _compared(lt, x, rt, y, n_left, n_right, max_dist, name, "first").groupBy(x).agg(F.min(name).alias("__near"))
        lt = lt.join(nearest, x, "left").select(x, F.coalesce("__near", far).alias("__far"))
    return _compared(lt, x, rt, y, n_left, n_right, max_dist, name, "least" if least else "all")


def _compared(lt: DataFrame, x: str, rt: DataFrame, y: str, n_left: int, n_right: int, max_dist: float, name: str, way: str) -> DataFrame:
    """Pairs from cells of blocks. A left text has its own radius in ``__far``. ``way``: "all" pairs within it, the "least" of those
    that are compared at the same time, or "first" only the nearest of the most promising ones."""
    few_left = n_left <= n_right
    few, many = math.ceil(min(n_left, n_right) / _SMALL_BLOCK), math.ceil(max(n_left, n_right) / _LARGE_BLOCK)

    def side(texts, c, of_few, far):
        own, blocks, others = ("i", few, many) if of_few else ("j", many, few)
        block = F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias(own)
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("j" if of_few else "i")
        text = F.col(c)
        none = F.lit(None).cast("string")
        both = (text if of_few else none).alias("a"), (none if of_few else text).alias("b")
        return texts.where(text != "").select(block, other, *both, far.alias("far")).select("i", "j", "a", "b", "far")

    rows = side(lt, x, few_left, F.col("__far")).unionByName(side(rt, y, not few_left, F.lit(None).cast("double")))
    # a number of tasks by the number of cells: by bytes, all pairs of a few thousand short texts would be one task
    # the radii stand in the order of the left texts
    lists = [F.collect_list(c).alias(c) for c in ("a", "b", "far")]
    cells = rows.repartition(min(few * many, _MOST_TASKS), "i", "j").groupBy("i", "j").agg(*lists)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in range(batch.num_rows):
                small, large = (batch.column(c)[cell].as_py() for c in ("a", "b"))
                if not small or not large:
                    continue
                a, b, far = np.array(small, object), np.array(large, object), np.array(batch.column("far")[cell].as_py())
                pairs = _promising(small, large, max_dist, few_left) if way == "first" else _meet(small, large, far[:, None] if few_left else far[None, :])
                for i, j in pairs:
                    found = pd.DataFrame({"l": i if few_left else j, x: a[i] if few_left else b[j], y: b[j] if few_left else a[i]})
                    found[name] = jaro_distances(found[x], found[y])
                    found = found[found[name] <= max_dist]
                    if way != "all":
                        found = found[found[name] == found.groupby("l")[name].transform("min")]
                    if way == "first":
                        found = found.drop_duplicates("l")
                    if way == "least":
                        found = found[found[name].to_numpy() <= far[found["l"].to_numpy()] + 1e-9]
                    if len(found):
                        cols = [pa.array(found[x], pa.string()), pa.array(found[y], pa.string()), pa.array(found[name], pa.float64())]
                        yield pa.RecordBatch.from_arrays(cols, [x, y, name])

    return cells.select("a", "b", "far").mapInArrow(compare, f"`{x}` string, `{y}` string, `{name}` double")


def similar_texts(left: DataFrame, x: str, right: DataFrame, y: str, max_dist: float, name: str, least: bool = False) -> DataFrame:
    """All pairs of distinct non-NULL texts with Jaro distance at most ``max_dist``; two empty texts are at distance 0.

    With ``least`` pairs may be left out whose left text has a nearer partner; all its nearest ones are there.

    Counts of characters and the range of lengths per class, both small whatever the texts, are gathered when the plan is
    built; hand over written tables if the texts are costly.
    """
    if not 0 <= max_dist < 1 / 3:
        raise ValueError("max_dist must be at least 0 and below 1/3")
    s = 1 - max_dist
    lt, rt = (t.select(c).filter(F.col(c).isNotNull()).distinct() for t, c in ((left, x), (right, y)))
    both = lt.select(F.col(x).alias("t"), F.lit(0).alias("side")).unionByName(rt.select(F.col(y).alias("t"), F.lit(1).alias("side")))
    both = both.where("t <> ''").select("side", _class(F.length("t")).alias("cls"), F.length("t").alias("n"), _numbered(F.col("t")).alias("chars"))
    # one pass: a row per bucket of characters, and per side and class of lengths
    cells = F.concat(
        F.transform("chars", lambda c: F.struct(F.lit(-1).alias("side"), _bucket(c).alias("k"), F.lit(0).alias("n"))),
        F.array(F.struct("side", F.col("cls").alias("k"), "n")),
    )
    told = both.select(F.explode(cells).alias("c")).groupBy("c.side", "c.k").agg(F.count("*").alias("f"), F.min("c.n").alias("lo"), F.max("c.n").alias("hi"))
    counts, spans, texts = [0] * _BUCKETS, ({}, {}), ({}, {})
    for r in told.collect():  # at most _BUCKETS rows, and a few per doubling of the longest text
        if r["side"] < 0:
            counts[r["k"]] = r["f"]
        else:
            spans[r["side"]][r["k"]] = (r["lo"], r["hi"])
            texts[r["side"]][r["k"]] = r["f"]
    # two empty texts are equal
    empty = lt.filter(F.col(x) == "").join(rt.filter(F.col(y) == ""), F.col(x) == F.col(y), "inner").withColumn(name, F.lit(0.0))
    n_left, n_right = (sum(sizes.values()) for sizes in texts)
    if 0 < min(n_left, n_right) <= _FEW:
        return _cells(lt, x, rt, y, n_left, n_right, max_dist, name, least).unionByName(empty)
    often = F.from_json(F.lit(json.dumps(counts)), "array<bigint>")
    order = F.array_sort(F.transform("__chars", lambda c: F.struct(F.get(often, _bucket(c)).alias("f"), c.alias("c"))))

    def side(texts, c, mine, theirs, is_left):
        texts = texts.where(F.col(c) != "").select(c, _class(F.length(c)).alias("__class"), _numbered(F.col(c)).alias("__chars"))
        texts = texts.withColumn("__chars", F.transform(order, lambda v: v["c"]))
        return _keys(texts, c, _plan(mine, theirs, s), s, is_left)

    a, b = side(lt, x, *spans, True), side(rt, y, *spans[::-1], False)
    pairs = a.join(b, "__key").select(x, y).distinct()
    near = pairs.withColumn(name, jaro_within(F.col(x), F.col(y), max_dist)).filter(F.col(name) <= max_dist)
    return near.unionByName(empty)


def fuzzy_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    max_dist: float,
    how: str = "inner",
    name: str = "distance",
    least: bool = False,
) -> DataFrame:
    """Join rows whose texts are within ``max_dist`` in every pair of ``on``.

    With ``least``, for one pair of texts, matches may be left out where a left row has nearer ones; its nearest stay.

    Name the most selective pair first: it supplies the candidates. ``name`` is the mean of the
    per-pair distances, which are kept as ``<name>_1``, ``<name>_2`` and so on.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if least and len(on) > 1:
        raise ValueError("least is for one pair of texts")
    xs, ys = [x for x, _ in on], [y for _, y in on]
    # the distinct keys are read several times below and are far fewer than the rows behind them
    lk, rk = cut_lineage(left.select(*xs).distinct()), cut_lineage(right.select(*ys).distinct())
    found = _found(lk, rk, on, max_dist, name, least)
    matched = join_null_safe(found, right, ys, "inner")
    out = join_null_safe(left, matched, xs, how)
    return out.select(*left.columns, *right.columns, *_distances(on, name), name)


def _distances(on: Sequence[tuple[str, str]], name: str) -> list[str]:
    return [f"{name}_{i}" for i in range(1, len(on) + 1)]


def _mean(df: DataFrame, dists: Sequence[str], name: str) -> DataFrame:
    total = F.col(dists[0])
    for d in dists[1:]:
        total = total + F.col(d)
    return df.withColumn(name, total / len(dists))


def _found(lk: DataFrame, rk: DataFrame, on: Sequence[tuple[str, str]], max_dist: float, name: str, least: bool = False) -> DataFrame:
    """Pairs of keys within the distance: candidates by the first pair of columns, the others tested on them."""
    (x, y), dists = on[0], _distances(on, name)
    found = lk.join(similar_texts(lk, x, rk, y, max_dist, dists[0], least), x, "inner").join(rk, y, "inner")
    for (x, y), d in zip(on[1:], dists[1:]):
        # few texts come up in many pairs: each two are compared once
        near = found.select(x, y).distinct().withColumn(d, jaro_within(F.col(x), F.col(y), max_dist))
        found = found.join(near.filter(F.col(d) <= max_dist), [x, y], "inner")
    return _mean(found, dists, name)


def nearest_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], max_dist: float, tie: str, name: str = "distance"
) -> DataFrame:
    """Each left row with its nearest right row within ``max_dist`` in every pair of ``on``, by mean distance, then by the
    smallest ``tie``; unmatched rows have NULLs.

    The radius widens from 0: rows whose texts are equal to some right row's are matched by equality, and only the rest are
    searched around. Right columns but ``tie`` are dropped.
    """
    xs, ys = [x for x, _ in on], [y for _, y in on]
    lk = cut_lineage(left.select(*xs).distinct())
    rk = cut_lineage(right.groupBy(*ys).agg(F.min(tie).alias(tie)))
    whole = [F.col(x) == F.col(y) for x, y in on]
    equal = cut_lineage(lk.join(rk, whole, "inner").select(*xs, tie, F.lit(0.0).alias(name)))
    rest = join_null_safe(lk, equal, xs, "left_anti")
    found = _found(rest, rk.select(*ys), on, max_dist, name).join(rk, ys)
    best = found.groupBy(*xs).agg(F.min_by(F.struct(tie, name), F.struct(F.round(name, 12), tie)).alias("__b"))
    best = best.select(*xs, f"__b.{tie}", f"__b.{name}").unionByName(equal)
    return join_null_safe(left, best, xs, "left").select(*left.columns, tie, name)
