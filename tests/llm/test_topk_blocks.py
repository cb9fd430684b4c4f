"""Top-k where nothing can be pruned: queries travel per block and not per cell, and leave a task in batches of bounded size."""

from __future__ import annotations

import numpy as np

from tenderlens.llm import topk


def test_queries_travel_once_per_block(spark):
    rng = np.random.default_rng(3)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(3000, 32)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked, placed = topk.deal(df, 10, "vec_id", "embedding", 1024, 100, 50)
    # every query needs nearly all of the 50 cells
    assert placed.count() == 3000 and asked.count() <= 30 * 8
    pairs = asked.groupBy("cell", "block", "part").count()
    assert pairs.agg({"count": "max"}).first()[0] == 30


def test_cells_that_few_queries_need_stay_alone():
    sizes, needed = {0: 10, 1: 20, 2: 30, 3: 5, 4: 50}, {0: 9, 1: 8, 2: 2, 4: 10}
    assert topk._groups(sizes, needed, 10, 40) == [[0, 1], [4], [2]]
    assert topk._groups(sizes, {}, 10, 40) == []


def test_tiles_find_what_all_at_once_find(monkeypatch):
    monkeypatch.setattr(topk, "TILE", 100)
    rng = np.random.default_rng(5)
    for scale in (3, 2000, 2**22, 2**28):  # many ties, sums of 24, of 53 and of more bits
        data, ids = rng.integers(-scale, scale, (1500, 4)), rng.integers(0, 700, 1500)
        own = rng.integers(0, 800, 9)
        queries = rng.integers(-scale, scale, (9, 4))
        want = []
        for q, v in zip(own, queries):
            best = sorted((-int(np.dot(v, x)), int(i)) for x, i in zip(data, ids) if i != q)[:10]
            want.append([(int(q), i, -s) for s, i in best])
        assert list(topk._best(own, queries, ids, data, 10)) == [x for w in want for x in w]
    assert list(topk._best(np.array([1]), queries[:1], np.array([1]), data[:1], 10)) == []
