"""Exact top-k by inner product: a Voronoi kNN join.

Pivots, about as many as the root of the data, split the data into cells; a summary of each holds its radius and its
longest vector. A query's k-th score among a bounded sample of the data is a true lower bound. No vector x of a cell with
pivot p and radius r scores above <q, p> + |q| r, nor above |q| times the cell's longest vector, so a query goes only to
the cells whose bound reaches its own. Cells that at least half of the queries need stand together in blocks, so that where
nothing can be pruned a query travels once per block and not once per cell. Data vectors travel once, to a block of their
cell, whatever is pruned (again only if more queries need the cell than a task can hold). There the search is solved locally,
and the blocks' best are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import step

#: Least rows of a block of data and blocks that all data make at least, as far as that allows; queries and vectors that are
#: compared at once; rows of the sample.
DATA_BLOCK, BLOCKS, QUERY_BLOCK, TILE, SAMPLE = 1024, 64, 256, 8192, 2048
#: Numbers in the vectors of a block of data, of the queries that a task holds beside it, and of a batch that leaves a task.
DATA_VALUES, QUERY_VALUES, BATCH_VALUES = 1 << 22, 1 << 23, 1 << 21


def _rows(column, width: int) -> np.ndarray:
    """Vectors of a list column, shorter ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if len(ends) and (ends == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(ends), width), np.int64)
    out[np.arange(width)[None, :] < ends[:, None]] = flat
    return out


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _best(query_ids, queries, ids, data, k: int):
    """Per query its k best (query, id, score): exact integers, ties to the smaller id, never the query's own row.

    The data come in tiles, a short one first: what is below a query's k-th score so far is left out of the later ones.
    """
    largest = float(np.sqrt((queries.astype(float) ** 2).sum(1).max() * (data.astype(float) ** 2).sum(1).max()))
    kind = np.float32 if largest < 2**23 else float if largest < 2**52 else np.int64  # sums of any of the products are exact
    q = queries.astype(kind)
    least = None
    at, found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = [0, *range(min(max(16 * k, 512), len(ids)), len(ids), TILE), len(ids)]
    for lo, hi in zip(ends, ends[1:]):
        s, own = q @ data[lo:hi].T.astype(kind), ids[lo:hi]
        other = query_ids[:, None] != own[None, :] if np.isin(own, query_ids).any() else True
        row, col = np.nonzero(other & (s >= least[:, None]) if least is not None else np.broadcast_to(other, s.shape))
        at, found, scores = np.append(at, row), np.append(found, own[col]), np.append(scores, s[row, col].astype(np.int64))
        order = np.lexsort((found, -scores, at))
        at, found, scores = at[order], found[order], scores[order]
        starts = np.searchsorted(at, np.arange(len(q)))
        keep = np.arange(len(at)) - starts[at] < k
        at, found, scores = at[keep], found[keep], scores[keep]
        n = np.bincount(at, minlength=len(q))
        if (n == k).all():
            least = scores[k - 1 :: k].astype(kind)
    yield from zip(query_ids[at].tolist(), found.tolist(), scores.tolist())


def bounds(q: np.ndarray, pivots: np.ndarray, radius: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """Per query and cell, a score that no vector of the cell exceeds. Cells without vectors have a negative radius."""
    norm = np.sqrt((q**2).sum(1))[:, None]
    upper = np.minimum(q @ pivots.T + norm * radius, norm * longest)
    return np.where(radius >= 0, upper + np.abs(upper) * 1e-9 + 1, -np.inf)


def _least(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Per query its k-th best score among the sample's rows of other ids; minus infinity if there are fewer."""
    if len(ids) < k:
        return np.full(len(q), -np.inf)
    scores = np.where(q_ids[:, None] == ids[None, :], -np.inf, q @ sample.T)
    least = np.partition(scores, len(ids) - k, 1)[:, len(ids) - k]
    return least - np.abs(least) * 1e-9 - 1


def top_k(
    table: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024, every: int = 100, pivots: int | None = None
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for each row whose id is divisible by ``every``.

    Components become ``floor(scale * x)``; the score is the integer inner product; candidates are all rows but the
    query's own id. Rows with a NULL id, a NULL vector or a component that is NULL or not finite take no part. Shorter
    vectors count as filled up with zeros. Repeated rows are candidates each; a query id with several vectors gets
    the best of all their pairs. An empty table gives no rows.
    """
    asked, cells = deal(table, k, id_col, vec_col, scale, every, pivots)
    if asked is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    local = asked.unionByName(cells).groupBy("cell", "block", "part").applyInArrow(_solver(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def deal(table: DataFrame, k: int, id_col: str, vec_col: str, scale: int, every: int, pivots: int | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Queries and data by (cell, block of the cell's data, part of the cell's queries); None without data."""
    x = F.col(vec_col).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    floor = F.transform(x, lambda v: F.floor(v * scale))
    base = table.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & whole)
    base = base.select(F.col(id_col).cast("long").alias("id"), floor.alias("v"))
    queries = step(base.where(F.col("id") % every == 0).distinct(), "queries")
    # Of equal vectors only the k + 1 smallest ids, with at most k rows of each, can be among any query's k best, as one of
    # the ids may be the query's. Rows are counted and ids limited in each task before a shuffle, so a vector held by a
    # third of the rows is a few rows per task.
    same = Window.partitionBy("v").orderBy("id")
    held = base.groupBy("v", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("_rows"))
    held = held.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    data = step(held.select(F.explode(F.array_repeat("id", F.col("_rows"))).alias("id"), "v"), "vectors")
    shape = data.agg(F.max(F.size("v")).alias("w"), F.count("*").alias("n")).first()
    if not shape["n"] or not shape["w"]:
        return None, None
    width, n = int(shape["w"]), int(shape["n"])
    pivots = pivots or max(16, math.isqrt(n) // 2)
    rows = data.orderBy(F.xxhash64("id"), "id").limit(max(SAMPLE, pivots)).collect()  # SAMPLE rows, or half the root of all
    sample_ids, sample = np.array([r["id"] for r in rows], np.int64), np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        sample[i, : len(r["v"])] = r["v"]
    centre = np.unique(sample[:pivots], axis=0)

    def assign(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                v = _rows(part.column("v"), width).astype(float)
                d = _distances(v, centre)
                cell = d.argmin(1)
                cols = [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell]), pa.array(np.sqrt((v**2).sum(1)))]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), *cols], ["id", "v", "cell", "distance", "norm"])

    placed = step(data.mapInArrow(assign, "id long, v array<long>, cell int, distance double, norm double"), "cells")
    radius, longest, sizes = np.full(len(centre), -1.0), np.zeros(len(centre)), {}
    told = placed.groupBy("cell").agg(F.max("distance").alias("r"), F.max("norm").alias("m"), F.count("*").alias("n"))
    for r in told.collect():  # a row per cell
        # rounding of the squared distances is far below a unit
        radius[r["cell"]], longest[r["cell"]], sizes[r["cell"]] = r["r"] * (1 + 1e-9) + 1, r["m"] * (1 + 1e-9), r["n"]

    def needs(part):
        """For queries and cells, whether the one needs the other."""
        ids, v = part.column("id").to_numpy(), _rows(part.column("v"), width).astype(float)
        return bounds(v, centre, radius, longest) >= _least(ids, v, sample_ids, sample, k)[:, None]

    def slices(batches):
        for b in batches:
            yield from (b.slice(lo, QUERY_BLOCK) for lo in range(0, b.num_rows, QUERY_BLOCK))

    def tell(batches):
        count = sum((needs(part).sum(0) for part in slices(batches)), np.zeros(len(centre), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centre)), pa.int32()), pa.array(count)], ["cell", "n"])

    counted = queries.mapInArrow(tell, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    needed = {r["cell"]: r["n"] for r in counted.collect() if r["n"]}  # a row per cell
    n_queries = queries.count()
    least_rows = max(DATA_BLOCK, min(n // BLOCKS, DATA_VALUES // width))
    groups = _groups(sizes, needed, n_queries, least_rows)
    order = np.array([c for cells in groups for c in cells], np.int64)
    starts = np.cumsum([0, *map(len, groups)])[:-1]

    def ask(batches):
        most_rows = max(1, BATCH_VALUES // width)
        for part in slices(batches):
            row, group = np.nonzero(np.logical_or.reduceat(needs(part)[:, order], starts, axis=1)) if len(order) else (starts, starts)
            for lo in range(0, len(row), most_rows):
                take, cell = pa.array(row[lo : lo + most_rows]), pa.array(group[lo : lo + most_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("id").take(take), part.column("v").take(take), cell], ["id", "v", "cell"])

    asked = queries.mapInArrow(ask, "id long, v array<long>, cell int")
    most = max(1, QUERY_VALUES // width)
    shapes = []
    for g, cells in enumerate(groups):
        asks = needed[cells[0]] if len(cells) == 1 else n_queries
        shapes += [(c, g, -(-sum(sizes[c] for c in cells) // least_rows) if len(cells) == 1 else 1, -(-asks // most)) for c in cells]
    shapes = table.sparkSession.createDataFrame(shapes, "cell int, together int, blocks int, parts int")
    block, part = (F.pmod(F.xxhash64("id"), F.col(c)).cast("int") for c in ("blocks", "parts"))
    every_block, every_part = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("blocks", "parts"))
    together = shapes.select(F.col("together").alias("cell"), "blocks", "parts").distinct()
    asked = asked.join(F.broadcast(together), "cell").select("id", "v", F.lit(True).alias("query"), "cell", every_block.alias("block"), part.alias("part"))
    placed = placed.join(F.broadcast(shapes), "cell").select("id", "v", F.lit(False).alias("query"), F.col("together").alias("cell"), block.alias("block"), every_part.alias("part"))
    return asked, placed


def _groups(sizes: dict[int, int], needed: dict[int, int], n_queries: int, rows: int) -> list[list[int]]:
    """Cells that are dealt together: those that at least half of the queries need, up to ``rows`` rows; the others stay alone.
    A cell that no query needs is in none."""
    out, held = [], rows + 1
    often = [c for c in sorted(needed) if c in sizes and 2 * needed[c] >= n_queries]
    for c in often:
        if held + sizes[c] > rows:
            out.append([])
            held = 0
        out[-1].append(c)
        held += sizes[c]
    return out + [[c] for c in sorted(needed) if c in sizes and 2 * needed[c] < n_queries]


def _solver(k: int):
    def solve(group: pa.Table) -> pa.Table:
        query = group.column("query").to_numpy().astype(bool)
        width = int(np.diff(group.column("v").combine_chunks().offsets.to_numpy()).max(initial=0))
        ids, v = group.column("id").to_numpy(), _rows(group.column("v"), width)
        asked, held = np.flatnonzero(query), np.flatnonzero(~query)
        out = []
        if len(held):
            for at in range(0, len(asked), QUERY_BLOCK):
                part = asked[at : at + QUERY_BLOCK]
                out += _best(ids[part], v[part], ids[held], v[held], k)
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return solve
