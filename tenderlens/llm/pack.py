"""Packing by cutting-stock column generation.

Lengths go into a histogram of at most ``capacity / unit`` classes, whatever the size of the corpus. On it a linear
program over patterns (how many pieces of each class share a sequence) is solved by column generation, columns priced
by a knapsack. The solution is rounded down, what is left is filled largest first, and each pattern then takes the next
documents in rank of each class. Only the histogram and the patterns, both bounded by the classes, are on the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import step
from .tokens import default_path, encoder


def price(duals: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: unbounded knapsack by dynamic programming over the room."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    use = np.flatnonzero(duals > 1e-12)
    use = use[np.argsort(sizes[use])]
    s, v = sizes[use], duals[use]
    for u in range(1, room + 1):
        best[u], took[u] = best[u - 1], -1
        k = np.searchsorted(s, u, "right")
        if k:
            gain = best[u - s[:k]] + v[:k]
            j = int(gain.argmax())
            if gain[j] > best[u]:
                best[u], took[u] = gain[j], use[j]
    pattern, u = np.zeros(len(sizes), np.int64), room
    while u > 0:
        if took[u] < 0:
            u -= 1
        else:
            pattern[took[u]] += 1
            u -= sizes[took[u]]
    return float(best[room]), pattern


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix by vector without BLAS, whose threads may be lost once the JVM has been started."""
    return (a * b).sum(1)


def _inverse(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots by elementwise numpy, for the reason above; not finite if ``a`` is singular."""
    m = len(a)
    both = np.hstack([a.astype(float), np.eye(m)])
    with np.errstate(all="ignore"):
        for c in range(m):
            r = c + int(np.abs(both[c:, c]).argmax())
            both[[c, r]] = both[[r, c]]
            both[c] /= both[c, c]
            factor = both[:, c].copy()
            factor[c] = 0
            both -= factor[:, None] * both[c]
    return both[:, m:]


def solve(counts: dict[int, int], room: int, gap: float = 1e-3) -> list[tuple[int, dict[int, int]]]:
    """Patterns (times, {size: pieces}) that use up ``counts`` (size -> pieces) exactly; sizes and room in units.

    The linear program ends within ``gap`` of its optimum, or early after 50 columns per size: that, too, leaves a whole
    solution, with more padding.
    """
    sizes = np.array(sorted(counts), np.int64)
    need = np.array([counts[s] for s in sizes.tolist()], float)
    m = len(sizes)
    if not m:
        return []
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    # Slightly uneven demand while pivoting: without ties no pivot is in vain.
    shaken = need * (1 + 1e-3 * np.modf(np.arange(1, m + 1) * 0.6180339887498949)[0])
    x = _times(inverse, shaken)
    turn = 0
    while True:
        value, pattern = price(inverse.sum(0), sizes, room)
        # x.sum() / value bounds the optimum from below: stop within half a sequence or a thousandth of it.
        if value <= 1 + max(0.5 / max(x.sum(), 1), gap) or turn == 50 * m:
            break
        step_ = _times(inverse, pattern)
        if step_.max() <= 1e-10:
            break
        turn += 1
        ratio = np.where(step_ > 1e-10, x / np.where(step_ > 1e-10, step_, 1), np.inf)
        r = int(ratio.argmin())
        basis[:, r] = pattern
        if turn % 50:
            row = inverse[r] / step_[r]
            inverse -= step_[:, None] * row
            inverse[r] = row
        else:
            inverse = _inverse(basis)
            off = max(np.abs(_times(basis, inverse[:, c]) - (np.arange(m) == c)).max() for c in range(m))
            if not off <= 1e-6:  # too close to singular to go on: what is found is repaired below
                inverse = np.nan_to_num(inverse, nan=0.0, posinf=0.0, neginf=0.0)
                break
        x = np.maximum(_times(inverse, shaken), 0)
    times = np.floor(np.clip(_times(inverse, need), 0, need.max()) + 1e-6).astype(np.int64)
    whole = basis.astype(np.int64)
    over = np.maximum((whole * times).sum(1) - need.astype(np.int64), 0)
    # Rounding took too much of some classes: each pattern with such a class gives back what alone makes up for it.
    back = np.where((whole > 0) & (over > 0)[:, None], -(-over[:, None] // np.maximum(whole, 1)), 0).max(0)
    times = np.maximum(times - back, 0)
    left = need.astype(np.int64) - (whole * times).sum(1)
    out = [(int(t), {int(s): int(a) for s, a in zip(sizes, basis[:, r]) if a}) for r, t in enumerate(times) if t]
    rest = Counter({int(s): int(n) for s, n in zip(sizes, left) if n})
    while rest:  # largest first; each turn uses up a size or most of it, so turns are bounded by the sizes
        pattern, free = {}, room
        for s in sorted(rest, reverse=True):
            if s <= free:
                pattern[s] = min(free // s, rest[s])
                free -= s * pattern[s]
        t = min(rest[s] // a for s, a in pattern.items())
        out.append((t, pattern))
        rest -= Counter({s: a * t for s, a in pattern.items()})
    return out


@dataclass
class Deal:
    """For each class, where its ranks go: pattern k takes ranks from first[k]; its pieces per sequence and place."""

    first: np.ndarray
    per: np.ndarray
    base: np.ndarray
    slot: np.ndarray


def deals(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, Deal]:
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    base = 0
    for times, pattern in patterns:
        slot = 0
        for size in sorted(pattern, reverse=True):
            rows.setdefault(size, []).append((used[size], pattern[size], base, slot))
            used[size] += times * pattern[size]
            slot += pattern[size]
        base += times
    return {s: Deal(*(np.array(c, np.int64) for c in zip(*r))) for s, r in rows.items()}


def pieces(
    docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, path: str, with_ids: bool = False
) -> DataFrame:
    """Each document's ids and ``end_id``, cut into full pieces of ``capacity`` and a rest."""
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids

    def run(batches):
        enc = encoder(path)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                cols: list[list] = [[] for _ in names]
                for row_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = np.append(enc.encode(text.as_py() or ""), end_id).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        own = ids[start : start + capacity]
                        raw = own.tobytes()
                        for c, v in zip(cols, (row_id, start, len(own), zlib.crc32(raw), len(ids), raw)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    base = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = ", ".join(f"`{n}` {'binary' if n == 'ids' else 'long'}" for n in names)
    return base.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    unit: int = 16,
    end_id: int = 1,
    salts: int = 64,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    NULL text is empty and gives one piece, the end id alone. A document longer than ``capacity`` gives full pieces,
    each a sequence of its own, and a rest. Lengths are rounded up to ``unit`` for planning only. Sequence ids are
    dense from 0. Repeated rows are packed each; an empty table gives no rows. With ``with_ids`` each piece carries its
    ids (little-endian unsigned 32-bit).
    """
    made = pieces(docs, id_col, text_col, capacity, end_id, path or default_path(), with_ids)
    made = made.withColumns(
        {
            "_size": F.ceil(F.col("length") / unit).cast("int"),
            "_salt": F.pmod(F.xxhash64(id_col, "start"), F.lit(salts)).cast("int"),
        }
    )
    made = step(made, "pieces")
    # (capacity / unit) * salts rows at most
    cells = sorted((r["_size"], r["_salt"], r["count"]) for r in made.groupBy("_size", "_salt").count().collect())
    counts: Counter = Counter()
    starts = []
    for size, salt, n in cells:
        starts.append((size, salt, counts[size]))
        counts[size] += n
    plan = deals(solve(dict(counts), capacity // unit))
    first = {(size, salt): at for size, salt, at in starts}

    # Ranks: the rows of a class are spread over salts, so that a length held by a third of them is not one task.
    w = Window.partitionBy("_size", "_salt").orderBy(id_col, "start")
    ranked = made.withColumn("_rank", F.row_number().over(w) - 1)
    kept = made.columns
    names = [*kept, "sequence_id", "_slot"]

    def place(batches):
        for b in batches:
            size, salt = (b.column(c).to_numpy() for c in ("_size", "_salt"))
            rank = b.column("_rank").to_numpy().astype(np.int64)
            rank = rank + np.array([first[k] for k in zip(size.tolist(), salt.tolist())], np.int64)
            seq, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(size):
                at, d = np.flatnonzero(size == s), plan[int(s)]
                k = np.searchsorted(d.first, rank[at], "right") - 1
                inner = rank[at] - d.first[k]
                seq[at], slot[at] = d.base[k] + inner // d.per[k], d.slot[k] + inner % d.per[k]
            cols = [b.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(slot)], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema) + ", sequence_id long, _slot long"
    placed = ranked.mapInArrow(place, schema)
    # A sequence holds at most ``capacity`` pieces, so this window is bounded.
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.drop("_size", "_salt", "_slot")
