"""MinHash near-dedup with sequential Bayesian verification.

1. Each text gives its set of word shingles (64-bit hashes), a key of the whole set, and the hashes of its signature's
   bands. Equal sets are one representative from here on.
2. Representatives that share a band belong to one family (connected components over each band's smallest member).
   Families are dealt to tasks with their texts: small ones many to a task, large ones in blocks and pairs of blocks.
3. In a task, pairs that share a band are candidates. Their signatures are compared a batch at a time: with ``m`` of
   ``n`` values equal, the similarity has a Beta posterior, and a pair is dropped once P(similarity >= threshold) is
   below the chosen miss probability. Survivors are verified on their full sets; pairs already connected are skipped.
4. Only the links of a spanning forest leave a task, so groups of copies never become pairs.
"""

from __future__ import annotations

import math
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import step
from .components import components

HASHES = 180
BATCH = 36
MISS = 1e-8
#: Bounds of what a task holds at once.
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20

_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(_ODD)) | np.uint64(1)


class Shingler:
    """Sets of shingle hashes, sorted. Word hashes are kept while there are fewer than ``keep`` of them."""

    def __init__(self, size: int = 5, keep: int = 1 << 16):
        self.size, self.keep, self.words = size, keep, {}
        self.powers = np.array([pow(_ODD, i, 1 << 64) for i in range(size + 1)], np.uint64)

    def _word(self, w: bytes) -> int:
        h = self.words.get(w)
        if h is None:
            if len(self.words) >= self.keep:
                self.words.clear()
            h = self.words[w] = int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
        return h

    def set_of(self, text: str | None) -> np.ndarray:
        # bytes: lower() touches A-Z only and split() knows just the six ASCII blanks
        words = (text or "").encode("utf-8").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self._word, words), np.uint64, len(words))
        k, n = min(self.size, len(h)), max(1, len(h) - self.size + 1)
        out = np.full(n, len(h) if len(h) < self.size else self.size, np.uint64)
        for i in range(k):
            out = out + h[i : i + n] * self.powers[i]
        return np.unique(_mix(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of ``HASHES`` multiplicative hashes, upper 32 bits; in slices, so memory stays small."""
    out = np.full(len(_SEEDS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 512):
        x = shingles[at : at + 512]
        low = (_SEEDS[:, None] * x[None, :] >> np.uint64(32)).min(1).astype(np.uint32)
        np.minimum(out, low, out=out)
    return out


def band_rows(percent: int) -> int:
    """Rows of a band: as many as leave a pair at the threshold without a common band with probability 1e-6 at most."""
    t, fit = percent / 100, [r for r in range(1, 13) if HASHES % r == 0]
    return max([1, *(r for r in fit if (1 - t**r) ** (HASHES // r) <= 1e-6)])


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash per band, different for equal values in different bands."""
    b = sig.reshape(-1, HASHES // rows, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, HASHES // rows + 1, dtype=np.uint64) * np.uint64(_ODD), b.shape[:2]).copy()
    for r in range(rows):
        h = _mix(h ^ b[:, :, r]) + np.uint64(_ODD)
    return h


@lru_cache(8)
def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest equal values of ``n`` that keep a pair. With a uniform prior the posterior is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m)."""
    p = 0.0
    for m in range(n + 1):
        p += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if p >= miss:
            return m
    return n


class Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        up = self.up
        while True:
            again = up[up]
            if np.array_equal(again, up):
                return up
            self.up = up = again


def links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, miss: float) -> list[tuple[int, int]]:
    """Spanning forest of the links between members of ``left`` and of ``right`` (indexes into ``sets``).

    A member that has just been linked goes first, so a text in the middle of its copies is reached early.
    """
    sigs = np.stack([signature(s) for s in sets])
    marks = bands(sigs, band_rows(percent))
    sizes = np.array([len(s) for s in sets])
    forest, out = Forest(len(sets)), []
    threshold = percent / 100
    in_left, in_right = np.zeros(len(sets), bool), np.zeros(len(sets), bool)
    in_left[left], in_right[right] = True, True
    waiting, queue = dict.fromkeys([*left.tolist(), *right.tolist()]), []
    order = iter(list(waiting))
    done = np.zeros(len(sets), bool)
    while True:
        i = queue.pop() if queue else next(order, None)
        if i is None:
            break
        if done[i]:
            continue
        done[i] = True
        roots = forest.roots()
        # a pair is judged when the first of its two members is taken
        open_ = ~done & (roots != roots[i])
        open_ &= (in_right if in_left[i] else False) | (in_left if in_right[i] else False)
        small, big = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
        open_ &= 100 * small >= percent * big
        js = np.flatnonzero(open_)
        if len(js):
            js = js[(marks[js] == marks[i]).any(1)]
        equal = np.zeros(len(js), np.int64)
        for at in range(0, sigs.shape[1], BATCH):
            if not len(js):
                break
            equal += (sigs[js, at : at + BATCH] == sigs[i, at : at + BATCH]).sum(1)
            n = min(at + BATCH, sigs.shape[1])
            keep = equal >= least_matches(n, threshold, miss)
            js, equal = js[keep], equal[keep]
        if not len(js):
            continue
        flat = np.concatenate([sets[j] for j in js])
        starts = np.concatenate([[0], np.cumsum(sizes[js])[:-1]])
        at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
        common = np.add.reduceat((sets[i][at] == flat).astype(np.int64), starts)
        for j in js[100 * common >= percent * (sizes[i] + sizes[js] - common)].tolist():
            if forest.root(i) != forest.root(j):
                forest.join(i, j)
                out.append((i, j))
            queue.append(j)
    return out


def _sketch(size: int, rows_: int):
    def run(batches):
        shingler = Shingler(size)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                sets = [shingler.set_of(t.as_py()) for t in part.column(1)]
                keys = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                marks = bands(np.stack([signature(s) for s in sets]), rows_).view(np.int64)
                rows = [m if len(s) else None for m, s in zip(marks, sets)]
                cols = [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, ["row_id", "tag", "n_shingles", "set_key", "bands"])
            pa.default_memory_pool().release_unused()  # the worker lives on: give freed batches back

    return run


def _verify(size: int, percent: int, miss: float):
    def run(group: pa.Table) -> pa.Table:
        """Rows of one bin: whole small families, or one pair of blocks of a large one."""
        shingler = Shingler(size)
        family = np.array(group.column("family").to_pylist(), np.int64)
        ids = np.array(group.column("rep").to_pylist(), np.int64)
        block = np.array(group.column("block").to_pylist(), np.int64)
        first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
        texts = group.column("text")
        out = []
        order = np.argsort(family, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(family[order])) + 1):
            if len(at) < 2:
                continue
            sets = [shingler.set_of(texts[int(k)].as_py()) for k in at]
            every = np.arange(len(at))
            left, right = (every, every) if first == second else (every[block[at] == first], every[block[at] == second])
            out += [(int(ids[at[i]]), int(ids[at[j]])) for i, j in links(sets, left, right, percent, miss)]
        return pa.table({"u": pa.array([a for a, _ in out], pa.int64()), "v": pa.array([b for _, b in out], pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    size: int = 5,
    miss: float = MISS,
    with_tag: bool = False,
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``; with ``with_tag`` also ``tag``, the text's xxhash64.

    Words are runs without ASCII blanks, A-Z lower-cased; a text's set holds its distinct ``size``-word shingles, or
    the whole sequence if it has fewer words. Two texts are linked if ``100 * common >= percent * union``;
    ``component_id`` is the smallest id reachable over links, ``kept`` where it is the row's own. NULL, empty and blank
    texts have an empty set and no links. Rows with a NULL id have a NULL component and stay. Rows that repeat an
    id with another text are judged by that text, their component by its set. Shingles are 64-bit hashes and sets 128-bit keys of them. A link is missed with
    probability below 1e-6 by the bands and ``miss`` per batch; found links are exact on the full sets.
    """
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).cast("long").alias("row_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    schema = "row_id long, tag long, n_shingles long, set_key binary, bands array<long>"
    sketches = step(base.mapInArrow(_sketch(size, band_rows(percent)), schema), "sketches")
    known = sketches.where("row_id is not null and set_key is not null")
    # Equal sets meet at the smallest id that has them, with a tag of that row's text.
    first = known.groupBy("set_key").agg(F.min(F.struct("row_id", "tag")).alias("r"), F.max("n_shingles").alias("n"))
    reps = step(first.select("set_key", F.col("r.row_id").alias("rep"), F.col("r.tag").alias("tag"), "n"), "sets")
    ours = known.select(F.col("row_id").alias("rep"), "tag", "set_key", "bands")
    marks = ours.join(reps.select("rep", "tag", "set_key"), ["rep", "tag", "set_key"])
    marks = marks.select("rep", "set_key", F.explode("bands").alias("band"))
    heads = marks.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1")
    near = marks.join(heads, "band").where("rep <> head").select(F.col("rep").alias("u"), F.col("head").alias("v")).distinct()
    families = step(components(near).select(F.col("id").alias("rep"), F.col("component").alias("family")), "families")

    members = families.join(reps, "rep").select("rep", "tag", "family", "set_key", "n")
    sums = members.groupBy("family").agg(F.count("*").alias("rows"), F.sum(F.lit(8) * F.col("n")).alias("bytes"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    sums = sums.select("family", blocks.alias("blocks"), "bytes")
    total = sums.where("blocks = 1").agg(F.sum("bytes")).first()[0] or 0
    bins = max(1, math.ceil(int(total) / BLOCK_BYTES))
    placed = members.join(sums, "family")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("first"), F.greatest("block", other).alias("second")),
    )
    placed = placed.select("rep", "tag", "family", "set_key", "block", "blocks", F.explode(pairs).alias("pair"))
    bin_ = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(F.col("family"))
    placed = placed.select("rep", "tag", "family", "block", (F.col("blocks") > 1).alias("large"), bin_.alias("bin"), "pair.first", "pair.second")
    # Whole texts come to their family; texts without one end at this join.
    with_text = placed.join(base.withColumnRenamed("row_id", "rep"), ["rep", "tag"])
    found = with_text.groupBy("large", "bin", "first", "second").applyInArrow(_verify(size, percent, miss), "u long, v long")

    joined = components(found)
    labels = reps.select("set_key", "rep").join(joined, F.col("rep") == F.col("id"), "left")
    labels = labels.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    out = sketches.join(labels, "set_key", "left")
    component = F.coalesce("component_id", "row_id")
    kept = component.eqNullSafe(F.col("row_id")).alias("kept")
    return out.select(F.col("row_id").alias(id_col), "n_shingles", component.alias("component_id"), kept, *["tag"] * with_tag)
