"""Ranked lexical search: short posting lists term at a time, long ones document at a time, in one exact search.

1. Documents give the counts of all terms that some query asks for, and the corpus statistics.
2. Term at a time: short lists are joined to the queries and summed to one accumulator per (query, document). The k-th
   best accumulator of a query is a true lower bound of its k-th score.
3. Document at a time: documents are dealt to shards with their long lists and their accumulators. In a shard the
   accumulators are one more list with a bound. Runs of documents whose summed bounds stay below the query's k-th score
   so far are skipped unread; in the others, documents are scored list by list, largest bound first, and given up
   as soon as what is left cannot lift them to the k-th score. The shards' best are merged.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import step

#: Documents of a shard, documents of a run that is skipped as one, and query terms of a block of queries.
SHARD_DOCS, RUN_DOCS, BLOCK_TERMS = 8192, 64, 400_000

#: Bytes of a term (A-Z become small, other ASCII but digits and letters becomes a space; all of UTF-8's others stay).
_TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII digits and letters and all other characters beyond ASCII; only A-Z are lower-cased."""
    return (text or "").encode("utf-8").translate(_TABLE).split(b" ") if text else []


def _query_terms(batches):
    for b in batches:
        found = [sorted({*terms_of(t.as_py())} - {b""}) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([[t.decode("utf-8") for t in f] for f in found], pa.list_(pa.string()))], ["item", "terms"]
        )


def _lists(number: dict[bytes, int]):
    """Per document its number of terms, and the asked terms in it with their counts."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                sizes, ends, numbers, counts = [], [0], [], []
                for text in part.column(1):
                    found = Counter(terms_of(text.as_py()))
                    del found[b""]
                    sizes.append(found.total())
                    for t in found.keys() & number.keys():
                        numbers.append(number[t])
                        counts.append(found[t])
                    ends.append(len(numbers))
                nested = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (numbers, counts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), *nested], ["doc", "n", "number", "tf"])

    return run


def _gain(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All indexes of the ranges, one after another."""
    n = ends - starts
    return np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)


class Shard:
    """Posting lists of some documents, which are numbered by their place and taken in runs.

    Per list and run there are the range of its postings and the largest count, and per run the smallest ``m``: enough
    for a bound that reads no posting.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, place: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.ids, self.m, self.runs = ids, m, -(-len(ids) // RUN_DOCS)
        self.m_least = np.minimum.reduceat(m, np.arange(0, len(m), RUN_DOCS))
        order = np.lexsort((place, term))
        term, self.place, self.tf = term[order], place[order], tf[order].astype(np.int64)
        key = term.astype(np.int64) * self.runs + self.place // RUN_DOCS
        self.start = np.flatnonzero(np.append(True, np.diff(key) != 0)) if len(key) else np.zeros(0, np.int64)
        self.end = np.append(self.start[1:], len(key)) if len(key) else self.start
        self.most = np.maximum.reduceat(self.tf, self.start) if len(key) else self.tf
        self.run = key[self.start] % self.runs
        self.terms, first = np.unique(key[self.start] // self.runs, return_index=True)
        self.first = np.append(first, len(self.start))
        self.read = 0  # postings read by all searches

    def list(self, term: int) -> slice:
        """The ranges of a term's list."""
        k = int(np.searchsorted(self.terms, term))
        return slice(self.first[k], self.first[k + 1]) if k < len(self.terms) and self.terms[k] == term else slice(0, 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: score descending, id ascending."""
    at = np.arange(len(scores))
    if len(at) > k:
        cut = np.partition(scores, len(at) - k)[len(at) - k]
        at = at[scores >= cut]  # with all ties of the last place
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search(
    shard: Shard, terms: np.ndarray, weights: np.ndarray, acc_place: np.ndarray, acc: np.ndarray, floor: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of a shard's ``k`` best documents for one query, as far as they score above 0 and reach ``floor``.

    ``terms`` and ``weights`` are the query's long lists; ``acc`` at ``acc_place`` the sums of its short ones.
    """
    lists = [shard.list(t) for t in terms.tolist()]
    bounds = np.zeros((len(lists) + 1, shard.runs), np.int64)
    np.maximum.at(bounds[-1], acc_place // RUN_DOCS, acc)
    for bound, own, w in zip(bounds, lists, weights):
        bound[shard.run[own]] = _gain(w, shard.most[own], shard.m_least[shard.run[own]])
    total, order = bounds.sum(0), np.argsort(-bounds[:-1].max(1, initial=0), kind="stable")
    place, score, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), max(floor, 1)
    # Runs by falling bound, a few at a time: the k-th score rises early, and the runs below it are never read.
    waiting, at, width = np.argsort(-total, kind="stable"), 0, 8
    while at < shard.runs and total[waiting[at]] >= floor:
        own = waiting[at : at + width]
        own = own[total[own] >= floor]
        at, width = at + width, min(2 * width, 256)
        chosen = np.zeros(shard.runs, bool)
        chosen[own] = True
        sums = np.zeros(shard.runs * RUN_DOCS, np.int64)
        mine = chosen[acc_place // RUN_DOCS]
        sums[acc_place[mine]] = acc[mine]
        left = bounds[:-1].sum(0)  # what the lists not yet read can add to a document of each run
        for i in order:
            ranges = np.arange(lists[i].start, lists[i].stop)
            ranges = ranges[chosen[shard.run[ranges]]]
            if not len(ranges):
                continue
            posting = _ranges(shard.start[ranges], shard.end[ranges])
            shard.read += len(posting)
            doc = shard.place[posting]
            open_ = sums[doc] + left[doc // RUN_DOCS] >= floor
            doc, posting = doc[open_], posting[open_]
            sums[doc] += _gain(weights[i], shard.tf[posting], shard.m[doc])
            left = left - bounds[i]
        found = np.flatnonzero(sums >= floor)
        place, score = np.append(place, found), np.append(score, sums[found])
        top = _best(score, shard.ids[place], k)
        place, score = place[top], score[top]
        if len(top) == k:
            floor = max(floor, int(score[-1]))
    return place, score


def weight(n: int, df: int) -> int:
    """``floor(1000 ln((2N + 2) / (2df + 1)))``."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _solver(queries: dict[int, tuple[np.ndarray, np.ndarray, int]], k: int, names: list[str]):
    """One shard against all queries of a block (item -> long lists' terms, their weights, known floor)."""

    def whole(t: pa.Table, c: str) -> np.ndarray:
        return t.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)

    def solve(lists: pa.Table, near: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if lists.num_rows:
            by_row = np.argsort(whole(lists, "row"))
            lists = lists.take(pa.array(by_row))
            rows, ids = whole(lists, "row"), whole(lists, "doc")
            number, tf = lists.column("number").combine_chunks(), lists.column("tf").combine_chunks()
            place = np.repeat(np.arange(len(rows)), np.diff(number.offsets.to_numpy()))
            shard = Shard(ids, whole(lists, "m"), place, number.flatten().to_numpy(), tf.flatten().to_numpy())
            items = whole(near, "item") if near.num_rows else np.zeros(0, np.int64)
            order = np.argsort(items, kind="stable")
            items = items[order]
            at = np.searchsorted(rows, whole(near, "row"))[order] if len(items) else items
            acc = whole(near, "acc")[order] if len(items) else items
            for item, (terms, weights, floor) in queries.items():
                lo, hi = np.searchsorted(items, [item, item + 1])
                found, score = search(shard, terms, weights, at[lo:hi], acc[lo:hi], floor, k)
                for c, v in zip(out, ([item] * len(found), ids[found].tolist(), score.tolist())):
                    c += v
        return pa.table([pa.array(c, pa.int64()) for c in out], names=names)

    return solve


def _block(docs: DataFrame, asked: DataFrame, k: int, short_share: float, shard_docs: int, names: list[str]) -> DataFrame | None:
    """Shard results of one block of queries, ``asked`` (item, term); None if no document has a term."""
    spark = docs.sparkSession
    by_item: dict[int, list[int]] = {}
    number: dict[bytes, int] = {}
    for r in asked.collect():  # about BLOCK_TERMS rows
        by_item.setdefault(r["item"], []).append(number.setdefault(r["term"].encode("utf-8"), len(number)))
    held = docs.mapInArrow(_lists(number), "doc long, n long, number array<int>, tf array<int>").where("n > 0")
    held = step(held.withColumn("row", F.monotonically_increasing_id()), "doc-terms")
    total = held.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = int(total["docs"]), int(total["terms"] or 0)
    if not n_docs:
        return None
    counted = held.select(F.explode("number").alias("number")).groupBy("number").count().collect()  # a row per asked term
    weights = {r["number"]: (weight(n_docs, r["count"]), r["count"]) for r in counted}
    most_short = max(1, math.floor(n_docs * short_share))
    shard = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n_docs // shard_docs)))).cast("int").alias("shard")
    m = F.expr(f"10 + (90 * n * {n_docs}L) div {n_terms}L").alias("m")
    # A NULL id counts above but is never returned.
    lists = held.where(F.col("doc").isNotNull() & (F.size("number") > 0)).select(shard, "row", "doc", m, "number", "tf")

    short = {t: w for t, (w, df) in weights.items() if df <= most_short}
    pairs = [(item, t, short[t]) for item, terms in by_item.items() for t in terms if t in short]
    short_lists = spark.createDataFrame(pairs, "item long, number int, w long")  # at most BLOCK_TERMS rows, as above
    each = lists.select("shard", "row", "m", F.explode(F.arrays_zip("number", "tf")).alias("p")).select("shard", "row", "m", "p.number", "p.tf")
    gain = F.expr("w * ((1000000000 * cast(tf AS long)) div (1000 * cast(tf AS long) + 8 * m))")
    acc = each.join(short_lists, "number").groupBy("item", "shard", "row").agg(F.sum(gain).alias("acc"))
    acc = step(acc, "accumulators")
    place = Window.partitionBy("item").orderBy(F.desc("acc"))
    top = acc.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k).groupBy("item")
    floors = {r["item"]: r["acc"] for r in top.agg(F.min("acc").alias("acc"), F.count("*").alias("c")).where(F.col("c") == k).collect()}
    queries = {}
    for item, terms in by_item.items():
        long_ = np.array([t for t in terms if t in weights and t not in short], np.int64)
        queries[item] = long_, np.array([weights[t][0] for t in long_.tolist()], np.int64), floors.get(item, 0)
    schema = ", ".join(f"`{n}` long" for n in names)
    return lists.groupBy("shard").cogroup(acc.groupBy("shard")).applyInArrow(_solver(queries, k, names), schema)


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    short_share: float = 1 / 64,
    shard_docs: int = SHARD_DOCS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` (ids named as in the input): each query's ``k`` best documents with a score above 0.

    Terms are maximal runs of ASCII digits, ASCII letters and characters beyond ASCII, A-Z lower-cased; whole texts
    count. A term adds ``floor(1000 ln((2N + 2) / (2df + 1)))`` times ``10^9 tf div (1000 tf + 8m)``, where ``m`` is
    ``10 + 90 n N div L``; equal scores go by the smaller id. NULL, empty and term-free texts are no documents. Rows that
    repeat an id are documents each; those with a NULL id count in N, L and df but are never returned. Queries with a
    NULL id are left out; rows that repeat a query id are one query with all their terms. Other columns are
    ignored, whatever their names. Without documents or query terms there are no rows.

    Lists of at most ``short_share`` of the documents are short. Queries are taken in blocks of about ``block_terms``
    terms (a longer one is a block alone), each one pass over the documents: only a block's terms are sent to all tasks.
    """
    names = [query_id_col, id_col, "score"]
    asked = queries.select(F.col(query_id_col).cast("long"), F.col(query_text_col).cast("string")).where(F.col(query_id_col).isNotNull())
    asked = asked.mapInArrow(_query_terms, "item long, terms array<string>").select("item", F.explode("terms").alias("term")).distinct()
    asked = step(asked, "query-terms")
    blocks = -(-asked.count() // block_terms)
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], ", ".join(f"`{n}` long" for n in names))
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        found = _block(base, mine, k, short_share, shard_docs, names)
        out = out if found is None else out.unionByName(found)
    best = Window.partitionBy(query_id_col).orderBy(F.desc("score"), F.asc(id_col))
    merged = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select(query_id_col, "rank", id_col, "score")
