"""Divergence of the sources of each language by a three-dimensional cube of (source block, source block, term block).

Each source's counts of the kept terms become slices, one per term block, with the shares of the terms it has and the one
share of all it lacks. A cell of the cube gets the slices of two source blocks in one term block, sums the absolute
differences of each pair of sources there, and the partial sums are added along the term axis. A slice goes to one cell
per source block, so a task's memory is bounded by the block sizes, not by the number of sources or terms.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import step

#: Sources and terms of a block on average (blocks are dealt by hash), and entries a task counts before it gives them on.
SOURCE_BLOCK, TERM_BLOCK, HELD_TERMS = 32, 4096, 200_000
SMOOTH = 5

#: A-Z become small; other ASCII but letters becomes a space; bytes of characters beyond ASCII stay.
_TABLE = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256)).lower()


def _counts(batches):
    """Terms of each (lang, source) with occurrences and documents, added up in the task; a NULL term for the pair itself."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def given():
        for (lang, source), (times, docs) in held.items():
            terms = [None, *(t.decode("utf-8") for t in times)]
            n = len(terms)
            cols = [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(terms, pa.string())]
            cols += [pa.array([0, *times.values()], pa.int64()), pa.array([0, *(docs[t] for t in times)], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "times", "docs"])

    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            found = Counter((text.as_py() or "").encode("utf-8").translate(_TABLE).split(b" "))
            del found[b""]
            size -= len(times)
            times.update(found)
            docs.update(found.keys())
            size += len(times)
            if size > HELD_TERMS:
                yield from given()
                held, size = {}, 0
    yield from given()


def share(count: Column, total: Column) -> Column:
    """``1 + floor(10^9 (count + 5) / total)`` in 64-bit steps: a long division by three digits at a time."""
    out, rest = F.lit(0).cast("long"), count + SMOOTH
    for _ in range(3):
        scaled = rest * 1000
        out, rest = out * 1000 + F.call_function("div", scaled, total), scaled % total
    return out + 1


def _slices(group: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray, int]:
    """Sources, their shares of all terms that any slice of the cell has (sources x terms), of those it lacks, and how
    many kept terms of the block none of them has."""
    sources = group.column("source").to_pylist()
    base = group.column("base").combine_chunks().to_numpy()
    terms, shares = group.column("terms").combine_chunks(), group.column("shares").combine_chunks()
    code = terms.flatten().dictionary_encode()
    width = len(code.dictionary)
    out = np.repeat(base[:, None], width, 1)
    row = np.repeat(np.arange(len(sources)), np.diff(terms.offsets.to_numpy()))
    out[row, code.indices.to_numpy()] = shares.flatten().to_numpy()
    return sources, out, base, group.column("block_terms")[0].as_py() - width


def _cell(group: pa.Table) -> pa.Table:
    """Partial divergences of the pairs (source of the first block, source of the second) in one term block."""
    first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
    block = group.column("block").combine_chunks().to_numpy()
    sources, p, base, absent = _slices(group)
    a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
    lang, out = group.column("lang")[0].as_py(), [[], [], []]
    for i in a.tolist():
        js = b if first != second else b[b > i]
        partial = np.abs(p[js] - p[i]).sum(1) + np.abs(base[js] - base[i]) * absent
        for j, v in zip(js.tolist(), partial.tolist()):
            # rows come in any order: the smaller name first, so that a pair is the same in all term blocks
            left, right = sorted((sources[i], sources[j]))
            out[0].append(left)
            out[1].append(right)
            out[2].append(v)
    cols = [pa.array([lang] * len(out[0]), pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())]
    return pa.table(cols, names=["lang", "left", "right", "partial"])


def divergence_audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = 30,
    top_terms: int = 50,
    source_block: int = SOURCE_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how far each source of a language is from its others.

    Terms are maximal runs of ASCII letters and characters beyond ASCII, A-Z lower-cased, of whole texts. A language keeps
    the terms in at least ``least_docs`` of its documents (rows; repeated rows count each). A group's share of a kept term
    is ``1 + floor(10^9 (count + 5) / (N + 5V))``, N its kept occurrences, V the kept terms. Part ``pair``: items are the
    language's other sources, the value is the sum of absolute differences of the shares over all kept terms (0 if there
    are none), all ranks. Part ``term``: items are the ``top_terms`` kept terms by how far the source's share is above the
    language's, if it has them at all. Ranks go by falling value, then by item in UTF-8 order.

    NULL lang, source and text are empty ones. A source without terms still has its pairs; a language with one source
    has none. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    empty = F.lit("")
    base = docs.select(*(F.coalesce(F.col(c).cast("string"), empty) for c in (lang_col, source_col, text_col)))
    # Copies and common terms are added up in each task first, so a source with a third of all rows is a few rows per task.
    counts = base.mapInArrow(_counts, "lang string, source string, term string, times long, docs long")
    counts = step(counts.groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs")), "term-counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("times").alias("all_times"), F.sum("docs").alias("docs"))
    kept = step(kept.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_times").alias("all_n"))
    ours = step(counts.drop("docs").where("term is not null").join(kept, ["lang", "term"]), "kept-counts")
    sizes = ours.groupBy("lang", "source").agg(F.sum("times").alias("n"))
    groups = counts.where("term is null").select("lang", "source").join(langs, "lang", "left").join(sizes, ["lang", "source"], "left")
    groups = groups.na.fill(0, ["v", "all_n", "n"])
    many = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = groups.join(many, "lang")
    blocks = F.ceil(F.col("sources") / source_block)
    groups = groups.withColumns(
        {
            "total": F.col("n") + SMOOTH * F.col("v"),
            "all_total": F.col("all_n") + SMOOTH * F.col("v"),
            "blocks": blocks.cast("int"),
            "block": F.pmod(F.xxhash64("source"), blocks).cast("int"),
            "term_blocks": F.greatest(F.lit(1), F.ceil(F.col("v") / term_block)).cast("int"),
        }
    )
    groups = step(groups.select("lang", "source", "v", "total", "all_total", "blocks", "block", "term_blocks"), "sources")
    shares = ours.join(groups, ["lang", "source"]).withColumn("p", share(F.col("times"), F.col("total")))
    cut = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int")

    above = shares.withColumn("value", F.col("p") - share(F.col("all_times"), F.col("all_total"))).where("value > 0 and times > 0")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    terms = terms.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= top_terms)

    # Slices: every (source, term block), also without a term of the source.
    have = shares.groupBy("lang", "source", cut.alias("term_part")).agg(F.collect_list(F.struct("term", "p")).alias("l"))
    every = groups.where("v > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("term_part"))
    widths = kept.join(groups.select("lang", "term_blocks").distinct(), "lang").groupBy("lang", cut.alias("term_part")).agg(F.count("*").alias("block_terms"))
    slices = every.join(have, ["lang", "source", "term_part"], "left").join(widths, ["lang", "term_part"])
    slices = slices.select(
        "lang", "source", "term_part", "block", "blocks", "block_terms", share(F.lit(0).cast("long"), F.col("total")).alias("base"),
        F.coalesce(F.col("l.term"), F.array().cast("array<string>")).alias("terms"),
        F.coalesce(F.col("l.p"), F.array().cast("array<bigint>")).alias("shares"),
    )
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = slices.select("*", others).drop("blocks").withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    partial = cells.groupBy("lang", "first", "second", "term_part").applyInArrow(_cell, "lang string, left string, right string, partial long")
    summed = partial.groupBy("lang", "left", "right").agg(F.sum("partial").alias("value"))
    # Without kept terms there are no cells: those languages' pairs are all at 0.
    bare = groups.where("v = 0").select("lang", "source")
    zero = bare.join(bare.withColumnRenamed("source", "right"), "lang").where("source < right")
    summed = summed.unionByName(zero.select("lang", F.col("source").alias("left"), "right", F.lit(0).cast("long").alias("value")))
    both = F.explode(F.array(F.struct(F.col("left").alias("source"), F.col("right").alias("item")), F.struct(F.col("right").alias("source"), F.col("left").alias("item"))))
    pairs = summed.select("lang", both.alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked).cast("int"))
    return pairs.unionByName(terms)
