"""Licence scan: sparse TF-IDF cosine of lines, runs of lines and whole files to licence templates, then inheritance from
the nearest directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import step
from .licence_texts import BODIES, TEMPLATES, VARIANTS, VERSIONS

LEAST_COSINE = 0.8
LICENCE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.-][^/]*)?$"
#: What opens a comment line; its first group is the kind of comment.
COMMENT = r"^[ \t]*/?([*]|/|#|--|;|%)"

Texts = Mapping[str, Sequence[str]]


def _terms(text: str) -> list[str]:
    return [t for t in re.split("[^a-z0-9]+", text.lower()) if t]


def terms(text: Column) -> Column:
    """Runs of a-z and 0-9, lower-cased."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def numbered(templates: Texts, bodies: Texts) -> list[tuple[int, str, str, bool]]:
    """(number, licence, text, whether it is a body) of each template."""
    texts = [(name, x, whole) for group, whole in ((templates, False), (bodies, True)) for name in sorted(group) for x in group[name]]
    return [(k, *t) for k, t in enumerate(texts)]


def guards(text: str, body: bool) -> tuple[list[str], list[str]]:
    """(terms a match must have, terms it must not have): those of its version and variant.

    Version numbers count for notices that name one; in a body they number the clauses.
    """
    own = set(_terms(text))
    versions = set() if body or not own.intersection(VERSIONS) else set(VERSIONS)
    told = versions.union(VARIANTS)
    return sorted(told & own), sorted(told - own)


def weigh(df: Mapping[str, int], n: int, entries: Sequence[tuple[int, str, str, bool]], least: float):
    """(idf of the templates' terms, idf of any other term, weights (number, term, weight), marker terms).

    A text without marker terms cannot reach the cosine ``least``: what is left of each template is too light. The rarest terms
    that do so are taken, so few texts have one.
    """
    idf = {t: math.log((n + 1) / (c + 1)) + 1 for t, c in df.items()}
    weights, markers = [], set()
    for k, _, text, _ in entries:
        w = {t: tf * idf[t] for t, tf in Counter(_terms(text)).items()}
        norm, light = math.sqrt(sum(x * x for x in w.values())), 0.0
        weights += [(k, t, x / norm) for t, x in sorted(w.items())]
        for t, x in sorted(w.items(), key=lambda i: (idf[i[0]], i[0])):
            light += (x / norm) ** 2
            if light >= least**2 * (1 - 1e-9):
                markers.add(t)
    return idf, math.log(n + 1) + 1, weights, sorted(markers)


def passages(files: DataFrame, markers: Column) -> DataFrame:
    """``path``, ``copy``, ``kind``, ``no``, ``line_no``, ``t`` (terms): each line that has terms, once per passage it is in.

    Passages are the ``line``; the ``run`` of lines with the same kind of comment mark, or with none; the ``block``, a part of a run
    without lines empty of terms; and the ``file``. Of single lines only those with a term of ``markers`` are listed.
    """
    lines = files.select("path", F.sha2("text", 256).alias("copy"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("path", "copy", "line_no", F.regexp_extract("line", COMMENT, 1).alias("mark"), terms(F.col("line")).alias("t"))
    # The lines of one file: no more rows than its text, which is one row already, has lines.
    order = Window.partitionBy("path", "copy").orderBy("line_no")
    turn = F.coalesce(F.col("mark") != F.lag("mark").over(order), F.lit(True))
    gap = (F.size("t") == 0) != F.coalesce(F.lag(F.size("t") == 0).over(order), F.lit(True))
    lines = lines.withColumn("turn", turn).withColumn("part", turn | gap)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("run", F.count(F.when(F.col("turn"), 1)).over(upto)).withColumn("part", F.count(F.when(F.col("part"), 1)).over(upto))
    kinds = F.array(
        F.when(F.arrays_overlap("t", markers), F.struct(F.lit("line").alias("kind"), F.col("line_no").cast("long").alias("no"))),
        F.struct(F.lit("block").alias("kind"), F.col("part").alias("no")),
        F.struct(F.lit("run").alias("kind"), F.col("run").alias("no")),
        F.struct(F.lit("file").alias("kind"), F.lit(0).cast("long").alias("no")),
    )
    lines = lines.where(F.size("t") > 0).select("path", "copy", "line_no", "t", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("x"))
    return lines.select("path", "copy", "x.kind", "x.no", "line_no", "t")


def notices(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    templates: Texts = TEMPLATES,
    bodies: Texts = BODIES,
    least: float = LEAST_COSINE,
) -> DataFrame:
    """``path``, ``line_no`` (first line, from 0), ``n_lines``, ``licence``, ``cosine``: each path's best passage and template of
    cosine ``least`` or more whose version and variant agree (``guards``).

    Single lines, blocks and runs of lines, and whole files are compared (``passages``). Ties go to the first line, then the
    shortest passage, then the first licence by name. Inverse document frequencies are counted over all rows; only the templates'
    terms are counted, others weigh as terms never seen. The templates are a fixed list given by the caller, so their weights are
    broadcast. NULL paths and texts hold nothing.
    """
    spark = files.sparkSession
    entries = numbered(templates, bodies)
    vocabulary = sorted({t for _, _, x, _ in entries for t in _terms(x)})
    text = F.col(text_col).cast("string")
    counted = files.select(F.explode(F.array_intersect(terms(text), F.array(*map(F.lit, vocabulary)))).alias("term"))
    counts = {r["term"]: r["count"] for r in counted.groupBy("term").count().collect()}  # at most the vocabulary
    idf, other, weights, markers = weigh({t: counts.get(t, 0) for t in vocabulary}, files.count(), entries, least)
    marked = F.array(*map(F.lit, markers))
    # What is left are the few files with a term that a match cannot do without.
    near = files.select(F.col(path_col).cast("string").alias("path"), text.alias("text")).where("path is not null")
    near = step(near.where(F.arrays_overlap(terms(F.col("text")), marked)).dropDuplicates(["path", "text"]), "licence-files")
    # Terms with counts; passages of the same lines are one.
    key = ["path", "copy", "kind", "no"]
    listed = passages(near, marked)
    term = listed.select(*key, F.explode("t").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf"))
    weight = F.broadcast(spark.createDataFrame(sorted(idf.items()), "term string, idf double"))
    term = term.join(weight, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    told = F.collect_set(F.when(F.col("term").isin(*VARIANTS, *VERSIONS), F.col("term"))).alias("told")
    norm = term.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), told)
    known = F.broadcast(spark.createDataFrame(weights, "k int, term string, weight double"))
    dots = term.join(known, "term").groupBy(*key, "k").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    cosines = dots.join(norm, key).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("cosine") >= least)
    names = [(k, name, *guards(x, body)) for k, name, x, body in entries]
    names = F.broadcast(spark.createDataFrame(names, "k int, licence string, needs array<string>, bars array<string>"))
    hits = cosines.join(names, "k").where((F.size(F.array_except("needs", "told")) == 0) & ~F.arrays_overlap("bars", "told"))
    hits = hits.groupBy(*key).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence")).alias("h"))
    extent = listed.groupBy(*key).agg(F.min("line_no").alias("line_no"), (F.max("line_no") - F.min("line_no") + 1).alias("n_lines"))
    best = hits.join(extent, key).groupBy("path").agg(F.min(F.struct("h.c", "line_no", "n_lines", "h.licence")).alias("b"))
    return best.select("path", "b.line_no", "b.n_lines", "b.licence", (-F.col("b.c")).alias("cosine"))


def _folder(path: Column) -> Column:
    """What stands before the last ``/``; empty for a file at the top."""
    return F.regexp_replace(path, "(^|/)[^/]*$", "")


def scan(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    is_licence_file: Column | None = None,
    templates: Texts = TEMPLATES,
    bodies: Texts = BODIES,
    least: float = LEAST_COSINE,
) -> DataFrame:
    """One row per input row: ``path``, ``line_no``, ``n_lines``, ``licence``, ``cosine``, ``inherited``, ``inherited_from``.

    ``licence`` is the file's own by its best passage. ``inherited`` is the licence of the nearest directory, from the
    file's own upwards, that holds a licence file with a recognised notice (of several the smallest path);
    ``is_licence_file`` decides over the columns ``path`` and ``line_no``, by default by file name. NULL or empty text
    has no own licence; a NULL path has neither. Rows repeating a path share the best notice of all of them; other
    columns are ignored.
    """
    own = notices(files, path_col, text_col, templates, bodies, least)
    marked = F.col("path").rlike(LICENCE_NAME) if is_licence_file is None else is_licence_file
    holds = own.where(marked).groupBy(_folder(F.col("path")).alias("above")).agg(F.min(F.struct("path", "licence")).alias("b"))
    holds = holds.select("above", F.col("b.licence").alias("inherited"))
    paths = files.select(F.col(path_col).cast("string").alias("path")).withColumn("folder", _folder(F.col("path")))
    # Directories, not files, look for their ancestors: one row per directory and level.
    parts = F.split("folder", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("above")))
    levels = paths.where("folder is not null").select("folder").distinct().select("folder", F.explode(up).alias("a"))
    levels = levels.select("folder", "a.depth", "a.above").join(holds, "above")
    nearest = levels.groupBy("folder").agg(F.max(F.struct("depth", "above", "inherited")).alias("n"))
    nearest = nearest.select("folder", F.col("n.inherited").alias("inherited"), F.col("n.above").alias("inherited_from"))
    out = paths.join(own, "path", "left").join(nearest, "folder", "left")
    return out.select("path", "line_no", "n_lines", "licence", "cosine", "inherited", "inherited_from")
