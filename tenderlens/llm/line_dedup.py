"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A run is a table (hash, owner), bucketed and sorted by hash, of the lines that a batch was first to hold. A new batch
is merge-joined with each run: lines found there are repeats, the others become the batch's own run. When a level
holds ``fanout`` runs they are merged into one run of the next level, so a batch meets few runs however many batches
came before. Batches go by ascending document id, hence the owner of a line is the smallest id that holds it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, lower_ascii, scratch_path


def line_key(line: Column) -> Column:
    """Stripped at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """The runs, by level. Tables are external ones in the shared folder and known only to this session."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 2):
        # As many buckets as shuffle partitions: a run is then written, and joined, by one task per bucket.
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._n, self._tag = 0, uuid.uuid4().hex[:12]

    def close(self) -> None:
        """Take the runs out of the session's catalogue; their files belong to the scratch folder."""
        for i in range(1, self._n + 1):
            self.spark.sql(f"DROP TABLE IF EXISTS line_run_{self._tag}_{i}")

    def _write(self, df: DataFrame) -> str:
        self._n += 1
        name = f"line_run_{self._tag}_{self._n}"
        (
            df.repartition(self.buckets, "hash")
            .write.format("parquet")
            .option("path", scratch_path(self.spark, name))
            .bucketBy(self.buckets, "hash")
            .sortBy("hash")
            .saveAsTable(name)
        )
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def match(self, keys: DataFrame) -> DataFrame:
        """``keys`` (hash, owner, last) with ``known`` = the owner in an earlier run, else NULL."""
        out = keys.withColumn("known", F.lit(None).cast("long"))
        for run in self.runs():
            out = out.join(run.select("hash", F.col("owner").alias("_o")), "hash", "left")
            out = out.withColumn("known", F.coalesce("known", "_o")).drop("_o")
        return out

    def add(self, run: DataFrame) -> None:
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(run.select("hash", "owner")))
        at = 0
        while len(self.levels[at]) >= self.fanout:
            merged = None
            for name in self.levels[at]:
                part = self.spark.table(name)
                merged = part if merged is None else merged.unionByName(part)
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(self._write(merged))
            self.levels[at] = []
            at += 1


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    batches: int = 3,
    buckets: int | None = None,
    fanout: int = 2,
    text_out: str = "kept_text",
) -> DataFrame:
    """All columns of ``docs`` and ``n_lines``, ``n_dropped``, ``kept_text`` (whole text without the dropped lines).

    A line whose key has at least ``min_chars`` code points and occurs in at least two documents stays only in the
    smallest id that holds it, there with all its repeats. NULL or empty text is one empty line; its kept text is
    empty. Rows that repeat an id are one document. Rows with a NULL id keep all lines and own none. Lines are
    identified by the first 128 bits of their SHA-256. Input columns named like an output are replaced.
    ``batches`` is the number of ranges of ids that go in one after the other.
    """
    spark = docs.sparkSession
    rid, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    tag = F.xxhash64(F.coalesce(text, F.lit("")))
    cuts = docs.select(F.percentile_approx(rid, [i / batches for i in range(1, batches)], 1000).alias("c")).first()["c"] if batches > 1 else []
    batch = F.lit(0)
    for c in sorted(set(cuts or [])):
        batch = batch + (F.col("row_id") > c).cast("int")
    all_lines = scratch_path(spark, "lines")
    (
        docs.where(rid.isNotNull())
        .select(rid.alias("row_id"), tag.alias("tag"), F.posexplode(_lines(text)).alias("pos", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        .select("row_id", "tag", "pos", F.substring(F.unhex(F.sha2("key", 256)), 1, 16).alias("hash"), batch.alias("batch"))
        .write.partitionBy("batch")
        .parquet(all_lines)
    )
    schema = "row_id long, tag long, pos int, hash binary, batch int"
    lines = spark.read.schema(schema).parquet(all_lines)

    store, dropped = LineRuns(spark, buckets, fanout), None
    for k in range(len(set(cuts or [])) + 1):
        mine = lines.where(F.col("batch") == k)
        keys = mine.groupBy("hash").agg(F.min("row_id").alias("owner"), F.max("row_id").alias("last"))
        met = scratch_path(spark, "batch")
        store.match(keys).withColumn("fresh", F.col("known").isNull()).write.partitionBy("fresh").parquet(met)
        seen = spark.read.schema("hash binary, owner long, last long, known long, fresh boolean").parquet(met)
        store.add(seen.where("fresh"))
        # Only keys that lose a line meet the lines again; a frequent line is split by the skew join.
        repeats = seen.where("known is not null or owner <> last").select("hash", F.coalesce("known", "owner").alias("first"))
        lost = mine.join(repeats, "hash").where("row_id > first").select("row_id", "tag", "pos")
        dropped = lost if dropped is None else dropped.unionByName(lost)
    store.close()  # what the runs told is written

    # A document's positions are at most its own lines, so this set is bounded by a row of the input, however many rows
    # of one id and text bring the same positions.
    holes = dropped.groupBy("row_id", "tag").agg(F.sort_array(F.collect_set("pos")).alias("_holes"))
    outs = ["n_lines", "n_dropped", text_out]
    # The other columns travel in one, so that their names meet none of those used here.
    names = [c for c in docs.columns if c not in outs or c in (id_col, text_col)]
    carried = docs.select(
        rid.alias("_row"), tag.alias("_tag"), text.alias("_text"),
        F.struct(F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c != text_col]).alias("_doc"),
    )
    out = carried.join(
        holes.select(F.col("row_id").alias("_row"), F.col("tag").alias("_tag"), "_holes"), ["_row", "_tag"], "left"
    )
    text = F.col("_text")
    lines_of, n_lost = _lines(text), F.when(F.col("_holes").isNull(), 0).otherwise(F.size("_holes"))
    # The gaps between dropped positions are slices of the split text: linear in the number of lines.
    gap = F.transform(
        F.sequence(F.lit(0), F.size("_holes")),
        lambda i: F.slice(
            F.col("_lines"),
            F.when(i == 0, F.lit(1)).otherwise(F.get("_holes", i - 1) + 2),
            F.when(i < F.size("_holes"), F.get("_holes", i)).otherwise(F.size("_lines"))
            - F.when(i == 0, F.lit(0)).otherwise(F.get("_holes", i - 1) + 1),
        ),
    )
    out = out.withColumn("_lines", lines_of)
    kept = F.when(F.col("_holes").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.flatten(gap), "\n"))
    back = [(text if c == text_col else F.col("_doc")[f"c{i}"]).alias(c) for i, c in enumerate(names) if c not in outs]
    return out.select(*back, F.size("_lines").cast("long").alias("n_lines"), n_lost.cast("long").alias("n_dropped"), kept.alias(text_out))
