"""Delimited scans, Parquet staging, literal lookups and sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import to_double
from ..session import file_system, scratch_path


_BAD = "__bad_record"


@dataclass(frozen=True)
class Scan:
    """Rows of a delimited file, and apart from them the records that are no rows of the schema, each with its reason."""

    rows: DataFrame
    rejected: DataFrame

    def report(self) -> DataFrame:
        """Number of rejected records per reason."""
        return self.rejected.groupBy("reason").agg(F.count("*").alias("n"))


def scan_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ";",
    columns: Sequence[str] | None = None,
    multiline: bool = True,
) -> Scan:
    """CSV scan with a declared schema and an optional column subset; nothing is lost without a sign.

    Quoted fields may hold separators, quotes and line breaks. A record with too few or too many fields, or with a field
    that is neither missing ("" or "NA") nor a value of its type, is rejected: ``rejected`` has the record's text
    and its ``reason``. Every field of the schema is looked at, also those outside ``columns``.

    With ``multiline`` a file is read by one task, as a gzip file is anyway. Without it large plain files are split, and a
    quoted line break ends its record, which is then rejected as too short.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_BAD, T.StringType())])
    raw = (
        spark.read.schema(text)
        .option("sep", sep)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .csv(path)
    )
    given = {f.name: F.when(~F.col(f.name).isin("", "NA"), F.col(f.name)) for f in schema}
    typed = {f.name: _typed(given[f.name], f.dataType) for f in schema}
    wrong = [F.when(given[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in given]
    reason = F.when(F.col(_BAD).isNotNull(), F.lit("number of fields")).otherwise(
        F.concat(F.lit("no value of its type: "), F.array_join(F.nullif(F.array_compact(F.array(*wrong)), F.array().cast("array<string>")), ", "))
    )
    record = F.coalesce(F.col(_BAD), F.to_csv(F.struct(*[F.col(n) for n in given]), {"sep": sep}))
    parsed = raw.withColumn("__reason", reason)
    rows = parsed.where("__reason is null").select(*[typed[n].alias(n) for n in (columns or given)])
    return Scan(rows, parsed.where("__reason is not null").select(record.alias("record"), F.col("__reason").alias("reason")))


def _typed(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return c
    return to_double(c).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.trim(c).try_cast(kind)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ";",
    columns: Sequence[str] | None = None,
    spread: int | None = None,
    rejected: str = "raise",
) -> DataFrame:
    """The rows of a delimited file. With ``rejected="raise"`` a bad record ends the query, with ``"drop"`` it is left out.

    A gzip file is one task, so ``spread`` can redistribute its rows for the steps after it.
    """
    if rejected not in ("raise", "drop"):
        raise ValueError("rejected is 'raise' or 'drop'")
    scan = scan_delimited(spark, path, schema, sep, columns)
    df = scan.rows
    if rejected == "raise":
        stop = F.raise_error(F.concat(F.lit("bad record ("), "reason", F.lit("): "), "record"))
        df = df.unionByName(scan.rejected.select(*[stop.cast(t).alias(c) for c, t in df.dtypes]))
    return df.repartition(spread) if spread else df


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated scan with a declared schema."""
    return read_delimited(spark, path, schema, sep=",")


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = None, sep: str = ","
) -> str:
    """Write one dataset; CSV output carries a header and writes missing values as NA."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "NA").option("escape", '"').option("sep", sep)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        compression = compression or "gzip"
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)
    return path


def stage(df: DataFrame, layer: str, base: str | None = None) -> DataFrame:
    """Write a snapshot under a new versioned path and read it back.

    Each step gets its own path, so no step overwrites its own input and a lost executor
    never triggers recomputation of the steps before it.
    """
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/{layer}" if base else scratch_path(spark, layer)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


class Snapshots:
    """Versions of one named dataset below a folder, and which of them is the current one.

    A version's rows are written first, under a path of their own; then one small marker file, which must not exist yet, is
    created with the version's path and schema. The marker with the largest number is the current version, so the
    switch is one atomic step, on object stores, too: a step that fails before it leaves the old version in place, and of
    two writers one gets an error.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, f"{folder.rstrip('/')}/{name}", name

    def versions(self) -> list[int]:
        store, target = file_system(self.spark, f"{self.folder}/_versions")
        return sorted(int(f.getPath().getName()) for f in store.listStatus(target)) if store.exists(target) else []

    def current(self) -> int | None:
        return max(self.versions(), default=None)

    def _marker(self, version: int) -> dict:
        store, target = file_system(self.spark, f"{self.folder}/_versions/{version}")
        if not store.exists(target):
            raise ValueError(f"{self.name} has no version {version}")
        stream = store.open(target)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or an older one that is still kept."""
        version = self.current() if version is None else version
        if version is None:
            raise ValueError(f"{self.name} has no version yet")
        marker = self._marker(version)
        return self.spark.read.schema(T.StructType.fromJson(marker["schema"])).parquet(marker["path"])

    def write(self, df: DataFrame) -> int:
        """A new current version; ``df`` may read the one before. Returns its number."""
        path = f"{self.folder}/data-{uuid.uuid4().hex}"
        write_table(df, path, compression="zstd")
        return self._switch(path, df.schema.jsonValue())

    def restore(self, version: int) -> int:
        """An older version's rows become the current version again, under a new number."""
        marker = self._marker(version)
        return self._switch(marker["path"], marker["schema"])

    def _switch(self, path: str, schema: dict) -> int:
        version = (self.current() or 0) + 1
        store, target = file_system(self.spark, f"{self.folder}/_versions/{version}")
        store.mkdirs(target.getParent())
        stream = store.create(target, False)  # an error if another writer has created it
        try:
            stream.write(bytearray(json.dumps({"path": path, "schema": schema}), "utf-8"))
        finally:
            stream.close()
        return version

    def remove_old(self, keep: int = 1) -> None:
        """Remove all but the last ``keep`` versions, and rows that no version names, such as those of a failed step."""
        versions = self.versions()
        old, kept = versions[: max(0, len(versions) - max(keep, 1))], versions[-max(keep, 1) :]
        for v in old:
            store, target = file_system(self.spark, f"{self.folder}/_versions/{v}")
            store.delete(target, False)
        named = {self._marker(v)["path"].rsplit("/", 1)[-1] for v in kept}
        store, target = file_system(self.spark, self.folder)
        for f in store.listStatus(target):
            if f.getPath().getName().startswith("data-") and f.getPath().getName() not in named:
                store.delete(f.getPath(), True)


def lookup(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal table. Spark knows the size of local rows and broadcasts them below its own limit."""
    return spark.createDataFrame(list(rows), schema)


def positional_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def review_extract(df: DataFrame, rule: Column, columns: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """Rows that need human review, projected and sorted for the reviewer."""
    return df.filter(rule).select(*columns).orderBy(*order)
