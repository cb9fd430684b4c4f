"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

#: The white space of every contract: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def step(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here, lost executors do not matter."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    """A-Z only; other scripts keep their case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


__all__ = ["BLANKS", "BLANK_CLASS", "cut_lineage", "lower_ascii", "scratch_path", "step", "table"]
