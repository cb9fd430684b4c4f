"""Contract view: one row per line item, seen as a contract between a buyer and a supplier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table. How many splits a scan has is the session's business (``spark.sql.files`` settings)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# view column -> (tables needed besides lineitem, expression)
_COLUMNS = {
    "order_id": ((), lambda: F.col("l_orderkey")),
    "line_no": ((), lambda: F.col("l_linenumber")),
    "buyer_id": ((), lambda: F.col("l_suppkey")),
    "buyer_name": (("supplier",), lambda: F.col("s_name")),
    "buyer_place": (("supplier",), lambda: F.col("s_nationkey")),
    "supplier_id": (("orders",), lambda: F.col("o_custkey")),
    "supplier_name": (("orders", "customer"), lambda: F.col("c_name")),
    "exec_place": (("orders", "customer"), lambda: F.col("c_nationkey")),
    "seg": (("orders", "customer"), lambda: F.col("c_mktsegment")),
    "val": ((), lambda: F.col("l_extendedprice")),
    "addition": ((), lambda: F.col("l_extendedprice") * F.col("l_discount")),
    "process_value": (("orders",), lambda: F.col("o_totalprice")),
    "term": ((), lambda: F.col("l_quantity")),
    "term_unit": ((), lambda: F.when(F.col("l_linestatus") == "O", "M").otherwise("D")),
    "ext_days": (
        ("orders",),
        lambda: F.greatest(F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")), F.lit(0)),
    ),
    "signed": (("orders",), lambda: F.col("o_orderdate").cast("date")),
    "year": (("orders",), lambda: F.year("o_orderdate")),
    "month": (("orders",), lambda: F.month("o_orderdate")),
    "process_type": (("orders",), lambda: F.col("o_orderpriority")),
    "contract_type": (("part",), lambda: F.col("p_type")),
    "grp": (("part",), lambda: F.col("p_brand")),
    "family": (("part",), lambda: F.col("p_name")),
}

_JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "customer": ("o_custkey", "c_custkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
    "part": ("l_partkey", "p_partkey"),
}

CLOSED_PROCESS = "4-NOT SPECIFIED"


def contracts(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, orders_first: bool = False) -> DataFrame:
    """The contract view restricted to ``columns``; only the tables they need are joined.

    With ``orders_first`` orders meet their customers before the line items do, and the line items their parts while they are narrow:
    where no side is small, the line items move once less. The rows are the same.

    No side is broadcast by hint: the dimension tables grow with the data, so the choice is
    left to Spark's own size check.
    """
    columns = list(columns or _COLUMNS)
    needed = {t for c in columns for t in _COLUMNS[c][0]}
    df = table(spark, sf_dir, "lineitem")
    order = ("part", "orders", "supplier") if orders_first and {"orders", "customer"} <= needed else _JOINS
    for name in order:
        if name in needed:
            other = table(spark, sf_dir, name)
            if name == "orders" and order is not _JOINS:
                other = other.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "inner")
            left, right = _JOINS[name]
            df = df.join(other, F.col(left) == F.col(right), "inner")
    return df.select(*[_COLUMNS[c][1]().alias(c) for c in columns])
