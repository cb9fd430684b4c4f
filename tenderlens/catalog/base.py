"""Registry and the SQL form of the contract view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return register


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round result columns so that summation order does not show."""
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


# SQL text of the contract view, for the equivalents
C = """
WITH c AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS buyer_id, s_name AS buyer_name,
         s_nationkey AS buyer_place, o_custkey AS supplier_id, c_name AS supplier_name, c_nationkey AS exec_place,
         c_mktsegment AS seg, l_extendedprice AS val, l_extendedprice * l_discount AS addition,
         o_totalprice AS process_value, l_quantity AS term,
         CASE WHEN l_linestatus = 'O' THEN 'M' ELSE 'D' END AS term_unit,
         greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0) AS ext_days,
         CAST(o_orderdate AS DATE) AS signed, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         o_orderpriority AS process_type, p_type AS contract_type, p_brand AS grp, p_name AS family
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
)"""
