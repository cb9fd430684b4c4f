"""The contract view of the tree models: orders meet customers first; the rows stay, also with missing and repeated keys."""

from __future__ import annotations

import datetime
import inspect

from tenderlens.catalog import models as C
from tenderlens.sources.contracts import contracts


def test_orders_meet_customers_first(spark, tmp_path):
    at = datetime.datetime(2020, 1, 2)
    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, l_discount double, l_linestatus string, l_shipdate timestamp",
                     [(o, p, s, i, 2.0, 10.0 + i, 0.1, "O", at) for i, (o, p, s) in enumerate([(1, 1, 1), (1, 2, 1), (2, 1, 2), (2, None, 2), (None, 1, 1), (3, 9, 1), (4, 1, 9), (5, 2, 2), (6, 1, 1)])]),
        "orders": ("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 1, 5.0, at, "a"), (1, 2, 6.0, at, "b"), (2, 2, 7.0, at, None), (5, None, 8.0, at, "a"), (6, 7, 9.0, at, "a"), (None, 1, 1.0, at, "a")]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(1, "x", 1, "s"), (2, "y", None, "s"), (2, "z", 3, "t"), (None, "n", 4, "t")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "u", 1), (2, "v", 2), (2, "v", 2), (None, "w", 3)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string", [(1, "p", "b", "t"), (2, "q", "c", "t"), (2, "q", "d", "t"), (None, "r", "e", "t")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for columns in (C._PERIOD_NEED, None, ["order_id", "family"], ["order_id", "exec_place"]):
        before, now = (contracts(spark, str(tmp_path), columns, orders_first=first) for first in (False, True))
        assert before.columns == now.columns and sorted(map(str, before.collect())) == sorted(map(str, now.collect())) and before.count() > 3
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        moves = [contracts(spark, str(tmp_path), C._PERIOD_NEED, orders_first=first)._jdf.queryExecution().optimizedPlan().toString() for first in (False, True)]
    finally:
        spark.conf.set(key, old)
    # in the new plan the join on customers stands below the one on orders
    depth = [[len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join" in line and key in line][0] - [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join" in line and other in line][0] for plan in moves for key, other in (("c_custkey", "l_orderkey"),)]
    assert depth[0] < 0 < depth[1] and "orders_first=True" in inspect.getsource(C.period_features)
