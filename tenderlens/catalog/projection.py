"""Sources, sinks, projections, filters, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import joins as J
from ..operators.sampling import sample_by_key, split_by_key, top_one
from ..plans.panel import level_of
from ..plans.quality import value_anomalies
from ..session import scratch_path
from ..sources import files as IO
from ..sources.contracts import contracts, table
from .base import C, query


@query("S1_delimited_scan", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def s1(spark, d):
    path = IO.write_table(
        table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"),
        scratch_path(spark, "delimited"),
        "csv",
        sep=";",
    )
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"
    keep = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    return IO.read_delimited(spark, path, schema, columns=keep, spread=spark.sparkContext.defaultParallelism)


@query("S2_table_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s2(spark, d):
    df = table(spark, d, "customer")
    path = IO.write_table(df, scratch_path(spark, "table"), "csv", compression="none")
    return IO.read_table(spark, path, df.schema)


@query(
    "S3_table_sink",
    "SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_brand END AS p_brand, p_retailprice FROM part",
)
def s3(spark, d):
    df = table(spark, d, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("p_brand"), "p_retailprice"
    )
    path = IO.write_table(df, scratch_path(spark, "sink"), "csv")
    return IO.read_table(spark, path, df.schema)


@query(
    "S4_staged_snapshot",
    "SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem "
    "GROUP BY l_orderkey",
)
def s4(spark, d):
    """Two steps that read the current version of one dataset by name and replace it."""
    data = IO.Snapshots(spark, scratch_path(spark, "snapshots"), "lineitem")
    data.write(table(spark, d, "lineitem"))
    total = F.round(F.sum("l_extendedprice"), 2).alias("total")
    data.write(data.read().groupBy("l_orderkey").agg(F.count("*").alias("n"), total))
    return data.read()


@query(
    "S5_positional_names",
    "SELECT c_custkey AS codigo, c_name AS entidad, c_nationkey AS lugar, c_acctbal AS valor, "
    "c_mktsegment AS dimension FROM customer",
)
def s5(spark, d):
    return IO.positional_names(table(spark, d, "customer"), ["codigo", "entidad", "lugar", "valor", "dimension"])


@query(
    "S6_literal_lookup",
    "SELECT k.code, CAST(count(*) AS BIGINT) AS n FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), "
    "('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) AS k(o_orderpriority, code) USING (o_orderpriority) "
    "GROUP BY k.code",
)
def s6(spark, d):
    rows = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]
    codes = IO.lookup(spark, rows, "o_orderpriority string, code int")
    return table(spark, d, "orders").join(codes, "o_orderpriority").groupBy("code").agg(F.count("*").alias("n"))


@query(
    "S7_missing_tokens",
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END "
    "AS o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders",
)
def s7(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return S.normalize_na(df, ("4-NOT SPECIFIED", "P", ""))


@query(
    "S8_review_extract",
    C
    + """SELECT order_id, line_no, buyer_name, supplier_name, val, round(process_value / val * 100, 6) AS process_rate
FROM c WHERE process_value / val * 100 >= 2000""",
)
def s8(spark, d):
    df = contracts(
        spark, d, ["order_id", "line_no", "buyer_name", "supplier_name", "val", "process_value", "addition"]
    )
    flagged = value_anomalies(df, "val", "process_value", "addition", process_cuts=(0, 2000))
    cols = ["order_id", "line_no", "buyer_name", "supplier_name", "val", F.round("process_rate", 6).alias("process_rate")]
    return IO.review_extract(flagged, F.col("odd_process_rate"), cols, [F.desc("val")])


# ---------------------------------------------------------------- projection and filter


@query("P1_select", "SELECT l_orderkey, l_linenumber, l_tax FROM lineitem")
def p1(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount").drop("l_discount")


@query("P2_select_matching", "SELECT l_linestatus, l_orderkey, l_partkey, l_suppkey FROM lineitem")
def p2(spark, d):
    return S.select_matching(table(spark, d, "lineitem"), "key$", "l_linestatus")


@query("P3_rename", "SELECT s_suppkey AS nit, s_name AS nombre, s_nationkey AS lugar, s_acctbal FROM supplier")
def p3(spark, d):
    return table(spark, d, "supplier").withColumnsRenamed({"s_suppkey": "nit", "s_name": "nombre", "s_nationkey": "lugar"})


@query(
    "P4_computed_columns",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) AS net, "
    "l_extendedprice * l_discount AS addition FROM lineitem",
)
def p4(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("addition"),
    )


@query(
    "P5_across",
    "SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type FROM part",
)
def p5(spark, d):
    df = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return S.across(df, ["p_name", "p_brand", "p_type"], F.upper)


@query(
    "P6_filter",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
    "WHERE (l_extendedprice > 50000 OR l_returnflag <> 'A') AND l_quantity >= 5",
)
def p6(spark, d):
    cond = ((F.col("l_extendedprice") > 50000) | (F.col("l_returnflag") != "A")) & (F.col("l_quantity") >= 5)
    return table(spark, d, "lineitem").filter(cond).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("P7_filter_in", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO')")
def p7(spark, d):
    df = table(spark, d, "part").select("p_partkey", "p_type")
    return df.filter(S.in_set(F.col("p_type"), ["ECONOMY", "PROMO"]))


@query(
    "P8_year_range",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anno FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999",
)
def p8(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("anno"))
    return df.filter(F.col("anno").between(1996, 1999))


@query("P9_filter_regex", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'ring|^hot')")
def p9(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name").filter(F.col("p_name").rlike("ring|^hot"))


@query(
    "P10_split_levels",
    """WITH r AS (SELECT r_name AS parent, CASE WHEN c_mktsegment = 'BUILDING' THEN r_name ELSE n_name END AS child,
c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
l AS (SELECT 'country' AS level, * FROM r WHERE parent = 'ASIA'
UNION ALL SELECT 'department', * FROM r WHERE parent = child AND parent <> 'ASIA'
UNION ALL SELECT 'municipality', * FROM r WHERE parent <> child OR parent = 'EUROPE')
SELECT level, parent, child, CAST(count(*) AS BIGINT) AS n, round(sum(c_acctbal), 2) AS total FROM l
GROUP BY level, parent, child""",
)
def p10(spark, d):
    customers = table(spark, d, "customer")
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    rows = customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    child = F.when(F.col("c_mktsegment") == "BUILDING", F.col("r_name")).otherwise(F.col("n_name"))
    rows = rows.select(F.col("r_name").alias("parent"), child.alias("child"), "c_acctbal")
    levels = level_of(F.col("parent"), F.col("child"), "ASIA", ["EUROPE"])
    return (
        rows.withColumn("level", F.explode(levels))
        .groupBy("level", "parent", "child")
        .agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    )


@query(
    "P11_recode_regex",
    "SELECT o_orderkey, CASE WHEN regexp_matches(lower(o_orderpriority), 'urgent|high') THEN 1 "
    "WHEN regexp_matches(lower(o_orderpriority), 'medium') THEN 2 "
    "WHEN regexp_matches(lower(o_orderpriority), 'not spec') THEN 3 END AS code FROM orders",
)
def p11(spark, d):
    rules = [("urgent|high", 1), ("medium", 2), ("not spec", 3)]
    return table(spark, d, "orders").select(
        "o_orderkey", S.recode_regex(F.lower("o_orderpriority"), rules).alias("code")
    )


@query(
    "P12_band",
    "SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'Bajo' WHEN o_totalprice < 300000 THEN 'Medio' "
    "ELSE 'Alto' END AS banda FROM orders",
)
def p12(spark, d):
    bands = S.band(F.col("o_totalprice"), [100000, 300000], ["Bajo", "Medio", "Alto"])
    return table(spark, d, "orders").select("o_orderkey", bands.alias("banda"))


@query(
    "P13_flag",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL "
    "WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS es_alto FROM lineitem",
)
def p13(spark, d):
    disc = F.when(F.col("l_returnflag") != "R", F.col("l_discount"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.flag(disc > 0.05).alias("es_alto"))


@query(
    "P14_fill_non_finite",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount = 0 THEN 0 ELSE round(l_tax / l_discount, 6) END "
    "AS rate FROM lineitem",
)
def p14(spark, d):
    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(S.r_div(F.col("l_tax"), F.col("l_discount")), 6).alias("rate")
    )
    return S.fill_non_finite(df, 0, ["rate"])


@query(
    "P15_coalesce",
    "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0), l_tax) AS rate FROM lineitem",
)
def p15(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.coalesce(F.nullif("l_discount", F.lit(0.0)), "l_tax").alias("rate")
    )


@query(
    "P16_override",
    "SELECT s_suppkey, s_name, CASE s_name WHEN 'Supplier#000000003' THEN 90 WHEN 'Supplier#000000007' THEN 91 "
    "ELSE s_nationkey END AS s_nationkey FROM supplier",
)
def p16(spark, d):
    df = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return J.override(df, [F.col("s_name")], "s_nationkey", {"Supplier#000000003": 90, "Supplier#000000007": 91})


@query(
    "P17_match_keys",
    C + "SELECT order_id, line_no, val, buyer_place = exec_place AS key1, buyer_id = supplier_id AS key2 FROM c",
)
def p17(spark, d):
    df = contracts(spark, d, ["order_id", "line_no", "val", "buyer_place", "exec_place", "buyer_id", "supplier_id"])
    marked = J.match_keys(df, [("buyer_place", "exec_place"), ("buyer_id", "supplier_id")])
    return marked.select("order_id", "line_no", "val", "key1", "key2")


# ---------------------------------------------------------------- sort, limit, sampling, set operations


@query("O1_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def o1(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey")


@query(
    "O2_top_one",
    "SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 1",
)
def o2(spark, d):
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return top_one(counts, [F.desc("n"), F.asc("o_custkey")])


_U = "CAST(CAST('0x' || substr(md5(concat_ws('|', '73', CAST({k} AS VARCHAR))), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0"


@query("O3_sample", f"SELECT c_custkey, c_name FROM customer WHERE {_U.format(k='c_custkey')} < 0.1")
def o3(spark, d):
    return sample_by_key(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_custkey"], 0.1)


@query(
    "O4_split",
    f"SELECT CASE WHEN {_U.format(k='c_custkey')} < 0.8 THEN 'train' ELSE 'test' END AS part, "
    "CAST(count(*) AS BIGINT) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1",
)
def o4(spark, d):
    train, test = split_by_key(table(spark, d, "customer"), ["c_custkey"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


@query(
    "U1_union_by_name",
    "SELECT 'buyer' AS kind, s_suppkey AS id, s_name AS name FROM supplier UNION ALL "
    "SELECT 'supplier', c_custkey, c_name FROM customer",
)
def u1(spark, d):
    buyers = table(spark, d, "supplier").select(
        F.lit("buyer").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    suppliers = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.lit("supplier").alias("kind")
    )
    return buyers.unionByName(suppliers)


@query(
    "U2_bind_columns",
    "SELECT c_custkey, c_acctbal, unnest(string_split(c_mktsegment || ';' || c_name, ';')) AS piece FROM customer",
)
def u2(spark, d):
    # row-aligned binding is unsafe on a distributed table: the columns travel through the explode
    text = F.concat_ws(";", "c_mktsegment", "c_name")
    return table(spark, d, "customer").select("c_custkey", "c_acctbal", F.explode(F.split(text, ";")).alias("piece"))
