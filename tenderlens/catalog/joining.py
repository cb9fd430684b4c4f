"""Joins, fuzzy joins and window-style operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import joins as J
from ..operators import windows as Wn
from ..operators.fuzzy import fuzzy_join
from ..sources.contracts import contracts, table
from .base import C, query, rounded


@query(
    "J1_left_join",
    "SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey",
)
def j1(spark, d):
    right = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return J.left_join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), right, "o_custkey")


_J2 = """WITH l AS (SELECT l_orderkey, l_partkey, nullif(l_returnflag, 'R') AS flag, nullif(l_linestatus, 'O') AS status FROM lineitem),
k AS (SELECT nullif(l_returnflag, 'R') AS flag, nullif(l_linestatus, 'O') AS status, CAST(count(*) AS BIGINT) AS n
      FROM lineitem WHERE l_quantity > 25 GROUP BY 1, 2)"""


@query(
    "J2_null_safe_join",
    _J2
    + " SELECT l.l_orderkey, l.l_partkey, l.flag, l.status, k.n FROM l LEFT JOIN k "
    "ON l.flag IS NOT DISTINCT FROM k.flag AND l.status IS NOT DISTINCT FROM k.status",
)
def j2(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        F.nullif("l_returnflag", F.lit("R")).alias("flag"),
        F.nullif("l_linestatus", F.lit("O")).alias("status"),
    )
    k = li.filter("l_quantity > 25").groupBy("flag", "status").agg(F.count("*").alias("n"))
    return J.join_null_safe(li.drop("l_quantity"), k, ["flag", "status"])


@query(
    "J3_natural_join",
    "SELECT a.n_nationkey, a.n_regionkey, a.n_name, c.c_custkey FROM nation a JOIN "
    "(SELECT c_custkey, c_nationkey AS n_nationkey, CAST(c_nationkey % 5 AS INTEGER) AS n_regionkey FROM customer) c "
    "ON a.n_nationkey = c.n_nationkey AND a.n_regionkey = c.n_regionkey",
)
def j3(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey"), (F.col("c_nationkey") % 5).alias("n_regionkey")
    )
    return J.natural_join(table(spark, d, "nation"), c)


@query("J4_inner_join", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def j4(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return table(spark, d, "supplier").join(n, "s_nationkey", "inner").select("s_suppkey", "n_name")


_BUSY = "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 12"


def _busy(spark, d):
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 12")
    return counts.select(F.col("o_custkey").alias("c_custkey"))


@query("J5_semi_join", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({_BUSY})")
def j5(spark, d):
    return J.keep_in(table(spark, d, "customer").select("c_custkey", "c_name"), _busy(spark, d), "c_custkey")


@query("J6_anti_join", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ({_BUSY})")
def j6(spark, d):
    return J.keep_out(table(spark, d, "customer").select("c_custkey", "c_name"), _busy(spark, d), "c_custkey")


@query(
    "J7_apply_corrections",
    """WITH f AS (SELECT l_orderkey, max(l_extendedprice) AS real FROM lineitem GROUP BY l_orderkey HAVING count(*) = 2)
SELECT o_orderkey, CASE WHEN f.real IS NOT NULL THEN f.real ELSE o_totalprice END AS o_totalprice,
CASE WHEN f.real IS NOT NULL THEN f.real + 100 ELSE 0 END AS total FROM orders LEFT JOIN f ON o_orderkey = f.l_orderkey""",
)
def j7(spark, d):
    fixes = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_extendedprice").alias("real"), F.count("*").alias("n")
    )
    fixes = fixes.filter("n = 2").select(F.col("l_orderkey").alias("o_orderkey"), "real")
    df = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.lit(0.0).alias("total"))
    return J.apply_corrections(
        df, fixes, "o_orderkey", {"o_totalprice": "real"}, derive={"total": F.col("o_totalprice") + 100}
    )


@query(
    "J8_fuzzy_join",
    """WITH a AS (SELECT DISTINCT p_name AS x FROM part), b AS (SELECT DISTINCT replace(p_name, 'l', 'll') AS y FROM part)
SELECT x, y, round(1 - jaro_similarity(x, y), 9) AS dist FROM a, b WHERE 1 - jaro_similarity(x, y) <= 0.10""",
)
def j8(spark, d):
    part = table(spark, d, "part")
    a = part.select(F.col("p_name").alias("x")).distinct()
    b = part.select(F.replace("p_name", F.lit("l"), F.lit("ll")).alias("y")).distinct()
    found = fuzzy_join(a, b, [("x", "y")], 0.10, "inner", "dist")
    return rounded(found.select("x", "y", "dist"), dist=9)


_WORDS = r"SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS "


@query(
    "J8_fuzzy_words",
    f"""WITH a AS ({_WORDS} x FROM benchmark), b AS ({_WORDS} y FROM documents)
SELECT x, y, round(1 - jaro_similarity(x, y), 9) AS dist FROM a, b WHERE x <> '' AND y <> '' AND 1 - jaro_similarity(x, y) <= 0.10""",
)
def j8_words(spark, d):
    """Spellings near the benchmark's words among all words of the documents: tens of thousands of distinct texts."""

    def words(name, c):
        df = table(spark, d, name).select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias(c))
        return df.where(F.col(c) != "").distinct()

    found = fuzzy_join(words("benchmark", "x"), words("documents", "y"), [("x", "y")], 0.10, "inner", "dist")
    return rounded(found.select("x", "y", "dist"), dist=9)


_J9 = """WITH a AS (SELECT DISTINCT p_type || p_type AS dx, replace(p_name, 'i', 'ee') AS px FROM part),
b AS (SELECT p_type || p_type AS dy, p_name AS py, CAST(min(p_partkey) AS BIGINT) AS code FROM part GROUP BY 1, 2),
m AS (SELECT dx, px, dy, py, code, 1 - jaro_similarity(px, py) AS d1, 1 - jaro_similarity(dx, dy) AS d2 FROM a, b
      WHERE 1 - jaro_similarity(px, py) <= 0.2 AND 1 - jaro_similarity(dx, dy) <= 0.2)"""


def _j9(spark, d):
    part = table(spark, d, "part")
    a = part.select(
        F.concat("p_type", "p_type").alias("dx"), F.replace("p_name", F.lit("i"), F.lit("ee")).alias("px")
    ).distinct()
    b = part.groupBy(F.concat("p_type", "p_type").alias("dy"), F.col("p_name").alias("py")).agg(
        F.min("p_partkey").alias("code")
    )
    return fuzzy_join(a, b, [("px", "py"), ("dx", "dy")], 0.2, "left", "result")


@query(
    "J9_fuzzy_left_join",
    _J9
    + " SELECT a.dx, a.px, m.dy, m.py, m.code, round((m.d1 + m.d2) / 2, 9) AS result FROM a LEFT JOIN m USING (dx, px)",
)
def j9(spark, d):
    return rounded(_j9(spark, d).select("dx", "px", "dy", "py", "code", "result"), result=9)


@query(
    "J10_best_match",
    _J9
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY dx, px ORDER BY round((d1 + d2) / 2, 12), code) AS rn FROM m)
SELECT a.dx, a.px, r.code, round((r.d1 + r.d2) / 2, 9) AS result FROM a LEFT JOIN r ON a.dx = r.dx AND a.px = r.px AND r.rn = 1""",
)
def j10(spark, d):
    found = _j9(spark, d).withColumn("result", F.round("result", 12))
    best = J.best_match(found, ["dx", "px"], "result", tie=["code"])
    return rounded(best.select("dx", "px", "code", "result"), result=9)


_Y = """WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS anno, CAST(count(*) AS BIGINT) AS n,
sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)"""


def _yearly(spark, d):
    df = table(spark, d, "orders").select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("anno"))
    return df.groupBy("o_custkey", "anno").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("v"))


@query(
    "J11_prior_period",
    _Y
    + " SELECT a.o_custkey, a.anno, a.n, round(a.v, 2) AS v, b.n AS n1, round(b.v, 2) AS v1 FROM y a JOIN y b "
    "ON a.o_custkey = b.o_custkey AND a.anno = b.anno + 1",
)
def j11(spark, d):
    return rounded(J.prior_period(_yearly(spark, d), ["o_custkey"], "anno", ["n", "v"]), v=2, v1=2)


@query(
    "J12_map_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END AS o_orderstatus FROM orders",
)
def j12(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return J.map_values(df, "o_orderstatus", {"F": "final", "O": "open"})


# ---------------------------------------------------------------- windows

_PAIR = C + ", p AS (SELECT supplier_id, buyer_id, CAST(count(*) AS BIGINT) AS n, sum(val) AS v FROM c GROUP BY 1, 2)"


def _pairs(spark, d):
    df = contracts(spark, d, ["supplier_id", "buyer_id", "val"])
    return df.groupBy("supplier_id", "buyer_id").agg(F.count("*").alias("n"), F.sum("val").alias("v"))


@query(
    "W1_share_of_total",
    _PAIR + " SELECT supplier_id, buyer_id, round(v / sum(v) OVER (PARTITION BY supplier_id), 9) AS share FROM p",
)
def w1(spark, d):
    out = Wn.share_of_total(_pairs(spark, d), ["supplier_id"], "v")
    return rounded(out.select("supplier_id", "buyer_id", "share"), share=9)


@query(
    "W2_group_size",
    "SELECT o_orderkey, CAST(count(*) OVER (PARTITION BY o_custkey) AS BIGINT) AS n FROM orders",
)
def w2(spark, d):
    return Wn.group_size(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"]).drop("o_custkey")


_W3 = """WITH x AS (SELECT l_orderkey, l_partkey, l_suppkey, nullif(l_linenumber, 7) AS k FROM lineitem),
g AS (SELECT l_suppkey, CAST(count(DISTINCT k) + max(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n FROM x GROUP BY 1)"""


@query("W3_distinct_over", _W3 + " SELECT l_orderkey, l_partkey, l_suppkey, n FROM x JOIN g USING (l_suppkey)")
def w3(spark, d):
    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.nullif("l_linenumber", F.lit(7)).alias("k")
    )
    return Wn.n_distinct_over(df, ["l_suppkey"], "k", "n").drop("k")


@query(
    "W4_head_per_group",
    _PAIR
    + ", r AS (SELECT *, row_number() OVER (PARTITION BY buyer_id ORDER BY n DESC, supplier_id) AS rn FROM p) "
    "SELECT buyer_id, supplier_id, n FROM r WHERE rn <= 4",
)
def w4(spark, d):
    out = Wn.head_per_group(_pairs(spark, d), ["buyer_id"], [F.desc("n"), F.asc("supplier_id")], 4)
    return out.select("buyer_id", "supplier_id", "n")


@query(
    "W5_slice_max",
    _PAIR
    + ", r AS (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY n DESC, buyer_id) AS rn FROM p) "
    "SELECT supplier_id, buyer_id, n FROM r WHERE rn = 1",
)
def w5(spark, d):
    pairs = _pairs(spark, d).select("supplier_id", "buyer_id", "n")
    return Wn.slice_max(pairs, ["supplier_id"], "n", ["buyer_id"])


@query(
    "W6_slice_min",
    _PAIR
    + ", r AS (SELECT *, rank() OVER (PARTITION BY supplier_id ORDER BY n) AS rn FROM p) "
    "SELECT supplier_id, buyer_id, n FROM r WHERE rn = 1",
)
def w6(spark, d):
    pairs = _pairs(spark, d).select("supplier_id", "buyer_id", "n")
    return Wn.slice_min(pairs, ["supplier_id"], "n")


@query(
    "W7_row_id",
    "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS row_id FROM orders",
)
def w7(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return Wn.with_row_id(df, [F.desc("o_totalprice"), F.asc("o_orderkey")]).drop("o_totalprice")


_Z = "(l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER ()"


@query(
    "W8_zscore",
    f"SELECT l_orderkey, l_linenumber, l_partkey, round({_Z}, 6) AS z FROM lineitem",
)
def w8(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    out = Wn.zscore(df, ["l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice_z", 6).alias("z"))


@query(
    "W8_outliers",
    "SELECT o_orderkey, n FROM (SELECT *, (n - avg(n) OVER ()) / stddev_samp(n) OVER () AS z FROM "
    "(SELECT l_orderkey AS o_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1)) WHERE z > 3 OR z < -3",
)
def w8b(spark, d):
    counts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return Wn.outliers_z(counts, "n").drop("n_z")


@query(
    "W9_rate_of_change",
    _Y
    + " SELECT a.o_custkey, a.anno, round(round_even(a.n / b.n - 1, 4) * 100, 6) AS n_r, round((a.v / b.v - 1) * 100, 6) AS v_r "
    "FROM y a JOIN y b ON a.o_custkey = b.o_custkey AND a.anno = b.anno + 1",
)
def w9(spark, d):
    y = _yearly(spark, d)
    n = Wn.rate_of_change(y, ["o_custkey"], "anno", ["n"])
    v = Wn.rate_of_change(y, ["o_custkey"], "anno", ["v"], digits=None)
    return rounded(n.join(v, ["o_custkey", "anno"]), n_r=6, v_r=6)


@query(
    "W10_persistent_flag",
    """WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS anno,
max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) AS b FROM orders GROUP BY 1, 2)
SELECT a.o_custkey, a.anno, CASE WHEN a.b = 1 AND b.b = 1 THEN 1 ELSE 0 END AS r FROM y a JOIN y b
ON a.o_custkey = b.o_custkey AND a.anno = b.anno + 1""",
)
def w10(spark, d):
    closed = S.flag(F.col("o_orderpriority") == "4-NOT SPECIFIED")
    y = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("anno")).agg(F.max(closed).alias("b"))
    return Wn.persistent_flag(y, ["o_custkey"], "anno", {"b": "r"})
