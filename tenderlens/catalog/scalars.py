"""Scalar functions over whole columns and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.jaro import jaro_distance
from ..sources.contracts import table
from .base import query


@query("F1_case", "SELECT doc_id, lower(text) AS low, upper(lang) AS up FROM documents")
def f1(spark, d):
    return table(spark, d, "documents").select("doc_id", F.lower("text").alias("low"), F.upper("lang").alias("up"))


@query(
    "F2_regex_detect",
    "SELECT doc_id, regexp_matches(text, 'ción|ó|license') AS hit, regexp_matches(text, '[0-9]{3}') AS digits FROM documents",
)
def f2(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.col("text").rlike("ción|ó|license").alias("hit"), F.col("text").rlike("[0-9]{3}").alias("digits")
    )


@query(
    "F3_regex_remove",
    "SELECT doc_id, regexp_replace(text, '[aeiou]', '', 'g') AS no_vowels, regexp_replace(text, '[0-9]+', '') AS first_gone, "
    "regexp_replace(text, ' +', '_', 'g') AS joined FROM documents",
)
def f3(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id",
        S.remove_all(t, "[aeiou]").alias("no_vowels"),
        S.remove_first(t, "[0-9]+").alias("first_gone"),
        F.regexp_replace(t, " +", "_").alias("joined"),
    )


@query(
    "F4_nth_part",
    "SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS second, split_part(o_orderpriority, '-', 3) AS third FROM orders",
)
def f4(spark, d):
    p = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey", S.nth_part(p, "-", 2).alias("second"), S.nth_part(p, "-", 3).alias("third")
    )


@query(
    "F5_split_to_rows",
    "SELECT doc_id, CAST(count(*) AS BIGINT) AS words, CAST(count(DISTINCT w) AS BIGINT) AS distinct_words FROM "
    "(SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY doc_id",
)
def f5(spark, d):
    words = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    return words.groupBy("doc_id").agg(F.count("*").alias("words"), F.count_distinct("w").alias("distinct_words"))


@query(
    "F6_cut_before_note",
    "SELECT p_partkey, regexp_extract(p_name || ' (' || p_brand || ')', '^([^/|(]*)', 1) AS place, "
    "regexp_extract(p_type || '/' || p_name, '^([^/|(]*)', 1) AS first_option FROM part",
)
def f6(spark, d):
    noted = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    either = F.concat_ws("/", "p_type", "p_name")
    return table(spark, d, "part").select(
        "p_partkey", S.cut_before_note(noted).alias("place"), S.cut_before_note(either).alias("first_option")
    )


@query(
    "F7_split_place",
    """WITH t AS (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_type || ' - ' || p_name ELSE p_name END AS x FROM part)
SELECT p_partkey, CASE WHEN instr(x, ' - ') > 0 THEN substr(x, 1, instr(x, ' - ') - 1) END AS dept,
CASE WHEN instr(x, ' - ') > 0 THEN substr(x, instr(x, ' - ') + 3) ELSE x END AS place FROM t""",
)
def f7(spark, d):
    x = F.when(F.col("p_size") > 10, F.concat_ws(" - ", "p_type", "p_name")).otherwise(F.col("p_name"))
    df = table(spark, d, "part").select("p_partkey", x.alias("x"))
    dept, place = S.split_place(F.col("x"))
    return df.select("p_partkey", dept.alias("dept"), place.alias("place"))


@query(
    "F8_digits_letters",
    "SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits, regexp_replace(text, '[^\\p{L}]', '', 'g') AS letters "
    "FROM documents",
)
def f8(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", S.digits_only(t).alias("digits"), S.letters_only(t).alias("letters")
    )


@query(
    "F9_key_normalise",
    "SELECT doc_id, upper(regexp_replace(replace(strip_accents(text), 'ß', 'ss'), '[\\p{P}\\s]', '', 'g')) AS key, "
    "upper(strip_accents(source)) AS name FROM documents",
)
def f9(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", S.place_key(F.col("text")).alias("key"), S.name_key(F.col("source")).alias("name")
    )


@query(
    "F10_concat",
    "SELECT c_custkey, concat(c_name, '/', c_mktsegment) AS joined, concat_ws('-', c_name, "
    "coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA')) AS pasted FROM customer",
)
def f10(spark, d):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return table(spark, d, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"), S.paste("-", F.col("c_name"), seg).alias("pasted")
    )


@query(
    "F11_truncate_label",
    "SELECT doc_id, CASE WHEN length(text) > 30 THEN left(text, 27) || '...' ELSE text END AS label FROM documents",
)
def f11(spark, d):
    return table(spark, d, "documents").select("doc_id", S.truncate_label(F.col("text"), 30).alias("label"))


@query("F12_fixed_format", "SELECT o_orderkey, printf('%.2f', o_totalprice) AS amount FROM orders")
def f12(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.fixed2(F.col("o_totalprice")).alias("amount"))


@query(
    "F13_locale_number",
    "SELECT o_orderkey, o_totalprice AS amount FROM orders",
)
def f13(spark, d):
    # '1.234,50' form of the price, then back
    text = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    return table(spark, d, "orders").select("o_orderkey", S.parse_locale_number(text).alias("amount"))


@query(
    "F14_lenient_double",
    "SELECT o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS num, "
    "try_cast(split_part(o_orderpriority, '-', 2) AS DOUBLE) AS txt FROM orders",
)
def f14(spark, d):
    p = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        "o_orderkey", S.to_double(S.nth_part(p, "-", 1)).alias("num"), S.to_double(S.nth_part(p, "-", 2)).alias("txt")
    )


@query(
    "F15_scale_units",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN l_quantity * 1e6 "
    "WHEN l_returnflag <> 'R' THEN l_quantity END AS amount FROM lineitem",
)
def f15(spark, d):
    unit = F.nullif("l_returnflag", F.lit("R"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.scale_units(F.col("l_quantity"), unit, {"A": 1e6}).alias("amount")
    )


@query(
    "F16_parse_date",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, CAST(year(o_orderdate) AS INTEGER) AS anno, "
    "CAST(NULL AS DATE) AS bad FROM orders",
)
def f16(spark, d):
    text = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    fecha = S.parse_ymd(text)
    return table(spark, d, "orders").select(
        "o_orderkey", fecha.alias("fecha"), F.year(fecha).alias("anno"), S.parse_ymd(F.col("o_orderpriority")).alias("bad")
    )


@query(
    "F17_terms",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linestatus = 'O' AND l_quantity < 40 THEN l_quantity * 30 "
    "ELSE l_quantity END AS plazo, l_quantity + l_linenumber * 30 AS adiciones FROM lineitem",
)
def f17(spark, d):
    unit = F.when(F.col("l_linestatus") == "O", "M").otherwise("D")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        S.term_days(F.col("l_quantity"), unit, month_limit=40).alias("plazo"),
        S.extension_days(F.col("l_quantity"), F.col("l_linenumber")).alias("adiciones"),
    )


@query("F18_modulo", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity % 10 = 0 AND l_quantity > 0 AS redondo FROM lineitem")
def f18(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.is_multiple_of(F.col("l_quantity"), 10).alias("redondo")
    )


@query(
    "F19_numeric",
    "SELECT o_orderkey, round_even(o_totalprice / 8, 0) AS even, round(log10(o_totalprice), 9) AS lg, "
    "round(sqrt(o_totalprice), 9) AS root, round(pow(o_totalprice / 1000, 2), 6) AS sq FROM orders",
)
def f19(spark, d):
    p = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey",
        S.round_even(p / 8, 0).alias("even"),
        F.round(S.log10_positive(p), 9).alias("lg"),
        F.round(F.sqrt(p), 9).alias("root"),
        F.round(F.pow(p / 1000, F.lit(2.0)), 6).alias("sq"),
    )


@query(
    "F20_row_mean",
    "SELECT l_orderkey, l_linenumber, l_partkey, round((l_discount + l_tax + nullif(l_quantity, 10)) / 3, 9) AS m FROM lineitem",
)
def f20(spark, d):
    cols = [F.col("l_discount"), F.col("l_tax"), F.nullif("l_quantity", F.lit(10.0))]
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(S.row_mean(cols), 9).alias("m"))


@query(
    "F21_prefix_by_category",
    "SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'abs - ' || p_name WHEN 'SMALL' THEN 'ppa - ' || p_name ELSE p_name END "
    "AS indicador FROM part",
)
def f21(spark, d):
    prefixes = {"PROMO": "abs - ", "SMALL": "ppa - "}
    return table(spark, d, "part").select(
        "p_partkey", S.prefix_by(F.col("p_name"), F.col("p_type"), prefixes).alias("indicador")
    )


@query(
    "F22_jaro_distance",
    "SELECT p_partkey, round(1 - jaro_similarity(p_name, reverse(p_brand) || p_type), 9) AS far, "
    "round(1 - jaro_similarity(p_name, replace(p_name, 'l', 'll')), 9) AS near FROM part",
)
def f22(spark, d):
    other = F.concat(F.reverse("p_brand"), "p_type")
    return table(spark, d, "part").select(
        "p_partkey",
        F.round(jaro_distance(F.col("p_name"), other), 9).alias("far"),
        F.round(jaro_distance(F.col("p_name"), F.replace("p_name", F.lit("l"), F.lit("ll"))), 9).alias("near"),
    )
