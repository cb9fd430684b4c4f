"""Delimited scans with broken records, snapshots with a current version, deep hierarchies."""

from __future__ import annotations

import gzip

import pytest
from frames import rows
from pyspark.sql import functions as F

from tenderlens.plans.panel import hierarchy_paths
from tenderlens.sources import files as IO

SCHEMA = "id int, name string, v double, d date"
TEXT = '''id;name;v;d
1;"one
two";1.5;2020-01-31
2;"semi;colon ""quoted""";NA;
bad;x;1;2020-01-01
3;short
4;y;1;2020-01-01;more
5;NA;12D;2020-13-01
 6 ;;-2e3;2020-02-29
'''


@pytest.fixture(params=["plain.csv", "packed.csv.gz"])
def path(request, tmp_path):
    file = tmp_path / request.param
    file.write_bytes(gzip.compress(TEXT.encode()) if file.suffix == ".gz" else TEXT.encode())
    return str(file)


def test_rows_are_whole_and_bad_records_apart(spark, path):
    scan = IO.scan_delimited(spark, path, SCHEMA)
    got = rows(scan.rows.withColumn("d", F.col("d").cast("string")))
    assert got == [(1, "one\ntwo", 1.5, "2020-01-31"), (2, 'semi;colon "quoted"', None, None), (6, None, -2000.0, "2020-02-29")]
    assert rows(scan.report()) == [("no value of its type: id", 1), ("no value of its type: v, d", 1), ("number of fields", 2)]
    assert {r["record"].split(";")[0] for r in scan.rejected.collect()} == {"bad", "3", "4", "5"}
    # a subset of columns rejects the same records
    some = IO.scan_delimited(spark, path, SCHEMA, columns=["name"])
    assert some.rows.count() == 3 and some.rejected.count() == 4 and some.rows.columns == ["name"]
    assert IO.read_delimited(spark, path, SCHEMA, rejected="drop").count() == 3
    with pytest.raises(Exception, match="bad record"):
        IO.read_delimited(spark, path, SCHEMA).collect()


def test_written_tables_come_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a;"b"\nc', 0.1, None), (2, None, None, "x"), (3, " y ", 1e300, "é")], "i int, s string, v double, t string")
    for sep in (";", ","):
        path = IO.write_table(df, str(tmp_path / f"t{ord(sep)}"), "csv", sep=sep)
        assert rows(IO.read_delimited(spark, path, df.schema, sep=sep)) == rows(df)


def test_snapshots(spark, tmp_path, monkeypatch):
    data = IO.Snapshots(spark, str(tmp_path), "steps")
    with pytest.raises(ValueError, match="no version"):
        data.read()
    assert data.write(spark.range(5)) == 1
    # a step reads the current version and replaces it
    assert data.write(data.read().where("id > 2")) == 2 and data.read().count() == 2 and data.read(1).count() == 5
    # a step that fails between its rows and the switch changes nothing
    with monkeypatch.context() as m:
        m.setattr(IO.Snapshots, "_switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            data.write(spark.range(100))
    again = IO.Snapshots(spark, str(tmp_path), "steps")
    assert again.current() == 2 and again.read().count() == 2
    assert len(list((tmp_path / "steps").glob("data-*"))) == 3
    # of two writers one gets an error
    with monkeypatch.context() as m:
        m.setattr(IO.Snapshots, "current", lambda self: 1)
        with pytest.raises(Exception, match="exists"):
            data.write(spark.range(9))
    assert data.restore(1) == 3 and data.read().count() == 5
    data.remove_old()
    assert data.versions() == [3] and data.read().count() == 5 and len(list((tmp_path / "steps").glob("data-*"))) == 1
    with pytest.raises(ValueError, match="no version 2"):
        data.read(2)


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    from tenderlens.plans import panel

    made = []
    monkeypatch.setattr(panel, "cut_lineage", lambda df, f=panel.cut_lineage: made.append(1) or f(df))
    chain = spark.range(1000).select(F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("p"), F.col("id").cast("string").alias("n"), F.concat(F.lit("l"), F.col("id").cast("string")).alias("l"))
    got = hierarchy_paths(chain, "p", "n", "l")
    last = got.where("depth = 999").first()
    assert got.count() == 1000 and last["node"] == "999" and last["root"] == "0"
    assert last["path"] == " > ".join(f"l{i}" for i in range(1000)) and len(made) <= 11


def test_several_parents_and_lost_ancestors(spark):
    df = spark.createDataFrame([(None, "a", "A"), ("", "b", "B"), ("a", "c", "C"), ("b", "c", "C"), ("c", "d", "D"), ("gone", "x", "X"), ("x", "y", "Y")], "p string, i string, l string")
    got = rows(hierarchy_paths(df, "p", "i", "l"), "node", "root", "depth", "path")
    assert got == [("a", "a", 0, "A"), ("b", "b", 0, "B"), ("c", "a", 1, "A > C"), ("c", "b", 1, "B > C"), ("d", "a", 2, "A > C > D"), ("d", "b", 2, "B > C > D")]
