"""Inferred types, rejected cells, and packs that are whole or not there."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources.checked import infer_types, read_checked, read_inferred
from riskweave.sources.pack import ReportPack


def csv(tmp_path, *lines, name="t.csv"):
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_types_are_the_narrowest_that_all_cells_have(spark, tmp_path):
    path = csv(tmp_path, "a,b,c,d,e,f,g,h,i", "1,1,2024-01-05,x,True,NA,1,1d,1e3", "-2,2.5,2023-12-31,1,false,,99999999999999999999,2,.5",
               "+3,NaN,null,,TRUE,nan,3,3,inf")
    df = read_inferred(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "date", "d": "string", "e": "boolean", "f": "double",
                               "g": "double", "h": "string", "i": "double"}
    rows = df.collect()
    assert [r.a for r in rows] == [1, -2, 3] and [r.b for r in rows] == [1.0, 2.5, None]
    assert rows[0].c == dt.date(2024, 1, 5) and rows[2].c is None and rows[2].d is None and [r.e for r in rows] == [True, False, True]
    assert rows[1].g == 1e20 and rows[2].i == float("inf") and all(r.f is None for r in rows)


def test_a_bad_cell_in_the_last_of_many_rows_counts(spark, tmp_path):
    many = [f"{i},2024-01-01" for i in range(30_000)]
    assert dict(read_inferred(spark, csv(tmp_path, "n,d", *many)).dtypes) == {"n": "bigint", "d": "date"}
    late = read_inferred(spark, csv(tmp_path, "n,d", *many, "30000,2024-02-30", name="late.csv"))
    assert dict(late.dtypes) == {"n": "bigint", "d": "string"} and late.count() == 30_001
    late = read_inferred(spark, csv(tmp_path, "n,d", *many, "1.5,2024-02-03", name="wide.csv"))
    assert dict(late.dtypes) == {"n": "double", "d": "date"}


def test_types_come_from_one_pass_without_an_exchange_of_rows(spark):
    cells = spark.createDataFrame([("1", "x")] * 50, "a string, b string").repartition(4)
    assert infer_types(cells) == T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert infer_types(cells.filter("false")).fields[0].dataType == T.DoubleType()


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("v", T.DoubleType()),
                       T.StructField("name", T.StringType())])


def test_rejected_cells_are_kept_with_their_reason(spark, tmp_path):
    path = csv(tmp_path, "name,id,day,v,more", "ann,1,2024-01-01,1.5,x", "bob,2,2024-13-01,oops,x", "cy,3,NA,2,x", ",4,2024-01-02,NaN,x",
               "eve,5,2024-01-03", "dan,x6,2024-01-04,7,x")
    got = read_checked(spark, path, SCHEMA, "id", required=["name"])
    assert (got.total, got.bad) == (6, 4)
    assert sorted(tuple(r) for r in got.rows.collect()) == [(1, dt.date(2024, 1, 1), 1.5, "ann"), (3, None, 2.0, "cy")]
    cells = sorted((r["key"], r["column"], r["cell"], r["reason"]) for r in got.rejected.select("key", "column", F.coalesce("cell", F.lit("-")).alias("cell"), "reason").collect())
    assert cells == [("2", "day", "2024-13-01", "not of type date"), ("2", "v", "oops", "not of type double"),
                     ("4", "name", "-", "missing"), ("5", "", "eve,5,2024-01-03", "wrong number of cells"),
                     ("x6", "id", "x6", "not of type bigint")]
    assert got.rejected.select("row").distinct().count() == 4
    log = {r["check"]: r["value"] for r in got.log().collect()}
    assert log["total_records"] == "6" and log["rejected_records"] == "4" and log["rejected_cells"] == "5" and log["rejected_cells: v"] == "1"


def test_clean_and_empty_files(spark, tmp_path):
    got = read_checked(spark, csv(tmp_path, "id,day,v,name", "1,2024-01-01,1,a"), SCHEMA, "id")
    assert (got.total, got.bad, got.rejected.count()) == (1, 0, 0)
    got = read_checked(spark, csv(tmp_path, "id,day,v,name", name="none.csv"), SCHEMA, "id")
    assert (got.total, got.bad, got.rows.count()) == (0, 0, 0)
    with pytest.raises(ValueError, match="day"):
        read_checked(spark, csv(tmp_path, "id,v,name", "1,1,a", name="less.csv"), SCHEMA, "id")


def failing(spark):
    return spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_table_leaves_the_old_pack(spark, tmp_path, fmt):
    pack = ReportPack(spark, str(tmp_path / "pack"), fmt)
    with pytest.raises(FileNotFoundError):
        pack.manifest()
    assert pack.write({"a b": spark.range(3), "c": spark.range(1)}) == 1
    with pytest.raises(Exception, match="broken"):
        pack.write({"a b": spark.range(9), "c": failing(spark)})
    assert pack.versions() == [1] and pack.read("a b").count() == 3
    assert pack.write({"a b": spark.range(5), "d": spark.range(2).selectExpr("id", "'x' AS t")}) == 2
    assert pack.read("a b").count() == 5 and pack.read("a b", 1).count() == 3
    assert sorted(map(tuple, pack.read("d").collect())) == [(0, "x"), (1, "x")]
    rows = {r["name"]: (r["version"], r["rows"], r["columns"]) for r in pack.manifest().collect()}
    assert rows == {"a b": (2, 5, ["id"]), "d": (2, 2, ["id", "t"])}
    with pytest.raises(KeyError):
        pack.read("c")
    folders = [p for p in (tmp_path / "pack" / "_versions").iterdir()]
    assert len(folders) == 2  # nothing is left of the failed write
    assert pack.vacuum(1) == [1] and pack.versions() == [2] and pack.read("a b").count() == 5
    with pytest.raises(FileNotFoundError):
        pack.read("a b", 1)


def test_two_writers_take_two_versions(spark, tmp_path):
    got = []
    packs = [ReportPack(spark, str(tmp_path / "pack")) for _ in range(4)]
    threads = [threading.Thread(target=lambda p=p, i=i: got.append((p.write({"t": spark.range(i + 1)}), i + 1))) for i, p in enumerate(packs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v for v, _ in got) == packs[0].versions() and len(set(v for v, _ in got)) == 4
    for version, n in got:
        assert packs[0].read("t", version).count() == n


def test_labels_that_would_be_the_same_are_refused(spark, tmp_path):
    long = "a table name of well over thirty-one characters"
    with pytest.raises(ValueError, match="31"):
        ReportPack(spark, str(tmp_path)).write({f"{long} 1": spark.range(1), f"{long} 2": spark.range(1)})
