import os
import tempfile

import pytest

from riskweave.operators import scorecard as sc
from riskweave.sources import order_risk
from riskweave.sources.order_risk import DRIVER_TABLES, prepared_order_risk
from riskweave.sources.files import ORDER_SCHEMA, read_orders, write_report_pack

from conftest import SF_SMALL


def test_csv_reader_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="rw-csv-")
    header = ",".join(f.name for f in ORDER_SCHEMA.fields)
    good = "O1,2024-01-05,Spain,PayPal,Fashion,Mobile,Direct,10,1,12.5,20.0,2,0.1,50.0,3,0,0,1,0,4.5,0,1,Fraud Risk"
    nas = "O2,2024-02-01,NA,PayPal,Fashion,Mobile,Direct,10,1,12.5,NaN,2,0.1,50.0,3,0,0,1,0,null,0,0,Normal"
    with open(f"{d}/orders.csv", "w") as fh:
        fh.write(header + "\n" + good + "\n" + nas + "\n")
    df = read_orders(spark, f"{d}/orders.csv")
    rows = {r.order_id: r for r in df.collect()}
    assert rows["O2"].country is None and rows["O2"].order_value_eur is None and rows["O2"].review_score is None
    assert str(rows["O1"].order_date) == "2024-01-05" and rows["O1"].is_fraud == 1
    assert dict(df.dtypes)["customer_age_days"] == "int"


def test_report_pack_manifest(spark):
    df = order_risk(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="rw-pack-")
    cards = sc.risk_scorecards(df)
    tables = {"Enterprise Summary": sc.enterprise_rates(df), "Monthly Trend": sc.monthly_trend(df),
              "By traffic_source with a very long sheet name": sc.scorecard_sheet(cards, "traffic_source")}
    m = {r.sheet: r.rows for r in write_report_pack(tables, out, fmt="csv").collect()}
    assert m["Enterprise Summary"] == 1 and m["Monthly Trend"] == sc.monthly_trend(df).count()
    assert "By traffic_source with a very l" in m and len("By traffic_source with a very l") == 31


CELLS = dict(zip([f.name for f in ORDER_SCHEMA.fields], (
    "O1,2024-01-05, Spain,PayPal,Fashion,Mobile,Direct,10,1,12.5,20.0,2,0.1,50.0,3,0,0,1,0,4.5,0,1,Fraud Risk").split(",")))


def _csv(cells: dict) -> str:
    path = tempfile.mkdtemp(prefix="rw-csv-") + "/orders.csv"
    with open(path, "w") as fh:
        fh.write(",".join(cells) + "\n" + ",".join(cells.values()) + "\n")
    return path


def test_csv_columns_are_found_by_name(spark):
    turned = dict(reversed(CELLS.items())) | {"extra": "x"}
    row = read_orders(spark, _csv(turned)).first()
    assert (row.country, row.payment_method, row.order_id, row.review_score) == (" Spain", "PayPal", "O1", 4.5)
    assert row.__fields__ == [f.name for f in ORDER_SCHEMA.fields]


def test_csv_missing_column_and_bad_date_raise(spark):
    with pytest.raises(ValueError, match="country"):
        read_orders(spark, _csv({k: v for k, v in CELLS.items() if k != "country"}))
    bad = _csv(CELLS | {"order_date": "2024-13-45"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_orders(spark, bad).collect()
    assert read_orders(spark, bad, on_error="null").first().order_date is None


def test_report_pack_never_overwrites_a_table(spark):
    df = spark.range(3)
    long = "a table name of well over thirty-one characters"
    with pytest.raises(ValueError, match="31"):
        write_report_pack({f"{long} 1": df, f"{long} 2": df}, tempfile.mkdtemp(prefix="rw-pack-"))
    out = tempfile.mkdtemp(prefix="rw-pack-")
    m = write_report_pack({"A B": df, "A_B": spark.range(5), "a/c": spark.range(7)}, out).collect()
    assert [spark.read.parquet(r.path).count() for r in m] == [3, 5, 7] == [r.rows for r in m]


def test_prepared_table_follows_its_input(spark):
    folder = tempfile.mkdtemp(prefix="rw-in-")
    for name in DRIVER_TABLES:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    first = prepared_order_risk(spark, folder)
    assert prepared_order_risk(spark, folder) is first
    n, old = first.count(), first.inputFiles()
    half = spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter("o_orderkey % 2 = 0")
    half.write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    assert prepared_order_risk(spark, folder).count() < n
    assert not os.path.exists(old[0].removeprefix("file://").removeprefix("file:"))
