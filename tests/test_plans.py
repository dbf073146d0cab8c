"""Plan-shape checks: the properties the design relies on at scale."""

import contextlib
import io

from riskweave.operators import basket as mb
from riskweave.operators import evaluate as ev
from riskweave.operators import forecast as fc
from riskweave.operators import model as ml
from riskweave.operators import profile as pf
from riskweave.operators import scorecard as sc
from riskweave.sources import order_risk
from riskweave.sources.order_risk import prepared_order_risk

from conftest import SF_SMALL


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_mapping_prunes_columns_and_pushes_filters(spark):
    plan = _plan(order_risk(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error), IsNotNull(user_id)]" in plan
    # only the six needed lineitem columns are read
    assert ("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_quantity:double,"
            "l_discount:double,l_returnflag:string>") in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_customer_history_never_windows_by_customer_alone(spark):
    plan = _plan(order_risk(spark, SF_SMALL), "simple")
    # row-level ranking is partitioned by (customer, day); the customer-wide
    # window runs only on the per-(customer, day) aggregate
    assert "Window [row_number() windowspecdefinition(o_custkey" in plan
    assert "windowspecdefinition(o_custkey#" in plan
    assert "order_date" in plan.split("Window [row_number()")[1].split("]")[0]


def test_scorecards_one_aggregation_over_expand(spark):
    plan = _plan(sc.risk_scorecards(order_risk(spark, SF_SMALL)), "simple")
    assert "Expand" in plan
    # one grouping-sets aggregate (partial + final) feeding the report
    assert plan.count("spark_grouping_id") >= 2


def test_breach_threshold_is_a_scalar_subquery_not_a_join(spark):
    df = order_risk(spark, SF_SMALL)
    plan = _plan(sc.breach_log(sc.risk_scorecards(df), df), "simple")
    assert "Subquery" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_profile_and_rules_have_no_cartesian_products(spark):
    df = order_risk(spark, SF_SMALL)
    for q in [pf.iqr_outliers(df), pf.numeric_summary(df), pf.histogram(df),
              mb.association_rules(mb.frequent_itemsets(mb.order_items(df)), 1.0)]:
        plan = _plan(q, "simple")
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_reports_read_only_their_columns_of_the_prepared_table(spark):
    orders = prepared_order_risk(spark, SF_SMALL)
    plan = _plan(sc.enterprise_rates(orders))
    assert "ReadSchema: struct<is_returned:int,is_fraud:int,risk_label:string>" in plan
    assert "ExistingRDD" not in plan
    plan = _plan(orders.filter("country = 'FRANCE' and quantity > 5").select("order_id"))
    assert "EqualTo(country,FRANCE)" in plan and "GreaterThan(quantity,5)" in plan


def test_forecasts_scan_once_and_never_cross(spark):
    series = fc.monthly_series(prepared_order_risk(spark, SF_SMALL))
    plan = _plan(fc.forecast_table(series), "simple")
    assert plan.count("FileScan parquet") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Join" not in plan


def test_codes_and_weights_exchange_no_rows(spark):
    orders = prepared_order_risk(spark, SF_SMALL)
    plan = _plan(ml.label_encode(orders), "simple")
    assert "Exchange" not in plan and "Join" not in plan
    plan = _plan(ev.with_class_weights(orders, "risk_label"), "simple")
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_quantiles_never_exchange_by_value_alone(spark):
    plan = _plan(pf.numeric_summary(prepared_order_risk(spark, SF_SMALL)), "simple")
    # only what lies in a band is exchanged: below it values are one NULL
    assert "CASE WHEN" in plan and "hashpartitioning(column#" in plan
    assert "BroadcastHashJoin" in plan
