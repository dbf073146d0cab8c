import tempfile

from riskweave.plans.reports import eda_report, risk_report
from riskweave.sources import order_risk
from riskweave.sources.files import write_report_pack

from conftest import SF_SMALL


def test_risk_and_eda_reports_build_and_write(spark):
    orders = order_risk(spark, SF_SMALL)
    risk = risk_report(orders)
    assert {"Enterprise Summary", "Monthly Trend", "Appetite Breaches", "By country"} <= set(risk)
    counts = {name: df.count() for name, df in risk.items()}
    assert counts["Enterprise Summary"] == 1 and counts["Validation Log"] == 6
    assert counts["Correlation"] == 196
    eda = eda_report(orders)
    ecounts = {name: df.count() for name, df in eda.items()}
    assert ecounts["Numeric Summary"] == 9 and ecounts["Outliers"] == 3 and ecounts["Forecast"] == 3
    assert ecounts["Fraud Rules"] > 0 and ecounts["Return Rules"] > 0
    out = tempfile.mkdtemp(prefix="rw-riskpack-")
    manifest = {r.sheet: r.rows for r in write_report_pack(risk, out).collect()}
    assert manifest == {k[:31]: v for k, v in counts.items()}
