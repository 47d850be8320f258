from datetime import date

import pytest

from monthgrain.plans import balance
from tests.conftest import rows

NUMBERS = [*balance.BALANCES]
SCHEMA = "cifno string, snapshot_date string, mxdt string, mndt string, " + ", ".join(
    f"{c} double" for c in NUMBERS
)


def summary(spark, *months):
    """Rows of (customer, month, average, highest, lowest); other balances are 1."""
    data = []
    for c, m, avg, mx, mn in months:
        value = {"avg": avg, "mx": mx, "mn": mn}
        data.append((c, m, "2001-06-03", "2001-06-25", *[value.get(n, 1.0) for n in NUMBERS]))
    return spark.createDataFrame(data, SCHEMA)


def test_window_and_momentum(spark):
    df = summary(
        spark,
        ("a", "200106", 30.0, 50.0, 5.0),
        ("a", "200105", 20.0, 60.0, 4.0),
        ("a", "200102", None, 70.0, None),
        ("b", "200106", None, None, None),
        ("c", "200106", 5.0, 6.0, 4.0),
        ("c", "200105", 0.0, 6.0, 4.0),
    )
    out = balance.balance_window(df, "200106")
    a, b, c = out.orderBy("cifno").collect()
    assert (a.max_bal_3mth, a.max_bal_6mth, a.min_bal_6mth) == (60.0, 70.0, 4.0)
    assert (a.avg_bal_3mth, a.avg_bal_6mth) == (25.0, 25.0)
    assert (a["delta_avg_bal_t1-2"], a["ratio_avg_bal_t1-2"]) == (10.0, 0.5)
    assert a["delta_avg_bal_t2-3"] is None
    assert (b.max_bal_6mth, b.avg_bal_6mth, b.avg) == (None, 0.0, None)
    assert (c["delta_avg_bal_t1-2"], c["ratio_avg_bal_t1-2"]) == (5.0, None)
    assert (a.weekday_mxdt, a.mxdt_range, a.mndt_range, a.delta_days) == ("Sunday", 1, 3, -22)
    assert a.delta_max_min_bal == 45.0


def test_dates_may_be_dates_already(spark):
    df = summary(spark, ("a", "200106", 1.0, 1.0, 1.0)).selectExpr("* except (mxdt)", "date'2001-07-02' AS mxdt")
    out = balance.clean_balances(df)
    assert rows(out, "mxdt", "mxdt_range", "weekday_mxdt") == [(None, -1, None)]
    assert rows(out, "mndt", "delta_days") == [(date(2001, 6, 25), None)]


def test_output_columns(spark):
    out = balance.balance_window(summary(spark), "200106")
    assert not [c for c in out.columns if "lag" in c]
    assert balance.loan_targets(out.columns) == [
        "avg",
        "mx",
        "mn",
        "eom",
        "max_bal_3mth",
        "avg_bal_3mth",
        "max_bal_6mth",
        "avg_bal_6mth",
        "delta_avg_bal_t1-2",
        "delta_avg_bal_t2-3",
    ]


@pytest.fixture
def loans(spark):
    return spark.createDataFrame(
        [("a", "200106", 8.0), ("b", "200105", 9.0)],
        "cifno string, snapshot_date string, loan_to_debit double",
    )


def test_loan_deduction_by_month(spark, loans):
    window = balance.balance_window(
        summary(spark, ("a", "200106", 30.0, 50.0, 5.0), ("b", "200106", None, 2.0, 1.0)), "200106"
    )
    out = balance.balance_loan(window, loans)
    assert rows(out, "cifno", "avg", "avg_loan", "mx_loan", "delta_avg_bal_t1-2_loan") == [
        ("a", 30.0, 22.0, 42.0, -8.0),
        ("b", 0.0, 0.0, 2.0, 0.0),
    ]
    assert "loan_to_debit" not in out.columns
    assert "weekday_mxdt_loan" not in out.columns
    only = balance.balance_loan(window, loans, targets=["eom"])
    assert [c for c in only.columns if c.endswith("_loan")] == ["eom_loan"]


def test_daily_levels(spark, loans):
    df = spark.createDataFrame(
        [("a", "200106", 10.0, None, 3.0), ("a", "200105", 1.0, 1.0, 1.0)],
        "cifno string, snapshot_date string, avgd double, mnd double, eomd double",
    )
    out = balance.balance_deduct(df, loans, "200106")
    assert rows(out, "avgd", "mnd", "avgd_loan", "mnd_loan", "eomd_loan") == [
        (10.0, 0.0, 2.0, -8.0, -5.0)
    ]
