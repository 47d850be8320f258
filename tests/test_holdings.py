import statistics

import pytest

from monthgrain.plans import holdings
from tests.conftest import rows

KEYS = "cifno string, snapshot_date string, "


def test_caps_and_totals(spark):
    names = [f"t{i}" for i in range(1, 19)]
    values = {"t1": 9.0, "t2": 5.0, "t3": 4.0, "t12": 6.0, "t10": 7.0}
    df = spark.createDataFrame(
        [("a", "200106", 20.0, *[values.get(t) for t in names])],
        KEYS + "totph double, " + ", ".join(f"{t} double" for t in names),
    )
    (row,) = holdings.product_counts(df, "200106").collect()
    assert (row.t1, row.t2, row.t4, row.t10, row.totph) == (5.0, 5.0, 0.0, 5.0, 15.0)
    assert (row.tot_saving, row.tot_loan) == (11.0, 4.0)


def test_customers_with_only_product_12_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", "200106", 3.0, 3.0), ("b", "200106", 4.0, 3.0), ("c", "200106", None, 3.0)]
        + [("d", "200106", 4.0, None)],
        KEYS + "totph double, t12 double",
    )
    assert rows(holdings.product_counts(df, "200106"), "cifno") == [("b",)]


def test_missing_total_without_product_12(spark):
    df = spark.createDataFrame([("a", "200106", None)], KEYS + "totph double")
    out = holdings.product_counts(df, "200106")
    assert rows(out, "totph", "tot_saving", "tot_loan") == [(15.0, 0.0, 0.0)]


def test_vintages(spark):
    df = spark.createDataFrame(
        [("a", "200106", "2001-06-01", "2001-06-20", "1950-05-05", "2999-01-01")],
        KEYS + "sfstopn string, slstopn string, dfstopn string, dlstopn string",
    )
    out = holdings.product_vintages(df, "200106")
    assert out.columns[2:] == [
        "saving_acct_vint_l",
        "saving_acct_vint_f",
        "all_acct_vint_l",
        "all_acct_vint_f",
    ]
    (row,) = out.collect()
    assert row.saving_acct_vint_f == 29 / 30.44
    assert row.all_acct_vint_l == row.saving_acct_vint_l == 10 / 30.44
    assert row.all_acct_vint_f == 7851 / 30.44


def test_one_open_date_only(spark):
    df = spark.createDataFrame([("a", "200106", "2001-06-01")], KEYS + "sfstopn string")
    out = holdings.product_vintages(df, "200106")
    assert rows(out, "all_acct_vint_f", "saving_acct_vint_f") == [(29 / 30.44, 29 / 30.44)]
    assert "all_acct_vint_l" not in out.columns


def test_loan_increases(spark):
    data = [("a", "200106", 100.0), ("a", "200105", 50.0), ("a", "200104", 60.0)]
    data += [("a", "200103", 10.0), ("b", "200106", None)]
    df = spark.createDataFrame(data, KEYS + "loanall_s double")
    out = holdings.loan_diff(df, "200106")
    assert rows(out) == [
        ("a", "200106", 2, 8.0, 1, 0, 1),
        ("b", "200106", 0, None, 0, 0, 0),
    ]


@pytest.mark.parametrize(
    "t3, t4, t9, expected",
    [(1.0, 1.0, 0.0, (2.0, 2.0, 1.0)), (0.0, 0.0, 0.0, (0.0, 0.0, 1.0)), (None, 1.0, 1.0, (None, None, 1.0))],
)
def test_saving_accounts(spark, t3, t4, t9, expected):
    df = spark.createDataFrame(
        [("a", "200106", t3, t4, t9)], KEYS + "t3 double, t4 double, t9 double"
    )
    out = holdings.saving_acct(df, "200106")
    assert rows(out, "tot_saving", "tot_undebit_saving", "ratio_undebit_saving") == [expected]


def test_saving_accounts_without_counters(spark):
    out = holdings.saving_acct(spark.createDataFrame([("a", "200106")], KEYS[:-2]), "200106")
    assert rows(out, "tot_saving", "ratio_undebit_saving") == [(0.0, 1.0)]


AVR = KEYS + "sum_end_bal double, nb_accts double"


@pytest.mark.parametrize("accuracy", [10_000, None])
@pytest.mark.parametrize("known", [[1.0, 2.0, 3.0, 4.0], [7.0], [3.0, 3.0, 9.0, 1.0, 5.0]])
def test_median_fill(spark, accuracy, known):
    data = [(f"k{i}", "200106", 1.0, n) for i, n in enumerate(known)]
    data += [("x", "200106", None, None), ("y", "200105", 1.0, 100.0)]
    out = holdings.axa_avr(spark.createDataFrame(data, AVR), "200106", accuracy)
    expected = statistics.median_low(known)
    assert rows(out.where("cifno = 'x'"), "sum_end_bal", "nb_accts_sd") == [(0.0, expected)]


def test_accounts_are_added_up_then_clipped(spark):
    data = [("a", "200106", 1.0, 9.0), ("a", "200106", 2.0, 9.0), ("b", "200106", 1.0, 15.0)]
    out = holdings.axa_avr(spark.createDataFrame(data, AVR), "200106")
    assert rows(out, "cifno", "sum_end_bal", "nb_accts_sd") == [("a", 3.0, 15.0), ("b", 1.0, 15.0)]


def test_no_account_number_at_all(spark):
    out = holdings.axa_avr(spark.createDataFrame([("a", "200106", 1.0, None)], AVR), "200106")
    assert rows(out, "nb_accts_sd") == [(None,)]
