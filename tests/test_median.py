"""Exact percentiles against those of one task, and columns that may be absent."""

import pytest

from monthgrain.operators import median
from monthgrain.operators.contract import require, resolve
from monthgrain.operators.median import exact_percentile
from monthgrain.plans.balance import balance_window
from monthgrain.plans.holdings import axa_avr, bank_ph
from tests.conftest import rows


def expected(df, share):
    return df.selectExpr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY v)").first()[0]


@pytest.mark.parametrize(
    "values",
    [
        "id * 1.5D",  # all distinct
        "double(id % 3)",
        "IF(id < 70000, 5D, double(id))",  # most rows have one value
        "exp(id / 300) * IF(id % 2 = 0, 1, -1)",  # spread over all magnitudes
        "IF(id % 7 = 0, NULL, double(id))",
        "double(id % 2) * 1e-300",
    ],
)
def test_equal_to_one_task(spark, values):
    df = spark.range(100_000).selectExpr(f"{values} AS v")
    for share in (0.5, 0.01, 0.999, 1.0):
        assert exact_percentile(df, "v", share) == expected(df, share)


def test_few_values_and_none(spark, monkeypatch):
    df = spark.sql("SELECT * FROM VALUES (1D), (2D), (double('NaN')), (NULL) AS t(v)")
    assert [exact_percentile(df, "v", s) for s in (0.1, 0.5)] == [1.0, 2.0]
    assert str(exact_percentile(df, "v", 1.0)) == "nan"
    assert exact_percentile(df.where("v IS NULL"), "v") is None
    monkeypatch.setattr(median, "CELLS", 2)  # many passes
    big = spark.range(5000).selectExpr("pow(1.01, id) AS v")
    assert exact_percentile(big, "v", 0.37) == expected(big, 0.37)


def test_exact_account_median(spark):
    df = spark.sql(
        "SELECT string(id % 50) AS cifno, '200106' AS snapshot_date, 1D AS sum_end_bal, "
        "IF(id % 4 = 0, NULL, double(id % 11)) AS nb_accts FROM range(900)"
    )
    typical = df.selectExpr("percentile_disc(0.5) WITHIN GROUP (ORDER BY nb_accts)").first()[0]
    want = df.na.fill(typical, ["nb_accts"]).selectExpr("cifno", "nb_accts")
    found = axa_avr(df, "200106", accuracy=None)
    sums = {r[0]: min(15.0, r[1]) for r in want.groupBy("cifno").sum().collect()}
    assert {r.cifno: r.nb_accts_sd for r in found.collect()} == sums


def test_absent_columns_are_null(spark):
    from checks import relations as rel

    df = rel.fx_cifsumm(spark, "/root/testdata/sf0.001").cache()
    whole, less = balance_window(df, "200106"), balance_window(df.drop("qt1", "mxdt"), "200106")
    assert less.schema == whole.schema
    empty = {"qt1", "weekday_mxdt", "delta_days", "mxdt_range"}
    same = [c for c in whole.columns if c not in empty]
    assert rows(less, *same) == rows(whole, *same)
    assert less.where("qt1 IS NOT NULL OR weekday_mxdt IS NOT NULL OR mxdt_range <> -1").count() == 0
    holding = rel.fx_phsumm(spark, "/root/testdata/sf0.001").cache()
    part = bank_ph(holding.drop("t3", "slstopn"), "200106")
    assert set(part.columns) == set(bank_ph(holding, "200106").columns)
    assert part.where("t3 <> 0 OR saving_acct_vint_l IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="columns are missing: cifno"):
        balance_window(df.drop("cifno"), "200106")


def test_contract_leaves_what_is_there(spark):
    df = spark.range(1)
    assert resolve(df, {"ID": "double"}).columns == ["id"]
    assert resolve(df, {"x": "date"}).schema["x"].dataType.typeName() == "date"
    assert require(df, "id") is df
