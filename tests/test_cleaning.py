from datetime import date

import pytest

from monthgrain.operators import cleaning
from tests.conftest import rows


def test_names_that_clash(spark):
    df = spark.createDataFrame([("a", "b")], ["Open Date", "open_date"])
    with pytest.raises(ValueError, match="open_date"):
        cleaning.sanitize_columns(df)


def test_names_with_dots_and_hyphens(spark):
    df = spark.createDataFrame([(" x ", "1")], ["a.b", "c-d"])
    cleaned = cleaning.clean_bank_table(df, keep=("a.b",))
    assert cleaned.columns == ["a.b", "c-d"]
    assert rows(cleaned) == [("x", 1.0)]


def test_customer_id_by_priority_not_by_position(spark):
    df = spark.createDataFrame([("p", "r"), ("p", None)], "cifno_pengirim string, rekening string")
    assert rows(cleaning.add_customer_id(df), "cifno") == [("p",), ("r",)]


def test_customer_id_kept_if_there(spark):
    df = spark.createDataFrame([(7, "r")], "cifno long, rekening string")
    assert rows(cleaning.add_customer_id(df)) == [("7", "r")]


def test_no_candidate_leaves_the_table(spark):
    df = spark.createDataFrame([("x",)], "other string")
    assert cleaning.add_customer_id(df).columns == ["other"]


def test_hardening(spark):
    df = spark.createDataFrame(
        [("007", "12.5", "n/a", "x", "2001-06-05", "Y")],
        ["cifno", "amount", "score", "branch_id", "opened", "vip_fg"],
    )
    hard = cleaning.harden_types(df, dates=("opened",))
    assert rows(hard) == [("007", 12.5, None, "x", date(2001, 6, 5), "Y")]


def test_dates_that_are_dates_already_are_left_alone(spark):
    df = spark.sql("SELECT date'2001-06-05' AS d, 1 AS x")
    assert cleaning.as_dates(df, ("d", "absent")) is df


def test_leading_zeros_survive_in_the_described_sources(spark):
    df = spark.createDataFrame([("0012", "00:00:00", "5")], ["rekening", "x", "amount"])
    cleaned = cleaning.clean_bank_table(df, keep=("rekening",))
    assert rows(cleaned, "rekening", "cifno", "amount") == [("0012", "0012", 5.0)]


def test_call_tables_are_tidied_only_on_request(spark):
    df = spark.createDataFrame([(12, " (null) ")], "AccNumber long, note string")
    assert rows(cleaning.clean_call_table(df)) == [("12", " (null) ")]
    assert rows(cleaning.clean_call_table(df, tidy=True)) == [("12", "(null)")]


def test_filling_leaves_text_and_dates(spark):
    df = spark.sql("SELECT double(NULL) AS a, string(NULL) AS b, date(NULL) AS c, int(NULL) AS d")
    assert rows(cleaning.fill_numbers(df)) == [(0.0, None, None, 0)]
