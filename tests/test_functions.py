from datetime import date

import pytest

from monthgrain.functions import dates, rowwise
from monthgrain.functions.text import clean_name, text, tidy_text


@pytest.mark.parametrize(
    "recent, past, expected",
    [
        (30.0, 20.0, 0.5),
        (7.0, 0.0, 7.0),
        (0.0, 0.0, 0.0),
        (5.0, None, 0.0),
        (5.0, -2.0, 0.0),
        (None, 2.0, None),
        (None, 0.0, 0.0),
    ],
)
def test_relative_change(evaluate, recent, past, expected):
    assert evaluate(rowwise.relative_change("r", "p"), r=recent, p=past) == expected


@pytest.mark.parametrize(
    "part, total, expected",
    [(1.0, 4.0, 0.25), (1.0, 0.0, 0.0), (1.0, -4.0, 0.0), (1.0, None, 0.0), (None, 4.0, None)],
)
def test_share(evaluate, part, total, expected):
    assert evaluate(rowwise.share("a", "b"), a=part, b=total) == expected


def test_row_statistics_skip_nulls(evaluate):
    values = {"a": 1.0, "b": None, "c": 4.0}
    assert evaluate(rowwise.row_max(list(values)), **values) == 4.0
    assert evaluate(rowwise.row_min(list(values)), **values) == 1.0
    assert evaluate(rowwise.row_mean(list(values)), **values) == 2.5


def test_row_statistics_of_nothing(evaluate):
    values = {"a": None, "b": None}
    assert evaluate(rowwise.row_max(list(values)), **values) is None
    assert evaluate(rowwise.row_min(list(values)), **values) is None
    assert evaluate(rowwise.row_mean(list(values)), **values) == 0.0


def test_one_column_needs_no_greatest(evaluate):
    assert evaluate(rowwise.row_max(["a"]), a=3.0) == 3.0
    assert evaluate(rowwise.row_min(["a"]), a=3.0) == 3.0


def test_sums(evaluate):
    assert evaluate(rowwise.null_safe_sum(["a", "b"]), a=1.0, b=None) == 1.0
    assert evaluate(rowwise.strict_sum(["a", "b"]), a=1.0, b=None) is None
    assert evaluate(rowwise.null_safe_sum([])) == 0.0
    assert evaluate(rowwise.strict_sum([])) == 0.0


def test_caps(evaluate):
    assert evaluate(rowwise.capped("a", 5, 0), a=9.0) == 5.0
    assert evaluate(rowwise.capped("a", 5, 0), a=None) == 0.0
    assert evaluate(rowwise.capped("a", 15, 15), a=None) == 15.0
    assert evaluate(rowwise.clipped("a", 15), a=16.0) == 15.0
    assert evaluate(rowwise.clipped("a", 15), a=None) is None


def test_ratio(evaluate):
    assert evaluate(rowwise.ratio_or_null("a", "b"), a=1.0, b=0.0) is None
    assert evaluate(rowwise.ratio_or_null("a", "b"), a=1.0, b=-2.0) == -0.5


@pytest.mark.parametrize(
    "day, kept",
    [
        ("2001-05-30", False),
        ("2001-05-31", True),
        ("2001-06-15", True),
        ("2001-07-01", True),
        ("2001-07-02", False),
    ],
)
def test_dates_of_the_month_and_its_neighbours(evaluate, day, kept):
    found = evaluate(dates.inside_month("date(d)", "m"), d=day, m="200106")
    assert found == (date.fromisoformat(day) if kept else None)


@pytest.mark.parametrize(
    "day, part", [("01", 1), ("10", 1), ("11", 2), ("20", 2), ("21", 3), ("30", 3)]
)
def test_thirds(evaluate, day, part):
    assert evaluate(dates.third_of_month("date(d)"), d=f"2001-06-{day}") == part


def test_no_date_is_its_own_bin(evaluate):
    assert evaluate(dates.third_of_month("date(NULL)")) == -1


def test_weekday(evaluate):
    assert evaluate(dates.weekday_name("date(d)"), d="2024-02-29") == "Thursday"


@pytest.mark.parametrize(
    "day, expected",
    [
        ("1900-01-01", "1900-01-01"),
        ("1917-01-01", "1917-01-01"),
        ("1917-01-02", "1980-01-01"),
        ("1979-12-31", "1980-01-01"),
        ("1980-01-01", "1980-01-01"),
        ("2001-06-30", "2001-06-30"),
        ("2001-07-01", None),
        ("2999-12-31", None),
    ],
)
def test_open_dates(evaluate, day, expected):
    found = evaluate(dates.clamp_open_date("date(d)", "m"), d=day, m="200106")
    assert found == (expected and date.fromisoformat(expected))


def test_age(evaluate):
    found = evaluate(dates.age_in_months("date(d)", "m"), d="2001-06-01", m="200106")
    assert found == 29 / 30.44


def test_date_formats(evaluate):
    parse = dates.parse_date("d", ["yyyy-MM-dd", "yyyyMMdd"])
    assert evaluate(parse, d="2001-06-05") == date(2001, 6, 5)
    assert evaluate(parse, d="20010605") == date(2001, 6, 5)
    assert evaluate(parse, d="junk") is None


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2001-06-05 00:00:00", "2001-06-05"),
        ("(null)", None),
        (" (null) ", "(null)"),
        ("  a b ", "a b"),
        ("", ""),
        ("100:00:00", "100:00:00"),
        ("00:00:00(null)", None),
    ],
)
def test_tidy_text(evaluate, raw, expected):
    assert evaluate(tidy_text("v"), v=raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Cus No", "cus_no"),
        (" Seg,ment", "seg_ment"),
        ("Bal(IDR)", "bal_idr"),
        ("a\t=b;{c}", "a_b_c"),
        ("_x_", "x"),
    ],
)
def test_clean_name(raw, expected):
    assert clean_name(raw) == expected


def test_literals_are_escaped(evaluate):
    assert evaluate(text("it's a \\ b")) == "it's a \\ b"
