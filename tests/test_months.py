from datetime import date

import pytest

from monthgrain.months import month_end, month_index, month_number, month_start, month_text, months_back


def test_months_back_over_new_year():
    assert months_back("200102", 6) == ["200102", "200101", "200012", "200011", "200010", "200009"]


def test_number_and_text_are_inverse():
    for month in ("199912", "200001", "202406"):
        assert month_text(month_number(month)) == month


@pytest.mark.parametrize("bad", ["20011", "200113", "200100", "2001-1", "abcdef", ""])
def test_not_a_month(bad):
    with pytest.raises(ValueError):
        month_number(bad)


def test_as_columns(evaluate):
    assert evaluate(month_index("m"), m="200112") == month_number("200112")
    assert evaluate(month_start("m"), m="200402") == date(2004, 2, 1)
    assert evaluate(month_end("m"), m="200402") == date(2004, 2, 29)
