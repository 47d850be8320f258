"""Product holdings, loans, saving accounts, average balances and card types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.functions.dates import ISO_DATE, age_in_months, clamp_open_date
from monthgrain.functions.rowwise import capped, clipped, ratio_or_null, row_max, row_min, strict_sum
from monthgrain.functions.text import named, ref
from monthgrain.months import MONTH
from monthgrain.operators.cleaning import as_dates
from monthgrain.operators.contract import resolve
from monthgrain.operators.history import KEY, attach_history, lag_name
from monthgrain.operators.median import exact_percentile
from monthgrain.operators.snapshots import scan_snapshot
from monthgrain.sources.manifest import OPEN_DATES

# Product counters and what they may add up to.
PRODUCTS = tuple(range(1, 19))
SAVING_PRODUCTS = tuple(range(1, 10))
LOAN_PRODUCTS = tuple(range(12, 18))
UNDEBIT_PRODUCTS = (3, 4, 9)
PRODUCT_CAP = 5
TOTAL_CAP = 15
SAVING_CAP = 11
LOAN_CAP = 4

# Fixed value: part of a loan expected to be debited each month.
LOAN_DEBIT_RATE = 0.08

# Fixed value: accounts counted per customer at most.
ACCOUNT_CAP = 15

_FIRST_OPENED = OPEN_DATES[0::2]
_LAST_OPENED = OPEN_DATES[1::2]


def _counters(df: DataFrame, products: Sequence[int]) -> list[str]:
    return [f"t{i}" for i in products if f"t{i}" in df.columns]


def _at(df: DataFrame, snapshot: str | None) -> DataFrame:
    return df if snapshot is None else scan_snapshot(df, snapshot)


def product_counts(
    df: DataFrame,
    snapshot: str | None = None,
    saving: Sequence[int] = SAVING_PRODUCTS,
    loan: Sequence[int] = LOAN_PRODUCTS,
) -> DataFrame:
    """Capped product counters and totals of customers with more than product 12.

    Customers whose product total equals counter 12, or either is missing, are left out,
    where the table has both columns. Counters that the table lacks count as missing ones.
    """
    rows = _at(df, snapshot).withColumnsRenamed({"loanmort_s": "loanmort", "loanall_s": "loanall"})
    if "totph" in rows.columns and "t12" in rows.columns:
        rows = rows.where("totph <> t12")
    rows = resolve(rows, {f"t{i}": "double" for i in PRODUCTS} | {"totph": "double"})
    cut = {c: capped(c, PRODUCT_CAP, 0) for c in _counters(rows, PRODUCTS)}
    cut["totph"] = capped("totph", TOTAL_CAP, TOTAL_CAP)
    rows = rows.selectExpr(*[named(cut[c], c) if c in cut else ref(c) for c in rows.columns])

    def total(products: Sequence[int], cap: int) -> str:
        return f"least({cap}D, {strict_sum(_counters(rows, products))})"

    return rows.selectExpr(
        "*",
        named(total(saving, SAVING_CAP), "tot_saving"),
        named(total(loan, LOAN_CAP), "tot_loan"),
    )


def product_vintages(
    df: DataFrame, snapshot: str | None = None, formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """Ages of the first and last opened accounts in place of the eight open dates."""
    rows = as_dates(_at(df, snapshot), OPEN_DATES, formats)
    dates = [c for c in OPEN_DATES if c in rows.columns]
    kept = [ref(c) for c in rows.columns if c not in dates]
    clamped = rows.selectExpr(*kept, *[named(clamp_open_date(c, MONTH), c) for c in dates])
    first = [c for c in _FIRST_OPENED if c in dates]
    last = [c for c in _LAST_OPENED if c in dates]
    ages = {}
    if "slstopn" in dates:
        ages["saving_acct_vint_l"] = "slstopn"
    if "sfstopn" in dates:
        ages["saving_acct_vint_f"] = "sfstopn"
    if last:
        ages["all_acct_vint_l"] = row_max(last)
    if first:
        ages["all_acct_vint_f"] = row_min(first)
    return clamped.selectExpr(
        *kept, *[named(age_in_months(day, MONTH), n) for n, day in ages.items()]
    )


def bank_ph(
    df: DataFrame, snapshot: str | None = None, formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """Product holding features: capped counters, totals and account ages.

    Dates that the table lacks are null, so all four ages are there in any case.
    """
    counts = resolve(product_counts(df, snapshot), dict.fromkeys(OPEN_DATES, "date"))
    return product_vintages(counts, None, formats)


def loan_diff(
    df: DataFrame,
    snapshot: str | None = None,
    since: str | None = None,
    until: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Loan increases over four months and the monthly debit expected from the loan."""
    lags = {lag: ("loanall_s",) for lag in range(4)}
    wide = attach_history(df, lags, snapshot, unique=unique, since=since, until=until)
    loans = [lag_name("loanall_s", lag) for lag in range(4)]
    flags = {
        f"loan_inc_flag_{i}": f"int(coalesce({loans[i]} > {loans[i + 1]}, false))"
        for i in range(3)
    }
    return wide.selectExpr(
        KEY,
        MONTH,
        named(strict_sum(list(flags.values()), "0"), "loan_recent_inc_count"),
        named(f"{loans[0]} * {LOAN_DEBIT_RATE}D", "loan_to_debit"),
        *[named(flag, n) for n, flag in flags.items()],
    )


def saving_acct(
    df: DataFrame,
    snapshot: str | None = None,
    saving: Sequence[int] = SAVING_PRODUCTS,
    undebit: Sequence[int] = UNDEBIT_PRODUCTS,
) -> DataFrame:
    """Share of saving accounts without a debit card; 1.0 where it cannot be told."""
    rows = _at(df, snapshot)
    totals = rows.selectExpr(
        KEY,
        MONTH,
        named(strict_sum(_counters(rows, saving)), "tot_saving"),
        named(strict_sum(_counters(rows, undebit)), "tot_undebit_saving"),
    )
    ratio = ratio_or_null("tot_undebit_saving", "tot_saving")
    return totals.selectExpr("*", named(f"coalesce({ratio}, 1D)", "ratio_undebit_saving"))


def axa_avr(df: DataFrame, snapshot: str, accuracy: int | None = 10_000) -> DataFrame:
    """Balance and number of accounts by customer.

    Missing account numbers are filled with the month's lower median, a scalar subquery over
    a mergeable sketch with rank error 1/``accuracy``. ``accuracy=None`` takes the exact
    median: passes over counts by value, which run when this is called.
    """
    rows = scan_snapshot(df, snapshot).withColumnRenamed("nb_accts", "nb_accts_sd")
    accounts = F.col("nb_accts_sd")
    if accuracy is None:
        typical = F.lit(exact_percentile(rows, "nb_accts_sd")).cast("double")
    else:
        typical = rows.agg(F.percentile_approx(accounts, 0.5, accuracy)).scalar()
    totals = rows.groupBy(KEY, MONTH).agg(
        F.expr("sum(coalesce(sum_end_bal, 0D)) AS sum_end_bal"),
        F.sum(F.coalesce(accounts, typical)).alias("nb_accts_sd"),
    )
    return totals.withColumn("nb_accts_sd", F.expr(clipped("nb_accts_sd", ACCOUNT_CAP)))


def card_types(df: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Card counts of a month as they are; used for credit and for debit cards."""
    return _at(df, snapshot)
