"""Balance features from the monthly account summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from monthgrain.functions.dates import inside_month, third_of_month, weekday_name
from monthgrain.functions.rowwise import ratio_or_null, row_max, row_mean, row_min
from monthgrain.functions.text import named, ref
from monthgrain.months import MONTH
from monthgrain.operators.cleaning import as_dates, fill_numbers
from monthgrain.operators.contract import require, resolve
from monthgrain.operators.history import KEY, Lags, attach_history, lag_name
from monthgrain.operators.rolling import advance, anchored, state_of
from monthgrain.operators.snapshots import scan_snapshot
from monthgrain.operators.stats import SPANS, lag_refs

# What is kept of a month, by how far back it is.
BALANCES = ("avg", "sdev", "med", "mx", "mn", "qt1", "qt3", "d20", "eom", "nod")
DERIVED = ("delta_days", "mxdt_range", "mndt_range", "delta_max_min_bal")
OLDER = ("avg", "mx", "mn", "eom")
WINDOWED = ("avg", "mx", "mn")
EXTREME_DATES = ("mxdt", "mndt")
WINDOW_LAGS = {0: (*BALANCES, *DERIVED)} | {lag: WINDOWED for lag in range(1, 6)}

# Parts of column names that do, and do not, take a loan deduction.
LOAN_TARGETS = ("avg", "mx", "mn", "eom", "max_bal", "avg_bal")
LOAN_EXEMPT = ("ratio", "cifno", "weekday", "range", "date", "snapshot")
DAILY_BALANCES = ("avgd", "mnd", "eomd")


# Columns that a month's summary may lack.
CONTRACT = {c: "double" for c in BALANCES} | {c: "date" for c in EXTREME_DATES}


def clean_balances(df: DataFrame) -> DataFrame:
    """Check the dates of the highest and lowest balance and describe them.

    Balances and dates that the summary lacks are null, and so is what is made of them.
    """
    df = resolve(require(df, KEY, MONTH), CONTRACT)
    checked = as_dates(df, EXTREME_DATES).selectExpr(
        *[ref(c) for c in df.columns if c not in EXTREME_DATES],
        *[named(inside_month(c, MONTH), c) for c in EXTREME_DATES],
    )
    return checked.selectExpr(
        "*",
        *[named(weekday_name(c), f"weekday_{c}") for c in EXTREME_DATES],
        *[named(third_of_month(c), f"{c}_range") for c in EXTREME_DATES],
        "datediff(mxdt, mndt) AS delta_days",
        "mx - mn AS delta_max_min_bal",
    )


def _history(df: DataFrame, lags: Lags, snapshot: str | None, **options) -> DataFrame:
    """Attach history and name the weekdays of the anchor month's dates.

    Weekday names are made after the months are put together: fixed-width columns keep the
    aggregation a hash aggregation.
    """
    wide = attach_history(clean_balances(df), _with_dates(lags), snapshot, **options)
    return _with_weekdays(wide)


def _with_dates(lags: Lags) -> Lags:
    return {**lags, 0: (*lags[0], *EXTREME_DATES)}


def _with_weekdays(wide: DataFrame) -> DataFrame:
    dates = {c: lag_name(c, 0) for c in EXTREME_DATES}
    return wide.selectExpr(
        *[c for c in wide.columns if c not in dates.values()],
        *[named(weekday_name(d), lag_name(f"weekday_{c}", 0)) for c, d in dates.items()],
    )


def balance_history(
    df: DataFrame,
    snapshot: str | None = None,
    since: str | None = None,
    until: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Six months of balances side by side, with weekdays for the anchor month only."""
    recent = (*BALANCES, *DERIVED)
    lags = {0: recent, 1: recent, 2: recent, 3: OLDER, 4: OLDER, 5: OLDER}
    return _history(df, lags, snapshot, since=since, until=until, unique=unique)


def balance_window(
    df: DataFrame,
    snapshot: str | None = None,
    since: str | None = None,
    until: str | None = None,
    unique: bool = False,
    bucketed: bool = False,
) -> DataFrame:
    """Balances of the anchor month, their 3- and 6-month range and mean, and momentum.

    ``snapshot=None`` gives every month at once, by one shuffle chain for the whole backfill.
    """
    options = {"since": since, "until": until, "unique": unique, "bucketed": bucketed}
    return _window_features(_history(df, WINDOW_LAGS, snapshot, **options))


def window_state(
    df: DataFrame, snapshot: str, state: DataFrame | None = None, state_month: str | None = None
) -> DataFrame:
    """What the balance window keeps of six months, advanced from an earlier month's state.

    Without a state it is made from the six months themselves.
    """
    rows, lags = clean_balances(df), _with_dates(WINDOW_LAGS)
    if state is None or state_month is None:
        return state_of(rows, lags, snapshot)
    return advance(state, state_month, rows, lags, snapshot)


def window_from_state(state: DataFrame) -> DataFrame:
    """The balance window of the month that a state is of."""
    return _window_features(_with_weekdays(anchored(state, _with_dates(WINDOW_LAGS))))


def _window_features(wide: DataFrame) -> DataFrame:
    out = [named(c, c.removesuffix("_lag0")) for c in wide.columns if c.endswith("_lag0")]
    for span in SPANS:
        out += [
            named(row_max(lag_refs("mx", span)), f"max_bal_{span}mth"),
            named(row_min(lag_refs("mn", span)), f"min_bal_{span}mth"),
            named(row_mean(lag_refs("avg", span)), f"avg_bal_{span}mth"),
        ]
    averages = lag_refs("avg", 3)
    for i in range(2):
        change = f"({averages[i]} - {averages[i + 1]})"
        tag = f"t{i + 1}-{i + 2}"
        out += [
            named(change, f"delta_avg_bal_{tag}"),
            named(ratio_or_null(change, averages[i + 1]), f"ratio_avg_bal_{tag}"),
        ]
    return wide.selectExpr(KEY, MONTH, *out)


def _with_loans(balances: DataFrame, loans: DataFrame) -> DataFrame:
    """Attach ``loan_to_debit`` by customer and month, then read all missing numbers as 0."""
    by = [KEY, MONTH]
    return fill_numbers(balances.join(loans.select(*by, "loan_to_debit"), by, "left"))


def _less_loan(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    deducted = [named(f"{ref(c)} - loan_to_debit", f"{c}_loan") for c in targets]
    return df.selectExpr("*", *deducted).drop("loan_to_debit")


def loan_targets(columns: Sequence[str]) -> list[str]:
    """Balance columns, told by parts of their names."""
    return [
        c
        for c in columns
        if any(part in c for part in LOAN_TARGETS) and not any(part in c for part in LOAN_EXEMPT)
    ]


def balance_loan(
    window: DataFrame, loans: DataFrame, targets: Sequence[str] | None = None
) -> DataFrame:
    """Balance window plus, for each balance column, the balance less the loan estimate."""
    if targets is None:
        targets = loan_targets(window.columns)
    return _less_loan(_with_loans(window, loans), targets)


def balance_deduct(df: DataFrame, loans: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Daily-level balances of the anchor month and the same less the loan estimate."""
    rows = df if snapshot is None else scan_snapshot(df, snapshot)
    rows = resolve(require(rows, KEY, MONTH), dict.fromkeys(DAILY_BALANCES, "double"))
    levels = rows.select(KEY, MONTH, *DAILY_BALANCES)
    return _less_loan(_with_loans(levels, loans), DAILY_BALANCES)
