"""History kept as a state: a month's state is that of an earlier month and the new rows.

The state of a month has a row for each customer seen in its last months, with the columns
``<name>_lag<i>`` of an attached history and one bit per month seen. Advancing by some months
shifts the lags and takes lag 0 from the new rows, so a run reads one month and one state where
the full computation reads all months. The result is the same as ``attach_history`` has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.functions.text import named, ref
from monthgrain.months import MONTH, month_index, month_number, month_text, months_back
from monthgrain.operators.history import KEY, Lags, checked_key, lag_name

SEEN = "seen_months"
_ROWS = "_rows"


def _nested(lags: Lags) -> int:
    """How many months a state holds. A name wanted at some lag must be there at the lags before."""
    months = max(lags) + 1
    for lag in range(1, months):
        missing = set(lags.get(lag, ())) - set(lags.get(lag - 1, ()))
        if missing:
            raise ValueError(f"wanted at lag {lag} but not before: {', '.join(sorted(missing))}")
    return months


def _month(df: DataFrame, lags: Lags, snapshot: str, key: str) -> DataFrame:
    """Rows of one month, folded and checked to be one per customer."""
    folded = (
        df.where(F.col(MONTH) == snapshot)
        .groupBy(ref(key))
        .agg(
            *[F.expr(named(f"max({ref(n)})", n)) for n in lags[0]],
            F.expr(f"max({MONTH}) AS {MONTH}"),
            F.expr(f"count(*) AS {_ROWS}"),
        )
    )
    return folded.where(checked_key(key, f"{_ROWS} > 1")).drop(_ROWS, MONTH)


def _columns(lags: Lags) -> list[tuple[int, str]]:
    return [(lag, n) for lag, listed in sorted(lags.items()) for n in listed]


def advance(
    state: DataFrame, state_month: str, df: DataFrame, lags: Lags, snapshot: str, key: str = KEY
) -> DataFrame:
    """The state of ``snapshot``, from that of an earlier month and the rows of ``snapshot``.

    Months between the two count as without rows. Customers not seen for as many months as
    the state holds are dropped. Null and repeated customers of the new month are an error.
    """
    months = _nested(lags)
    gap = month_number(snapshot) - month_number(state_month)
    if gap < 1:
        raise ValueError(f"the state of {state_month} is not before {snapshot}")
    new = _month(df, lags, snapshot, key).withColumn("_new", F.lit(1)).alias("new")
    old = state.alias("old")
    joined = old.join(new, key, "full_outer")

    def value(lag: int, name: str) -> str:
        if lag == 0:
            return named(f"new.{ref(name)}", lag_name(name, 0))
        if lag < gap:
            kind = state.schema[lag_name(name, lag)].dataType.simpleString()
            return named(f"CAST(NULL AS {kind})", lag_name(name, lag))
        return named(f"old.{ref(lag_name(name, lag - gap))}", lag_name(name, lag))

    shifted = f"shiftleft(coalesce(old.{SEEN}, 0), {min(gap, months)})"
    seen = f"({shifted} | coalesce(new._new, 0)) & {(1 << months) - 1}"
    return joined.selectExpr(
        ref(key), *[value(lag, n) for lag, n in _columns(lags)], f"{seen} AS {SEEN}"
    ).where(f"{SEEN} <> 0").withColumn(MONTH, F.lit(snapshot))


def state_of(df: DataFrame, lags: Lags, snapshot: str, key: str = KEY) -> DataFrame:
    """The state of a month from the months themselves: where there is no earlier state."""
    months = _nested(lags)
    number = f"{month_number(snapshot)} - {month_index(MONTH)}"
    rows = df.where(F.col(MONTH).isin(months_back(snapshot, months)))
    rows = rows.selectExpr(ref(key), named(number, "_lag"), *[ref(n) for n in lags[0]])
    # one row per customer and month before customers meet, so a hot id stays small
    folded = rows.groupBy(ref(key), "_lag").agg(
        *[F.expr(named(f"max({ref(n)})", n)) for n in lags[0]], F.expr(f"count(*) AS {_ROWS}")
    )
    folded = folded.withColumn(MONTH, F.lit(snapshot)).where(checked_key(key, f"{_ROWS} > 1"))
    return folded.groupBy(ref(key)).agg(
        *[
            F.expr(named(f"max(CASE WHEN _lag = {lag} THEN {ref(n)} END)", lag_name(n, lag)))
            for lag, n in _columns(lags)
        ],
        F.expr(f"bit_or(shiftleft(1, _lag)) AS {SEEN}"),
    ).withColumn(MONTH, F.lit(snapshot))


def anchored(state: DataFrame, lags: Lags, key: str = KEY) -> DataFrame:
    """The attached history that a state holds: customers with a row in its month."""
    return state.where(f"{SEEN} & 1 = 1").selectExpr(
        ref(key), MONTH, *[ref(lag_name(n, lag)) for lag, n in _columns(lags)]
    )


def usable_months(snapshot: str, lags: Lags) -> list[str]:
    """Months whose state can be advanced to ``snapshot``, latest first."""
    number = month_number(snapshot)
    return [month_text(number - back) for back in range(1, max(lags) + 1)]
