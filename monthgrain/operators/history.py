"""Calendar history: earlier months of the same customer as extra columns.

``attach_history`` yields one row per customer and anchor month, with columns
``<name>_lag<i>`` holding the value ``i`` calendar months back (null where the customer has
no row in that month). Lags are always counted on the calendar, never by row position, since
months may be missing.

* One anchor month: a conditional aggregation. Each month wanted is read once, with the month
  filter on the partition column and no more columns than that month is asked for; months
  asked for the same columns share a scan. Rows are partly aggregated before the only
  shuffle, and customers without a row in the anchor month are left out.
* Every month as an anchor (``snapshot=None``): rows are first folded to one per customer
  and month, so that a window over one customer is never larger than the number of months,
  and range frames over the month number then pick the lags. Measures of the anchor month
  alone travel as one packed column.

Where the rows are known to be unique by customer and month (``unique=True``), as after the
check of the cleaning job, there is nothing to fold before the shuffle: rows travel as they
are and are put side by side behind it, which saves the wide partial rows, or the first of
the two shuffles. Without that knowledge one id might hold a large part of all rows, so
the default folds first.

Where the table is stored in buckets of the customer (``bucketed=True``), each month is a scan
of its own columns, and the months are joined where they lie: nothing moves.

The key of the result is (customer, month). Rows that break it, i.e. two rows of one customer
in one month where rows are not to be added up, or a customer id that is null, stop the run
with an error, in either mode. They are neither dropped nor multiplied.

Values should be numbers or dates: those keep the aggregation a hash aggregation, while text
makes it sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.functions.text import named, ref, text
from monthgrain.months import MONTH, month_index, month_number, months_back

KEY = "cifno"

Lags = Mapping[int, Sequence[str]]

_LAG = "_lag"
_ROWS = "_rows"
_SEEN = "_seen"
_INDEX = "_month_index"
_BEFORE = "_month_before"
_OWN = "_own"
_FOLDED = "_folded"


def lag_name(name: str, lag: int) -> str:
    return f"{name}_lag{lag}"


def attach_history(
    df: DataFrame,
    lags: Lags,
    snapshot: str | None = None,
    *,
    sums: Mapping[str, str] | None = None,
    unique: bool = False,
    bucketed: bool = False,
    key: str = KEY,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Columns ``<name>_lag<i>`` for the names listed under each lag ``i``.

    ``snapshot`` is the anchor month; ``None`` makes every month from ``since`` to ``until``
    (both optional and inclusive) an anchor. Lag 0 must be listed.

    ``sums`` maps names to row expressions that are added up per customer and month; it is
    for inputs with several rows per customer and month. All names in ``lags`` must be among
    them. Without it, names are columns of ``df`` and the key must be unique; ``unique`` says
    that this has been checked, ``bucketed`` that the table lies in buckets of the key.
    """
    if 0 not in lags:
        raise ValueError("lag 0, the anchor month itself, must be listed")
    if (unique or bucketed) and sums is not None:
        raise ValueError("rows to be added up are not unique")
    if bucketed and snapshot is not None:
        return _joined_months(df, lags, key, snapshot)
    if snapshot is None:
        return _every_anchor(df, lags, sums, unique or bucketed, key, since, until)
    return _one_anchor(df, lags, sums, unique, key, snapshot)


def _values(lags: Lags, sums: Mapping[str, str] | None) -> dict[str, str]:
    names = dict.fromkeys(n for listed in lags.values() for n in listed)
    return {n: ref(n) if sums is None else sums[n] for n in names}


def checked_key(key: str, duplicated: str) -> str:
    """True, or an error for a row whose key is null or not unique."""
    no_key = text(f"{key} is null in month ")
    not_unique = text(f"more than one row in a month for {key} ")
    return (
        f"CASE WHEN {ref(key)} IS NULL THEN boolean(raise_error({no_key} || {MONTH})) "
        f"WHEN {duplicated} THEN boolean(raise_error({not_unique} || {ref(key)})) "
        "ELSE true END"
    )


def _one_anchor(
    df: DataFrame,
    lags: Lags,
    sums: Mapping[str, str] | None,
    unique: bool,
    key: str,
    snapshot: str,
) -> DataFrame:
    months = months_back(snapshot, max(lags) + 1)
    values = _values(lags, sums)
    number = named(f"{month_number(snapshot)} - {month_index(MONTH)}", _LAG)
    asked: dict[frozenset[str], list[str]] = {}
    for lag, listed in lags.items():
        asked.setdefault(frozenset(listed), []).append(months[lag])
    scans = [
        df.where(F.col(MONTH).isin(wanted)).selectExpr(
            ref(key), number, *[named(v, n) for n, v in values.items() if n in listed]
        )
        for listed, wanted in asked.items()
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    if unique:
        rows = rows.repartition(F.col(ref(key)))
    pick = "max" if sums is None else "sum"
    picked = [
        F.expr(named(f"{pick}(CASE WHEN {_LAG} = {lag} THEN {ref(n)} END)", lag_name(n, lag)))
        for lag, listed in lags.items()
        for n in listed
    ]
    folded = rows.groupBy(ref(key)).agg(
        *picked,
        # One bit per month seen: the key is unique if there are as many bits as rows.
        F.expr(f"bit_or(shiftleft(1, {_LAG})) AS {_SEEN}"),
        F.expr(f"count(*) AS {_ROWS}"),
    )
    duplicated = f"{_ROWS} <> bit_count({_SEEN})" if sums is None else "false"
    wide = folded.withColumn(MONTH, F.lit(snapshot))
    return wide.where(
        f"CASE WHEN {_SEEN} & 1 = 1 THEN {checked_key(key, duplicated)} ELSE false END"
    ).selectExpr(
        ref(key), MONTH, *[ref(lag_name(n, i)) for i, listed in lags.items() for n in listed]
    )


def _joined_months(df: DataFrame, lags: Lags, key: str, snapshot: str) -> DataFrame:
    """A scan per month, folded by customer and joined to the anchor month's."""
    months = months_back(snapshot, max(lags) + 1)
    wide = None
    for lag, listed in sorted(lags.items()):
        rows = df.where(F.col(MONTH) == months[lag])
        folded = rows.groupBy(ref(key)).agg(
            *[F.expr(named(f"max({ref(n)})", lag_name(n, lag))) for n in listed],
            F.expr(f"max({MONTH}) AS {MONTH}"),
            F.expr(f"count(*) AS {_ROWS}"),
        )
        month = folded.where(checked_key(key, f"{_ROWS} > 1")).drop(_ROWS)
        wide = month if wide is None else wide.join(month.drop(MONTH), key, "left")
    return wide.selectExpr(
        ref(key), MONTH, *[ref(lag_name(n, i)) for i, listed in lags.items() for n in listed]
    )


def _every_anchor(
    df: DataFrame,
    lags: Lags,
    sums: Mapping[str, str] | None,
    unique: bool,
    key: str,
    since: str | None,
    until: str | None,
) -> DataFrame:
    if since is not None:
        df = df.where(F.col(MONTH) >= months_back(since, max(lags) + 1)[-1])
    if until is not None:
        df = df.where(F.col(MONTH) <= until)
    values = _values(lags, sums)
    older = dict.fromkeys(n for lag, listed in lags.items() if lag for n in listed)
    # Measures of the anchor alone cross the shuffle and the window as one column.
    own = f"struct({', '.join(ref(n) for n in lags[0])}) AS {_OWN}"
    kept = [ref(key), MONTH, named(month_index(MONTH), _INDEX), own, *[ref(n) for n in older]]
    if unique:
        monthly = df.selectExpr(*kept)
    else:
        if sums is None:
            # Wide rows do not fill hash tables: a set among the aggregates makes Spark hold few
            # groups at once and sort the others, which can spill.
            row = f"first(struct({', '.join(values.values())})) AS {_FOLDED}"
            folded = [F.expr(row), F.expr(f"collect_set(true) AS {_SEEN}")]
            duplicated = f"{_ROWS} > size({_SEEN})"
        else:
            folded = [F.expr(named(f"sum({v})", n)) for n, v in values.items()]
            duplicated = "false"
        monthly = (
            df.groupBy(ref(key), MONTH)
            .agg(*folded, F.expr(f"count(*) AS {_ROWS}"))
            .where(checked_key(key, duplicated))
        )
        if sums is None:
            monthly = monthly.selectExpr(
                ref(key), MONTH, *[named(f"{_FOLDED}.{ref(n)}", n) for n in values]
            )
        monthly = monthly.selectExpr(*kept)
    by_customer = f"PARTITION BY {ref(key)} ORDER BY {_INDEX}"

    def picked(name: str, lag: int) -> str:
        frame = f"RANGE BETWEEN {lag} PRECEDING AND {lag} PRECEDING"
        return named(f"max({ref(name)}) OVER ({by_customer} {frame})", lag_name(name, lag))

    out = monthly.selectExpr(
        ref(key),
        MONTH,
        _INDEX,
        _OWN,
        *[picked(n, lag) for lag, listed in lags.items() if lag for n in listed],
        *([f"lag({_INDEX}) OVER ({by_customer}) AS {_BEFORE}"] if unique else []),
    )
    if unique:
        # Of two rows in one month, one follows the other.
        out = out.where(checked_key(key, f"{_BEFORE} <=> {_INDEX}"))
    # The filter runs after the window, so the first anchors still see their history.
    out = out.where(F.col(MONTH) >= since) if since is not None else out
    return out.selectExpr(
        ref(key),
        MONTH,
        *[
            named(f"{_OWN}.{ref(n)}", lag_name(n, 0)) if lag == 0 else ref(lag_name(n, lag))
            for lag, listed in lags.items()
            for n in listed
        ],
    )
