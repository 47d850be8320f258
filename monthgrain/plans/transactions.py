"""Transaction features: net flow, outflow, purchases and card payments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.functions.rowwise import null_safe_sum, or_zero, share
from monthgrain.functions.text import named, ref, text
from monthgrain.months import MONTH, months_back
from monthgrain.operators.cleaning import fill_numbers, rename_if_absent
from monthgrain.operators.history import KEY, Lags, attach_history, lag_name
from monthgrain.operators.snapshots import scan_snapshot
from monthgrain.operators.stats import change_between, span_stats

# The channels of an outflow row, next to their total.
OUTFLOW_CHANNELS = (
    "withdrawal",
    "transfer_to_mandiri",
    "transfer_to_others",
    "bill_payment",
    "trx_others",
)
OUTFLOW_TOTAL = "trx_total"

# Card payment categories by group.
EDC_GROUPS: dict[str, tuple[str, ...]] = {
    "luxury": ("jewelry", "antique"),
    "health": ("hospital", "medical"),
    "vehicle": ("spbu", "vehiclepart", "vehicle"),
    "household": ("buildingmaterial", "household", "furniture"),
    "daily_life": (
        "fastfood",
        "electrical",
        "telco",
        "utilities",
        "transportation",
        "othersprod",
        "miscprod",
        "mini_market",
        "supermarket",
        "deptstore",
    ),
    "services": ("finservices", "specialorg", "profservices", "eduserv", "govserv"),
    "leisure_hobby": ("fashion", "restaurant", "bookstores", "hobbies", "electronic"),
    "travel": ("hotel", "airlines"),
    "offus": ("offus",),
}

def _lags(anchor: Sequence[str], older: Sequence[str]) -> Lags:
    return {0: anchor} | {lag: older for lag in range(1, 6)}


def _anchor_named(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add the anchor's columns under their own names."""
    return wide.selectExpr("*", *[named(ref(lag_name(n, 0)), n) for n in names])


def _trends(measures: Mapping[str, str]) -> list[str]:
    """Changes and 3/6-month statistics; ``measures`` maps each to the stem of its outputs."""
    changes, stats = [], []
    for source, stem in measures.items():
        changes += [change_between(source, stem, 0, 2), change_between(source, stem, 2, 5)]
        stats += span_stats(source, stem)
    return changes + stats


def _own(names: Sequence[str]) -> list[str]:
    """The key, the month and the anchor's measures, whatever they are called."""
    return [ref(c) for c in (KEY, MONTH, *names)]


def _zero_filled(names: Sequence[str]) -> dict[str, str]:
    return {n: or_zero(ref(n)) for n in names}


# Net flow ------------------------------------------------------------------------------------


def trx_net(
    df: DataFrame,
    snapshot: str | None = None,
    since: str | None = None,
    until: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Credits and debits of the anchor month, their difference, and their trends."""
    rows = fill_numbers(rename_if_absent(df, "cif", KEY))
    names = [c for c in rows.columns if c not in (KEY, MONTH)]
    lags = _lags(names, ("sum_db", "sum_cd"))
    wide = attach_history(rows, lags, snapshot, unique=unique, since=since, until=until)
    wide = _anchor_named(wide, names)
    return wide.selectExpr(
        *_own(names),
        "sum_cd - sum_db AS sum_cd_db_diff",
        "num_cd - num_db AS num_cd_db_diff",
        *_trends({"sum_db": "db", "sum_cd": "cd"}),
    )


# Outflow -------------------------------------------------------------------------------------


def _outflow_measures(rows: DataFrame, measures: Sequence[str] | None) -> list[str]:
    """The measures asked for, or else all numbers."""
    if measures is not None:
        return list(measures)
    ids = (KEY, "cifno_pengirim", "rekening_pengirim", MONTH)
    return [
        f.name
        for f in rows.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in ids
    ]


def _outflow_shares(measures: Sequence[str]) -> list[str]:
    return [
        named(share(c, OUTFLOW_TOTAL), f"{c}_per") for c in OUTFLOW_CHANNELS if c in measures
    ]


def outflow_shares(
    df: DataFrame, snapshot: str | None = None, measures: Sequence[str] | None = None
) -> DataFrame:
    """Outflow summed by customer and month, and each channel's share of the total."""
    rows = rename_if_absent(df, "cifno_pengirim", KEY)
    measures = _outflow_measures(rows, measures)
    if snapshot is not None:
        rows = scan_snapshot(rows, snapshot)
    sums = [F.expr(named(f"sum({v})", n)) for n, v in _zero_filled(measures).items()]
    return rows.groupBy(KEY, MONTH).agg(*sums).selectExpr("*", *_outflow_shares(measures))


def trx_outflow(
    df: DataFrame,
    snapshot: str | None = None,
    measures: Sequence[str] | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Outflow and shares of the anchor month, and the trend of the total."""
    rows = rename_if_absent(df, "cifno_pengirim", KEY)
    measures = _outflow_measures(rows, measures)
    lags = _lags(measures, (OUTFLOW_TOTAL,))
    sums = _zero_filled(measures)
    wide = attach_history(rows, lags, snapshot, sums=sums, since=since, until=until)
    wide = _anchor_named(wide, measures)
    return wide.selectExpr(
        *_own(measures), *_outflow_shares(measures), *_trends({OUTFLOW_TOTAL: "trxout"})
    )


# Purchases -----------------------------------------------------------------------------------


def _by_type(rows: DataFrame) -> DataFrame:
    """One row per customer, month and type, so that no row is held against every type."""
    return rows.groupBy(KEY, MONTH, "transaction_type").agg(
        F.sum("frek").alias("frek"), F.sum("nominal").alias("nominal")
    )


def _reject_clashes(types: Sequence[str]) -> None:
    """Types that would make the same columns, also as the totals, are an error."""
    seen = {"sum_purchase": "the totals"}
    for t in types:
        if (other := seen.get(t.lower())) is not None:
            raise ValueError(f"transaction type {t!r} has the same columns as {other}")
        seen[t.lower()] = repr(t)


def _purchase_measures(types: Sequence[str]) -> dict[str, str]:
    """Row expressions to add up: one pair per type, and totals over all types.

    The totals cover types that are not listed, too.
    """
    _reject_clashes(types)
    count, amount = or_zero("frek"), or_zero("nominal")
    measures = {}
    for t in types:
        of_type = f"transaction_type = {text(t)}"
        measures[f"{t}_freq"] = f"CASE WHEN {of_type} THEN {count} ELSE 0D END"
        measures[f"{t}_amt"] = f"CASE WHEN {of_type} THEN {amount} ELSE 0D END"
    return {**measures, "sum_purchase_freq": count, "sum_purchase_amt": amount}


def _purchase_shares(types: Sequence[str]) -> list[str]:
    return [
        named(share(ref(f"{t}_amt"), "sum_purchase_amt"), f"{t}_amt_per") for t in types
    ]


def purchase_pivot(df: DataFrame, types: Sequence[str], snapshot: str | None = None) -> DataFrame:
    """Count and amount per transaction type as columns, with totals and amount shares.

    The types are given, so there is no extra job to find them and the columns are the same
    for every month.
    """
    rows = rename_if_absent(df, "customer_no", KEY)
    if snapshot is not None:
        rows = scan_snapshot(rows, snapshot)
    sums = [F.expr(named(f"sum({v})", n)) for n, v in _purchase_measures(types).items()]
    pivoted = _by_type(rows).groupBy(KEY, MONTH).agg(*sums)
    return pivoted.selectExpr("*", *_purchase_shares(types))


def trx_outflow_purchase(
    df: DataFrame,
    snapshot: str | None = None,
    types: Sequence[str] | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Purchase pivot of the anchor month and the trend of the purchase amount.

    The types are configuration and have to be given, so that every month has the same columns.
    """
    rows = rename_if_absent(df, "customer_no", KEY)
    if types is None:
        raise ValueError("transaction types must be given")
    sums = _purchase_measures(types)
    lags = _lags(list(sums), ("sum_purchase_freq", "sum_purchase_amt"))
    if snapshot is not None:
        rows = scan_snapshot(rows, *months_back(snapshot, len(lags)))
    wide = attach_history(_by_type(rows), lags, snapshot, sums=sums, since=since, until=until)
    wide = _anchor_named(wide, list(sums))
    return wide.selectExpr(
        *_own(list(sums)),
        *_purchase_shares(types),
        *_trends({"sum_purchase_amt": "purchase_amt"}),
    )


# Card payments -------------------------------------------------------------------------------

_EDC_MEASURES = ("freq", "sv")
_EDC_TOTALS = tuple(f"sum_{m}" for m in _EDC_MEASURES)


def _group_sums(columns: Sequence[str], groups: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Sums over the categories of each group that are present."""
    return {
        f"{group}_{m}": null_safe_sum([f"{c}_{m}" for c in listed if f"{c}_{m}" in columns])
        for m in _EDC_MEASURES
        for group, listed in groups.items()
    }


def _edc_totals(columns: Sequence[str], groups: Mapping[str, Sequence[str]]) -> list[str]:
    """Grand totals straight from the categories."""
    sums = _group_sums(columns, groups)
    return [
        named(" + ".join(sums[f"{g}_{m}"] for g in groups), f"sum_{m}") for m in _EDC_MEASURES
    ]


def _rolled_up(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add group sums, the grand totals where they are not there yet, and group shares.

    Some groups are named like one of their categories; the group sum takes that column's
    place. Sums are always made from the categories themselves.
    """
    sums = _group_sums(df.columns, groups)
    rolled = df.selectExpr(
        *[ref(c) for c in df.columns if c not in sums], *[named(v, n) for n, v in sums.items()]
    )
    totals = [
        named(null_safe_sum([f"{g}_{m}" for g in groups]), f"sum_{m}")
        for m in _EDC_MEASURES
        if f"sum_{m}" not in df.columns
    ]
    return rolled.selectExpr("*", *totals).selectExpr(
        "*", *[named(share(f"{g}_sv", "sum_sv"), f"{g}_sv_per") for g in groups]
    )


def edc_groups(
    df: DataFrame,
    snapshot: str | None = None,
    groups: Mapping[str, Sequence[str]] = EDC_GROUPS,
) -> DataFrame:
    """Card payments of a month rolled up from categories to groups."""
    rows = fill_numbers(df if snapshot is None else scan_snapshot(df, snapshot))
    return _rolled_up(rows, groups)


def debit_edc(
    df: DataFrame,
    snapshot: str | None = None,
    groups: Mapping[str, Sequence[str]] = EDC_GROUPS,
    since: str | None = None,
    until: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Card payment groups of the anchor month and the trends of their totals.

    Older months carry only their two totals through the shuffle; groups and shares of the
    anchor month are made from its categories afterwards. In a backfill the categories cross
    the only shuffle as one packed column.
    """
    filled = fill_numbers(df)
    rows = filled.selectExpr("*", *_edc_totals(filled.columns, groups))
    names = [c for c in rows.columns if c not in (KEY, MONTH)]
    lags = _lags(names, _EDC_TOTALS)
    wide = attach_history(rows, lags, snapshot, unique=unique, since=since, until=until)
    history = {lag_name(n, lag) for lag, listed in lags.items() for n in listed}
    wide = _rolled_up(_anchor_named(wide, names), groups)
    own = [ref(c) for c in wide.columns if c not in history]
    return wide.selectExpr(*own, *_trends({"sum_sv": "sv", "sum_freq": "freq"}))
