"""The same queries as plain SQL for DuckDB, written apart from the engine.

History is spelled out as left joins of one relation per month, pivots as filtered sums, and
so on, so that an error in the engine's formulation does not repeat itself here. Rounded
values have 0.0 added, which turns a negative zero into a plain one.
"""

from __future__ import annotations

from checks.relations import CALL_MONTH, CATEGORIES, CELLS, OPENED, PURCHASE_TYPES

ANCHOR = "200106"
# Written out, not computed: the six months up to the anchor.
ANCHOR_MONTHS = ["200106", "200105", "200104", "200103", "200102", "200101"]

# Names of the columns, channels and card categories by group.
CHANNELS = [
    "withdrawal",
    "transfer_to_mandiri",
    "transfer_to_others",
    "bill_payment",
    "trx_others",
]
BALANCES = ["avg", "sdev", "med", "mx", "mn", "qt1", "qt3", "d20", "eom", "nod"]
DERIVED = ["delta_days", "mxdt_range", "mndt_range", "delta_max_min_bal"]
GROUPS = {
    "luxury": ["jewelry", "antique"],
    "health": ["hospital", "medical"],
    "vehicle": ["spbu", "vehiclepart", "vehicle"],
    "household": ["buildingmaterial", "household", "furniture"],
    "daily_life": [
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
    ],
    "services": ["finservices", "specialorg", "profservices", "eduserv", "govserv"],
    "leisure_hobby": ["fashion", "restaurant", "bookstores", "hobbies", "electronic"],
    "travel": ["hotel", "airlines"],
    "offus": ["offus"],
}

LI = """
li as (
  select cast(o_custkey as varchar) as cifno, strftime(l_shipdate, '%Y%m') as snapshot_date,
    cast(l_shipdate as date) as shipped, cast(l_extendedprice as decimal(18,2)) as price,
    o_custkey, l_orderkey, l_linenumber, l_returnflag, l_linestatus, p_size, p_type
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
)"""


def _lines(items: list[str]) -> str:
    return ",\n    ".join(items)


def _shifted(c: str) -> str:
    return (
        f"case when o_custkey % 17 = 0 then cast({c} + interval 1 month + interval 1 day as date) "
        f"when o_custkey % 19 = 0 then null else {c} end as {c}"
    )


FX_CIFSUMM = f"""
cif0 as (
  select o_custkey, cifno, snapshot_date,
    (cast(sum(price) * 100 as bigint) // count(price)) / 100.0::double as avg,
    round(stddev_samp(cast(price as double)), 2) as sdev,
    cast(quantile_disc(price, 0.5) as double) as med,
    cast(quantile_disc(price, 0.25) as double) as qt1,
    cast(quantile_disc(price, 0.75) as double) as qt3,
    cast(max(price) as double) as mx, cast(min(price) as double) as mn,
    cast(sum(price) filter (where day(shipped) <= 20) as double) as d20,
    cast(sum(price) as double) as eom,
    cast(count(distinct day(shipped)) as double) as nod,
    list(shipped order by price desc, shipped)[1] as mxdt,
    list(shipped order by price, shipped)[1] as mndt
  from li group by all
),
fx_cifsumm as (
  select * exclude (o_custkey, mxdt, mndt), {_shifted("mxdt")}, {_shifted("mndt")},
    avg as avgd, mn as mnd, eom as eomd
  from cif0
)"""


def _range(c: str) -> str:
    return (
        f"case when {c} is null then -1 when day({c}) <= 10 then 1 when day({c}) <= 20 then 2 "
        f"else 3 end as {c}_range"
    )


BALANCE_CLEAN = f"""
bounds as (
  select *, cast(strptime(snapshot_date || '01', '%Y%m%d') as date) as first_day from fx_cifsumm
),
valid as (
  select * replace (
    case when mxdt >= first_day - 1 and mxdt <= first_day + interval 1 month then mxdt end as mxdt,
    case when mndt >= first_day - 1 and mndt <= first_day + interval 1 month then mndt end as mndt
  ) from bounds
),
bal as (
  select * exclude (first_day), dayname(mxdt) as weekday_mxdt, dayname(mndt) as weekday_mndt,
    {_range("mxdt")}, {_range("mndt")},
    cast(datediff('day', mndt, mxdt) as integer) as delta_days, mx - mn as delta_max_min_bal
  from valid
)"""

FX_TRAN_NET = """
fx_tran_net as (
  select cifno, snapshot_date,
    cast(sum(price) filter (where l_linestatus = 'O') as double) as sum_cd,
    cast(sum(1) filter (where l_linestatus = 'O') as double) as num_cd,
    cast(sum(price) filter (where l_linestatus = 'F') as double) as sum_db,
    cast(sum(1) filter (where l_linestatus = 'F') as double) as num_db
  from li group by all
)"""

_CHANNEL_SUMS = _lines(
    [
        f"cast(sum(price) filter (where l_returnflag = '{flag}' and l_linestatus = '{status}') "
        f"as double) as {c}"
        for c, (flag, status) in zip(CHANNELS, CELLS)
    ]
)
FX_OUTFLOW = f"""
fx_outflow as (
  select cifno as cifno_pengirim, cast(l_orderkey as varchar) as rekening_pengirim, snapshot_date,
    {_CHANNEL_SUMS},
    cast(sum(price) as double) as trx_total
  from li group by all
)"""

OUTFLOW = f"""
outflow as (
  select cifno_pengirim as cifno, snapshot_date,
    {_lines([f"sum(coalesce({c}, 0)) as {c}" for c in [*CHANNELS, "trx_total"]])}
  from fx_outflow group by all
)"""

FX_PURCHASE = """
fx_purchase as (
  select cifno as customer_no, p_type as transaction_type, 1.0::double as frek,
    cast(price as double) as nominal, snapshot_date
  from li
)"""

_TYPE_SUMS = _lines(
    [
        f"coalesce(sum(frek) filter (where transaction_type = '{t}'), 0) as \"{t}_freq\",\n    "
        f"coalesce(sum(nominal) filter (where transaction_type = '{t}'), 0) as \"{t}_amt\""
        for t in PURCHASE_TYPES
    ]
)
PURCHASE = f"""
pivoted as (
  select customer_no as cifno, snapshot_date,
    {_TYPE_SUMS}
  from fx_purchase group by all
),
purchase as (
  select *, {" + ".join(f'"{t}_freq"' for t in PURCHASE_TYPES)} as sum_purchase_freq,
    {" + ".join(f'"{t}_amt"' for t in PURCHASE_TYPES)} as sum_purchase_amt
  from pivoted
)"""

_CATEGORY_SUMS = _lines(
    [
        f"cast(sum(1) filter (where p_size % 33 = {i}) as double) as {c}_freq,\n    "
        f"cast(sum(price) filter (where p_size % 33 = {i}) as double) as {c}_sv"
        for i, c in enumerate(CATEGORIES)
    ]
)
FX_EDC = f"""
fx_edc as (
  select cifno, snapshot_date,
    {_CATEGORY_SUMS}
  from li group by all
)"""


def _group_sums(measure: str) -> list[str]:
    return [
        " + ".join(f"coalesce({c}_{measure}, 0)" for c in listed) + f" as g_{g}_{measure}"
        for g, listed in GROUPS.items()
    ]


_NAMED_LIKE_GROUPS = [c for c in CATEGORIES if c in GROUPS]
EDC_COLUMNS = [f"{c}_{m}" for c in CATEGORIES if c not in GROUPS for m in ("freq", "sv")] + [
    f"{g}_{m}" for g in GROUPS for m in ("freq", "sv")
]
EDC = f"""
grouped as (
  select *, {_lines(_group_sums("freq") + _group_sums("sv"))}
  from fx_edc
),
edc as (
  select cifno, snapshot_date,
    {_lines([f"coalesce({c}_{m}, 0) as {c}_{m}" for c in CATEGORIES if c not in GROUPS for m in ("freq", "sv")])},
    {_lines([f"g_{g}_{m} as {g}_{m}" for g in GROUPS for m in ("freq", "sv")])},
    {" + ".join(f"g_{g}_freq" for g in GROUPS)} as sum_freq,
    {" + ".join(f"g_{g}_sv" for g in GROUPS)} as sum_sv
  from grouped
)"""

_OPEN_NAMES = [f"{p}{e}stopn" for p in OPENED for e in "fl"]
_OPEN_AGGS = [
    f"{'min' if e == 'f' else 'max'}(opened) filter (where p_type = '{kind}') as {p}{e}stopn"
    for p, kind in OPENED.items()
    for e in "fl"
]


def _dated(c: str) -> str:
    return (
        f"case when {c} is null then null when o_custkey % 13 = 0 then '1900-01-01' "
        f"when o_custkey % 29 = 0 then '2999-12-31' else strftime({c}, '%Y-%m-%d') end as {c}"
    )


FX_PHSUMM = f"""
opened as (
  select *, cast(shipped - to_years(cast(18 + o_custkey % 6 as integer)) as date) as opened from li
),
ph0 as (
  select o_custkey, cifno, snapshot_date,
    {_lines([f"cast(4 * sum(1) filter (where p_size % 18 + 1 = {k}) as double) as t{k}" for k in range(1, 19)])},
    cast(4 * count(*) as double) as n_lines,
    cast(sum(price) filter (where p_size % 18 + 1 between 12 and 17) as double) as loanall_s,
    {_lines(_OPEN_AGGS)}
  from opened group by all
),
fx_phsumm as (
  select * exclude (o_custkey, n_lines, {", ".join(_OPEN_NAMES)}),
    {_lines([_dated(c) for c in _OPEN_NAMES])},
    case when o_custkey % 23 <> 0 then n_lines end as totph
  from ph0
)"""

FX_AVR = """
fx_avr as (
  select cifno, snapshot_date,
    case when l_linenumber <> 7 then cast(price as double) end as sum_end_bal,
    case when l_orderkey % 10 <> 0 then cast(3 * l_linenumber as double) end as nb_accts
  from li
)"""

FX_CARD = f"""
fx_card as (
  select cifno, snapshot_date,
    {_lines([f"cast(count(*) filter (where l_returnflag = '{f}') as double) as cnt_{f.lower()}" for f in "ANR"])}
  from li group by all
)"""

FX_CALL = f"""
fx_call as (
  select 'R' || user_id as accnumber,
    case event_type when 'view' then '101' when 'click' then '202' when 'signup' then '500'
      when 'purchase' then '901' when 'error' then 'ERR' end as callid,
    strftime(ts, '%Y-%m-%d') as calldate, '{CALL_MONTH}' as snapshot_date
  from events
)"""

FX_MAPPING = """
fx_mapping as (
  select cast(c_custkey as varchar) as cifno, 'R' || c_custkey as rekening from customer
)"""

FX_DIRTY = f"""
fx_dirty as (
  select
    case when c_custkey % 5 = 0 then '(null)' else ' C' || c_custkey end as "Cus No",
    case when c_custkey % 7 = 0 then ' (null) ' when c_custkey % 8 = 0 then ''
      else ' ' || c_mktsegment || ' ' end as " Seg,ment",
    case when c_custkey % 9 = 0 then 'n/a' when c_custkey % 11 = 0 then '(null)'
      else cast(cast(c_acctbal as decimal(18,2)) as varchar) end as "Bal(IDR)",
    '2001-06-' || lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0')
      || case when c_custkey % 6 = 0 then ' 00:00:00' else '' end as "Open Date",
    case when c_custkey % 10 = 0 then '(null)' else '0' || c_custkey end as "Rekening",
    '{CALL_MONTH}' as snapshot_date
  from customer
)"""

FX_FEATURES = """
v1 as (
  select cifno, snapshot_date, cast(sum(price) as double) as amount, count(*) as items
  from li group by all
),
v2 as (
  select cast(o_custkey as varchar) as cifno, strftime(o_orderdate, '%Y%m') as snapshot_date,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as amount, count(*) as items
  from orders group by all
)"""


def _query(relations: list[str], body: str) -> str:
    return "with " + ",".join(r.strip("\n") for r in relations) + "\n" + body


def _rounded(names: list[str]) -> str:
    return _lines([f'round("{n}", 4) + 0.0 as "{n}"' for n in names])


def _joined(relation: str, lags: dict[int, list[str]]) -> str:
    """One month of ``relation`` per lag, left-joined on the customer."""
    columns = [f'm{i}."{c}" as "{c}_lag{i}"' for i, listed in lags.items() for c in listed]
    joins = "".join(
        f"\n  left join (select * from {relation} where snapshot_date = '{ANCHOR_MONTHS[i]}') m{i}"
        " using (cifno)"
        for i in lags
        if i > 0
    )
    return (
        f"select m0.cifno, m0.snapshot_date,\n    {_lines(columns)}\n  from "
        f"(select * from {relation} where snapshot_date = '{ANCHOR}') m0{joins}"
    )


def _joined_all_months(relation: str, lags: dict[int, list[str]]) -> str:
    """Every month of ``relation`` as anchor, earlier months joined on a month number.

    The relation is computed once, with that number as a column to join on.
    """
    columns = [f'm{i}."{c}" as "{c}_lag{i}"' for i, listed in lags.items() for c in listed]
    joins = "".join(
        f"\n  left join numbered m{i} on m{i}.cifno = m0.cifno and m{i}.later{i} = m0.number"
        for i in lags
        if i > 0
    )
    later = ", ".join(f"number + {i} as later{i}" for i in lags if i > 0)
    return f"""with plain as materialized (
    select *, cast(substr(snapshot_date, 1, 4) as integer) * 12
      + cast(substr(snapshot_date, 5, 2) as integer) as number
    from {relation}),
  numbered as materialized (select *, {later} from plain)
  select m0.cifno, m0.snapshot_date,
    {_lines(columns)}
  from numbered m0{joins}"""


def _mean(source: str, span: int) -> str:
    lags = [f'"{source}_lag{i}"' for i in range(span)]
    total = " + ".join(f"coalesce({c}, 0)" for c in lags)
    filled = " + ".join(f"(case when {c} is null then 0 else 1 end)" for c in lags)
    return f"({total}) / greatest({filled}, 1)"


def _over(function: str, source: str, span: int) -> str:
    return f"{function}({', '.join(f'{source}_lag{i}' for i in range(span))})"


def _trend(source: str, stem: str) -> list[str]:
    def change(recent: int, past: int, name: str) -> str:
        r, p = f"{source}_lag{recent}", f"{source}_lag{past}"
        return (
            f"round(case when {p} > 0 then ({r} - {p}) / {p} "
            f"when {p} = 0 and {r} <> 0 then {r} else 0.0 end, 4) + 0.0 as {stem}_{name}_diff"
        )

    out = [change(0, 2, "lm_lm3"), change(2, 5, "lm3_lm6")]
    for span in (3, 6):
        out += [
            f"round({_over('greatest', source, span)}, 4) + 0.0 as max_{stem}_lm{span}",
            f"round({_over('least', source, span)}, 4) + 0.0 as min_{stem}_lm{span}",
            f"round({_mean(source, span)}, 4) + 0.0 as mean_{stem}_lm{span}",
        ]
    return out


def _share(part: str, total: str, name: str) -> str:
    return f'round(case when {total} > 0 then {part} / {total} else 0.0 end, 4) + 0.0 as "{name}"'


# Balance -------------------------------------------------------------------------------------

_RECENT = BALANCES + DERIVED
_BALANCE_LAGS = {
    0: [*_RECENT, "weekday_mxdt", "weekday_mndt"],
    1: _RECENT,
    2: _RECENT,
    3: ["avg", "mx", "mn", "eom"],
    4: ["avg", "mx", "mn", "eom"],
    5: ["avg", "mx", "mn", "eom"],
}
_BALANCE_BASE = [LI, FX_CIFSUMM, BALANCE_CLEAN]
_NOT_ROUNDED = ["delta_days", "mxdt_range", "mndt_range", "weekday_mxdt", "weekday_mndt"]


def _balance_features() -> list[str]:
    out = [f"{c}_lag0 as {c}" for c in _NOT_ROUNDED]
    out += [f"round({c}_lag0, 4) + 0.0 as {c}" for c in [*BALANCES, "delta_max_min_bal"]]
    for span in (3, 6):
        out += [
            f"round({_over('greatest', 'mx', span)}, 4) + 0.0 as max_bal_{span}mth",
            f"round({_over('least', 'mn', span)}, 4) + 0.0 as min_bal_{span}mth",
            f"round({_mean('avg', span)}, 4) + 0.0 as avg_bal_{span}mth",
        ]
    for i in (0, 1):
        now, before, tag = f"avg_lag{i}", f"avg_lag{i + 1}", f"t{i + 1}-{i + 2}"
        out += [
            f'round({now} - {before}, 4) + 0.0 as "delta_avg_bal_{tag}"',
            f'round(({now} - {before}) / nullif({before}, 0), 4) + 0.0 as "ratio_avg_bal_{tag}"',
        ]
    return out


BALANCE_WINDOW = [
    *_BALANCE_BASE,
    f"wide as ({_joined('bal', _BALANCE_LAGS)})",
    f"balance_window as (select cifno, snapshot_date, {_lines(_balance_features())} from wide)",
]

# Loans ---------------------------------------------------------------------------------------

_LOAN_FLAGS = [
    f"case when loanall_s_lag{i} > loanall_s_lag{i + 1} then 1 else 0 end as loan_inc_flag_{i}"
    for i in range(3)
]
LOAN_DIFF = [
    f"loan_wide as ({_joined('fx_phsumm', {i: ['loanall_s'] for i in range(4)})})",
    f"loan_flags as (select *, {_lines(_LOAN_FLAGS)} from loan_wide)",
    """loan_diff as (
  select cifno, snapshot_date, loan_inc_flag_0 + loan_inc_flag_1 + loan_inc_flag_2
      as loan_recent_inc_count, loanall_s_lag0 * 0.08::double as loan_to_debit,
    loan_inc_flag_0, loan_inc_flag_1, loan_inc_flag_2
  from loan_flags
)""",
]

_WINDOW_NUMBERS = [
    *BALANCES,
    "delta_max_min_bal",
    *[f"{s}_bal_{w}mth" for w in (3, 6) for s in ("max", "min", "avg")],
    *[f"{s}_avg_bal_{t}" for t in ("t1-2", "t2-3") for s in ("delta", "ratio")],
]
_LOAN_TARGETS = [
    "avg",
    "mx",
    "mn",
    "eom",
    "max_bal_3mth",
    "max_bal_6mth",
    "avg_bal_3mth",
    "avg_bal_6mth",
    "delta_avg_bal_t1-2",
    "delta_avg_bal_t2-3",
]


def _balance_loan() -> str:
    columns = [f"w.{c}" for c in ("weekday_mxdt", "weekday_mndt")]
    columns += [f"coalesce(w.{c}, 0) as {c}" for c in ("delta_days", "mxdt_range", "mndt_range")]
    columns += [f'round(coalesce(w."{c}", 0), 4) + 0.0 as "{c}"' for c in _WINDOW_NUMBERS]
    columns += [
        f'round(coalesce(w."{c}", 0) - coalesce(l.loan_to_debit, 0), 4) + 0.0 as "{c}_loan"'
        for c in _LOAN_TARGETS
    ]
    return f"select w.cifno, w.snapshot_date, {_lines(columns)}\nfrom exact w left join loan_diff l using (cifno)"


# The loan query starts from unrounded features, so that nothing is rounded twice.
_EXACT_FEATURES = [
    f.removeprefix("round(").replace(", 4) + 0.0 as ", " as ") if f.startswith("round(") else f
    for f in _balance_features()
]
EXACT_WINDOW = [
    *_BALANCE_BASE,
    f"wide as ({_joined('bal', _BALANCE_LAGS)})",
    f"exact as (select cifno, snapshot_date, {_lines(_EXACT_FEATURES)} from wide)",
]

_DEDUCT = [
    f"round(coalesce(c.{c}, 0), 4) + 0.0 as {c}, "
    f"round(coalesce(c.{c}, 0) - coalesce(l.loan_to_debit, 0), 4) + 0.0 as {c}_loan"
    for c in ("avgd", "mnd", "eomd")
]

# Holdings ------------------------------------------------------------------------------------

_T = [f"t{i}" for i in range(1, 19)]
_CAPPED = [f"least(coalesce({t}, 0), 5) as {t}" for t in _T]
_HELD = f"""held as (
  select cifno, snapshot_date, loanall_s as loanall, {_lines(_CAPPED)},
    least(totph, 15) as totph, {", ".join(_OPEN_NAMES)}
  from fx_phsumm where snapshot_date = '{ANCHOR}' and totph <> t12
)"""
_TOTALS = f"""least(11, {" + ".join(_T[:9])}) as tot_saving,
    least(4, {" + ".join(_T[11:17])}) as tot_loan"""


def _clamped(c: str) -> str:
    d = f"try_strptime({c}, '%Y-%m-%d')::date"
    return (
        f"case when {d} < date '1980-01-01' and {d} > date '1917-01-01' then date '1980-01-01' "
        f"when {d} > date '2001-06-30' then null else {d} end as {c}"
    )


def _age(expression: str, name: str) -> str:
    return (
        f"round(datediff('day', {expression}, date '2001-06-30') / 30.44::double, 4) + 0.0 as {name}"
    )


# Labels --------------------------------------------------------------------------------------

_CALLS = [
    FX_CALL,
    FX_MAPPING,
    f"""calls as (
  select m.cifno, case when try_cast(callid as integer) >= 901 then 1 else 0 end as label
  from fx_call c join fx_mapping m on c.accnumber = m.rekening
  where try_cast(callid as integer) >= 202 and c.snapshot_date = '{CALL_MONTH}'
)""",
]

# Cleaning ------------------------------------------------------------------------------------


def _tidy(c: str) -> str:
    return rf"trim(nullif(regexp_replace({c}, '\b00:00:00\b', '', 'g'), '(null)'))"


_TIDIED = f"""tidied as (
  select {_tidy('"Cus No"')} as cus_no, {_tidy('" Seg,ment"')} as seg_ment,
    {_tidy('"Bal(IDR)"')} as bal_idr, {_tidy('"Open Date"')} as open_date,
    {_tidy('"Rekening"')} as rekening, snapshot_date
  from fx_dirty
)"""

_CUSTOMER_TEXT = """cast(c_custkey as varchar) as c_custkey, c_name,
  cast(c_nationkey as varchar) as c_nationkey,
  cast(cast(c_acctbal as decimal(18,2)) as varchar) as c_acctbal, c_mktsegment"""


#: Queries over rows known to be unique, and those with the same result.
UNIQUE = {
    "balance_window_unique": "balance_window",
    "trx_net_unique": "trx_net",
    "trx_net_backfill_unique": "trx_net_backfill",
    "edc_unique": "edc_features",
    "loan_diff_unique": "loan_diff",
    "balance_window_bucketed": "balance_window",
    "balance_window_rolling": "balance_window",
    "balance_window_backfill_unique": "balance_window_backfill",
    "edc_backfill_unique": "edc_backfill",
    "avr_balance_exact": "avr_balance",
    "roundtrip_catalog": "roundtrip_partition_overwrite",
}


def statements() -> dict[str, str]:
    """The SQL of every query; for rows known to be unique the results are the same."""
    found = _statements()
    for name, same in UNIQUE.items():
        found[name] = found[same]
    return found


def _statements() -> dict[str, str]:
    bal = [*_BALANCE_BASE]
    net = [LI, FX_TRAN_NET]
    return {
        "scan_snapshot": _query(
            [LI, FX_CIFSUMM],
            f"select * from fx_cifsumm where snapshot_date = '{ANCHOR}'",
        ),
        "lag_history": _query(bal, _joined("bal", _BALANCE_LAGS)),
        "preview_limit": _query(
            [LI, FX_FEATURES],
            "select least(count(*), 7) as shown, least(count(*), 7) as keys from v1",
        ),
        "discover_sources": _query(
            [LI, FX_FEATURES],
            """select place, source, snapshot_date from (values ('folder'), ('catalog')) p(place), (
  select distinct 'amounts' as source, snapshot_date from v1
  union all select distinct 'orders', snapshot_date from v2)""",
        ),
        "empty_months": _query(
            [LI, FX_FEATURES],
            """select m as snapshot_date, count(v1.cifno) as rows,
  case when count(v1.cifno) = 0 then 'amounts has no rows for ' || m end as error
from (values ('199412'), ('199501'), ('200106'), ('203001')) t(m)
left join v1 on snapshot_date = m group by m""",
        ),
        "register_feature": _query(
            [LI, FX_FEATURES],
            """select cifno, amount, items, round(amount / items, 4) + 0.0 as mean, snapshot_date,
  'Amounts and their mean' as comment, 'cifno,snapshot_date' as keys from v2
union all (select cifno, amount, items, null, snapshot_date, 'Amounts and their mean',
  'cifno,snapshot_date' from v1 anti join v2 using (cifno, snapshot_date))""",
        ),
        "stale_months": f"""with months as (
  select i, strftime(date '2000-11-01' + to_months(cast(i as integer)), '%Y%m') as m from range(8) r(i)
)
select 'trx_net' as source, f.m as snapshot_date, 'bank/axa_tran_net/' || d.m as changed
from months f join months d on d.i <= f.i and d.i > f.i - 6
where d.i in (0, 2) and f.i <> 2""",
        "cleaning_losses": _query(
            [FX_DIRTY, _TIDIED],
            """select 'dirty' as source, (select count(*) from tidied) as rows, what, lost from (
  select 'seg_ment' as what, count(*) filter (nullif(seg_ment, '') is not null) as lost from tidied
  union all
  select 'bal_idr', count(*) filter (bal_idr is not null and try_cast(bal_idr as double) is null)
  from tidied
  union all select 'rekening is null', count(*) filter (rekening is null) from tidied
  union all select 'cus_no is null', count(*) filter (cus_no is null) from tidied
) where lost > 0""",
        ),
        "balance_window_absent": _query(
            [
                LI,
                FX_CIFSUMM.replace("fx_cifsumm as", "fx_whole as"),
                "fx_cifsumm as (select * replace (cast(null as double) as qt1, "
                "cast(null as date) as mndt) from fx_whole)",
                BALANCE_CLEAN,
                *BALANCE_WINDOW[-2:],
            ],
            "select * from balance_window",
        ),
        "balance_clean": _query(bal, "select * from bal"),
        "balance_window": _query(BALANCE_WINDOW, "select * from balance_window"),
        "balance_window_backfill": _query(
            [*bal, f"wide as ({_joined_all_months('bal', _BALANCE_LAGS)})"],
            f"select cifno, snapshot_date, {_lines(_balance_features())} from wide",
        ),
        "fill_nulls": _query(
            net,
            "select cifno, snapshot_date, "
            + ", ".join(f"coalesce({c}, 0) as {c}" for c in ("sum_cd", "num_cd", "sum_db", "num_db"))
            + " from fx_tran_net",
        ),
        "trx_net": _trx_net(_joined),
        "trx_net_backfill": _trx_net(_joined_all_months),
        "outflow_shares": _query(
            [LI, FX_OUTFLOW, OUTFLOW],
            f"select cifno, snapshot_date, {_lines(_outflow_now(''))} from outflow",
        ),
        "outflow_features": _outflow(_joined),
        "outflow_backfill": _outflow(_joined_all_months),
        "purchase_pivot": _query(
            [LI, FX_PURCHASE, PURCHASE],
            f"select cifno, snapshot_date, {_lines(_purchase_now(''))} from purchase",
        ),
        "purchase_features": _purchase(_joined),
        "purchase_backfill": _purchase(_joined_all_months),
        "edc_groups": _query(
            [LI, FX_EDC, EDC], f"select cifno, snapshot_date, {_lines(_edc_now(''))} from edc"
        ),
        "edc_features": _edc(_joined),
        "edc_backfill": _edc(_joined_all_months),
        "product_holding": _query(
            [LI, FX_PHSUMM, _HELD],
            f"select * exclude ({', '.join(_OPEN_NAMES)}), {_TOTALS} from held",
        ),
        "product_vintage": _query(
            [
                LI,
                FX_PHSUMM,
                _HELD,
                f"clamped as (select * replace ({_lines([_clamped(c) for c in _OPEN_NAMES])}) from held)",
            ],
            f"""select * exclude ({', '.join(_OPEN_NAMES)}), {_TOTALS},
    {_age('slstopn', 'saving_acct_vint_l')}, {_age('sfstopn', 'saving_acct_vint_f')},
    {_age('greatest(slstopn, dlstopn, glstopn, clstopn)', 'all_acct_vint_l')},
    {_age('least(sfstopn, dfstopn, gfstopn, cfstopn)', 'all_acct_vint_f')}
from clamped""",
        ),
        "saving_account": _query(
            [
                LI,
                FX_PHSUMM,
                f"""totals as (
  select cifno, snapshot_date, {" + ".join(_T[:9])} as tot_saving, t3 + t4 + t9 as tot_undebit_saving
  from (select cifno, snapshot_date, {_lines([f"coalesce({t}, 0) as {t}" for t in _T])} from fx_phsumm)
)""",
            ],
            "select *, round(coalesce(tot_undebit_saving / nullif(tot_saving, 0), 1.0), 4) + 0.0 "
            "as ratio_undebit_saving from totals",
        ),
        "saving_account_nulls": _query(
            [LI, FX_PHSUMM],
            f"""select cifno, snapshot_date, {" + ".join(_T[:9])} as tot_saving,
  t3 + t4 + t9 as tot_undebit_saving,
  round(coalesce((t3 + t4 + t9) / nullif({" + ".join(_T[:9])}, 0), 1.0), 4) + 0.0 as ratio_undebit_saving
from fx_phsumm""",
        ),
        "loan_diff": _query(
            [LI, FX_PHSUMM, *LOAN_DIFF],
            "select * replace (round(loan_to_debit, 4) + 0.0 as loan_to_debit) from loan_diff",
        ),
        "balance_loan": _query([*EXACT_WINDOW, FX_PHSUMM, *LOAN_DIFF], _balance_loan()),
        "balance_deduct": _query(
            [LI, FX_CIFSUMM, FX_PHSUMM, *LOAN_DIFF],
            f"select c.cifno, c.snapshot_date, {_lines(_DEDUCT)}\nfrom fx_cifsumm c "
            f"left join loan_diff l using (cifno) where c.snapshot_date = '{ANCHOR}'",
        ),
        "avr_balance": _query(
            [
                LI,
                FX_AVR,
                f"""month as (select * from fx_avr where snapshot_date = '{ANCHOR}'),
filled as (
  select cifno, snapshot_date, coalesce(sum_end_bal, 0) as bal,
    coalesce(nb_accts, (select quantile_disc(nb_accts, 0.5) from month)) as accts
  from month
)""",
            ],
            "select cifno, snapshot_date, round(sum(bal), 4) + 0.0 as sum_end_bal, "
            "case when sum(accts) > 15 then 15.0::double else sum(accts) end as nb_accts_sd "
            "from filled group by all",
        ),
        "card_type_counts": _query(
            [LI, FX_CARD], f"select * from fx_card where snapshot_date = '{ANCHOR}'"
        ),
        "call_labels": _query(_CALLS, f"select cifno, label, '{CALL_MONTH}' as snapshot_date from calls"),
        "call_labels_by_customer": _query(
            _CALLS,
            f"select cifno, max(label) as label, '{CALL_MONTH}' as snapshot_date from calls group by cifno",
        ),
        "sanitize_columns": _query(
            [FX_DIRTY],
            'select "Cus No" as cus_no, " Seg,ment" as seg_ment, "Bal(IDR)" as bal_idr, '
            '"Open Date" as open_date, "Rekening" as rekening, snapshot_date from fx_dirty',
        ),
        "clean_strings": _query([FX_DIRTY, _TIDIED], "select * from tidied"),
        "standardize_ids": _query(
            [FX_DIRTY, _TIDIED], "select *, coalesce(rekening, cus_no) as cifno from tidied"
        ),
        "harden_types": _query(
            [FX_DIRTY, _TIDIED],
            "select cus_no, try_cast(seg_ment as double) as seg_ment, "
            "try_cast(bal_idr as double) as bal_idr, open_date, "
            "rekening, snapshot_date from tidied",
        ),
        "clean_source": _query(
            [FX_DIRTY, _TIDIED],
            "select cus_no, seg_ment, try_cast(bal_idr as double) as bal_idr, "
            "cast(open_date as date) as open_date, rekening, snapshot_date, "
            "rekening as cifno from tidied",
        ),
        "clean_call_source": f"""select cast(user_id as varchar) as accnumber,
  cast(event_id as varchar) as account_no,
  case when event_id % 7 = 0 then '(null)' else ' ' || event_type end as call_type,
  value as value_1, '{CALL_MONTH}' as snapshot_date from events""",
        "ingest_delimited": f"select {_CUSTOMER_TEXT}, '{CALL_MONTH}' as snapshot_date from customer",
        "ingest_multi_sep": " union all ".join(
            f"select '{name}' as source, {_CUSTOMER_TEXT}, '{CALL_MONTH}' as snapshot_date from customer"
            for name in ("all_status", "tso")
        ),
        "roundtrip_partition_overwrite": _query(
            [LI, FX_FEATURES],
            f"select * from v2 where snapshot_date = '{ANCHOR}' union all "
            f"select * from v1 where snapshot_date <> '{ANCHOR}'",
        ),
        "feature_upsert": _query(
            [LI, FX_FEATURES],
            "select * from v2 union all (select * from v1 anti join v2 using (cifno, snapshot_date))",
        ),
        "run_report": f"""with c as (select count(*) as n from customer)
select stage, source_group, source, '{CALL_MONTH}' as snapshot_date, status,
  case when status = 'ok' then n end as rows,
  error
from c, (values
  ('ingest', 'bank', 'cc_type_cnt', 'missing', 'MissingFile'),
  {", ".join(f"('{stage}', '{g}', '{n}', 'ok', null)"
             for stage in ("ingest", "clean")
             for g, n in (("bank", "cif_acct_mapping"), ("calls", "tso"), ("bank", "same"), ("calls", "same")))}
) as t(stage, source_group, source, status, error)""",
    }


def _trx_net(join) -> str:
    lags = {0: ["sum_cd", "num_cd", "sum_db", "num_db"]}
    lags |= {i: ["sum_db", "sum_cd"] for i in range(1, 6)}
    filled = ", ".join(f"coalesce({c}, 0) as {c}" for c in lags[0])
    columns = [f"round({c}_lag0, 4) + 0.0 as {c}" for c in lags[0]]
    columns += [
        "round(sum_cd_lag0 - sum_db_lag0, 4) + 0.0 as sum_cd_db_diff",
        "round(num_cd_lag0 - num_db_lag0, 4) + 0.0 as num_cd_db_diff",
    ]
    return _query(
        [
            LI,
            FX_TRAN_NET,
            f"net as (select cifno, snapshot_date, {filled} from fx_tran_net)",
            f"wide as ({join('net', lags)})",
        ],
        "select cifno, snapshot_date, "
        f"{_lines(columns + _trend('sum_db', 'db') + _trend('sum_cd', 'cd'))} from wide",
    )


def _outflow_now(suffix: str) -> list[str]:
    out = [f"round({c}{suffix}, 4) + 0.0 as {c}" for c in [*CHANNELS, "trx_total"]]
    return out + [_share(f"{c}{suffix}", f"trx_total{suffix}", f"{c}_per") for c in CHANNELS]


def _outflow(join) -> str:
    lags = {0: [*CHANNELS, "trx_total"]} | {i: ["trx_total"] for i in range(1, 6)}
    return _query(
        [LI, FX_OUTFLOW, OUTFLOW, f"wide as ({join('outflow', lags)})"],
        "select cifno, snapshot_date, "
        f"{_lines(_outflow_now('_lag0') + _trend('trx_total', 'trxout'))} from wide",
    )


def _purchase_now(suffix: str) -> list[str]:
    names = [f"{t}_{m}" for t in PURCHASE_TYPES for m in ("freq", "amt")]
    names += ["sum_purchase_freq", "sum_purchase_amt"]
    out = [f'round("{n}{suffix}", 4) + 0.0 as "{n}"' for n in names]
    total = f"sum_purchase_amt{suffix}"
    return out + [_share(f'"{t}_amt{suffix}"', total, f"{t}_amt_per") for t in PURCHASE_TYPES]


def _purchase(join) -> str:
    names = [f"{t}_{m}" for t in PURCHASE_TYPES for m in ("freq", "amt")]
    totals = ["sum_purchase_freq", "sum_purchase_amt"]
    lags = {0: names + totals} | {i: totals for i in range(1, 6)}
    return _query(
        [LI, FX_PURCHASE, PURCHASE, f"wide as ({join('purchase', lags)})"],
        "select cifno, snapshot_date, "
        f"{_lines(_purchase_now('_lag0') + _trend('sum_purchase_amt', 'purchase_amt'))} from wide",
    )


def _edc_now(suffix: str) -> list[str]:
    out = [f"round({c}{suffix}, 4) + 0.0 as {c}" for c in [*EDC_COLUMNS, "sum_freq", "sum_sv"]]
    return out + [_share(f"{g}_sv{suffix}", f"sum_sv{suffix}", f"{g}_sv_per") for g in GROUPS]


def _edc(join) -> str:
    lags = {0: [*EDC_COLUMNS, "sum_freq", "sum_sv"]}
    lags |= {i: ["sum_sv", "sum_freq"] for i in range(1, 6)}
    return _query(
        [LI, FX_EDC, EDC, f"wide as ({join('edc', lags)})"],
        "select cifno, snapshot_date, "
        f"{_lines(_edc_now('_lag0') + _trend('sum_sv', 'sv') + _trend('sum_freq', 'freq'))} from wide",
    )
