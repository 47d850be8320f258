"""What a month delivered again makes stale, and history kept as a state."""

import random

import pytest

from checks import relations as rel
from monthgrain.months import month_number, month_text, months_back
from monthgrain.operators.history import attach_history
from monthgrain.operators.rolling import advance, anchored, state_of
from monthgrain.plans import balance, job
from monthgrain.sources.manifest import SOURCES
from monthgrain.sources.warehouse import AUDIT, CLEAN, FEATURES, STATE, Warehouse
from tests.conftest import rows
from tests.test_job import FOLDER, landed

LAGS = {0: ("x", "y"), 1: ("x",), 2: ("x",), 3: ("x",)}
MONTHS = months_back("200106", 8)[::-1]


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """Eight months, the fourth of which is late, with features kept up by states."""
    root = str(tmp_path_factory.mktemp("stale"))
    warehouse = Warehouse(spark, f"{root}/wh")
    summary = rel.fx_cifsumm(spark, FOLDER).cache()
    phsumm = rel.fx_phsumm(spark, FOLDER).cache()
    sources = [s for s in SOURCES if s.name in ("cifsumm", "phsumm")]

    def deliver(month, df):
        landed(spark, f"{root}/{id(df)}", "cifsumm", df, month)
        landed(spark, f"{root}/{id(df)}", "phsumm", phsumm, month)
        job.run_ingest(warehouse, f"{root}/{id(df)}", month, sources)
        job.run_cleaning(warehouse, month, sources)

    for month in MONTHS:
        if month != MONTHS[3]:
            deliver(month, summary)
            job.run_features(warehouse, month, ["balance_window"], incremental=True)
    job.run_features(warehouse, MONTHS[-1], ["loan_diff", "balance_loan"])
    yield warehouse, summary, deliver
    summary.unpersist()
    phsumm.unpersist()


def stale(warehouse):
    return sorted((r.source, r.snapshot_date) for r in job.stale_features(warehouse).collect())


def test_features_of_states_equal_those_of_all_months(ran):
    warehouse, summary, _ = ran
    there = summary.where(f"snapshot_date <> '{MONTHS[3]}'")
    for month in (MONTHS[0], MONTHS[4], MONTHS[-1]):
        want = balance.balance_window(there.where(f"snapshot_date >= '{MONTHS[0]}'"), month)
        stored = warehouse.read(FEATURES, "balance_window_features", [month])
        assert rows(stored, *want.columns) == rows(want)
    assert warehouse.stored_months(STATE, "balance_window") == [m for m in MONTHS if m != MONTHS[3]]


def test_delivery_makes_exactly_its_followers_stale(spark, ran, monkeypatch):
    warehouse, summary, deliver = ran
    assert stale(warehouse) == []
    again = summary.selectExpr("* except (mx)", "mx + 1 AS mx")
    deliver(MONTHS[1], again)  # again, with other values
    late = [("balance_window", m) for m in MONTHS[1:7] if m != MONTHS[3]]
    found = stale(warehouse)
    assert found == late
    deliver(MONTHS[3], summary)  # late: nobody has built it, but the five after it lack it
    last = ("balance_window", MONTHS[7])
    assert stale(warehouse) == [*late, last]
    report = job.rebuild_stale(warehouse, incremental=True)
    built = sorted((r.source, r.snapshot_date) for r in report.collect())
    assert built == sorted([*late, last, ("balance_loan", MONTHS[7])])
    assert {r.status for r in report.collect()} == {"ok"} and stale(warehouse) == []
    months = f"snapshot_date >= '{MONTHS[0]}'"
    now = summary.where(f"{months} AND snapshot_date <> '{MONTHS[1]}'").unionByName(
        again.where(f"snapshot_date = '{MONTHS[1]}'")
    )
    for month in MONTHS[4:]:
        want = balance.balance_window(now, month)
        stored = warehouse.read(FEATURES, "balance_window_features", [month])
        assert rows(stored, *want.columns) == rows(want)


def test_a_month_reads_itself_and_one_state(ran, monkeypatch):
    warehouse, _, _ = ran
    read = []
    real = Warehouse.read

    def noted(self, layer, table, months=None, **options):
        read.append((layer, table, tuple(months or ())))
        return real(self, layer, table, months, **options)

    monkeypatch.setattr(Warehouse, "read", noted)
    job.run_features(warehouse, MONTHS[-1], ["balance_window"], incremental=True)
    assert [r[2] for r in read if r[0] == CLEAN] == [(MONTHS[-1],)]
    assert [r[2] for r in read if r[0] == STATE] == [(MONTHS[-2],), (MONTHS[-1],)]
    assert AUDIT in {r[0] for r in read}


def test_states_equal_full_history_over_sparse_months(spark):
    draw = random.Random(7)
    first = month_number("199911")
    data = [
        (f"c{c}", draw.randrange(9) + 0.5, draw.choice([None, 1]), month_text(first + m))
        for c in range(40)
        for m in range(12)
        if draw.random() < 0.35 and m not in (4, 5)  # two months have no rows at all
    ]
    df = spark.createDataFrame(data, "cifno string, x double, y int, snapshot_date string").cache()
    state, before = None, None
    for m in range(12):
        month = month_text(first + m)
        if m == 8:  # a run that was left out: the next one goes over it
            state = advance(state, before, df, LAGS, month).cache()
        elif state is None:
            state = state_of(df, LAGS, month).cache()
        else:
            state = advance(state, before, df, LAGS, month).cache()
        before = month
        want = attach_history(df, LAGS, month)
        assert rows(anchored(state, LAGS), *want.columns) == rows(want)
        assert rows(state) == rows(state_of(df, LAGS, month), *state.columns)
    with pytest.raises(ValueError, match="not before"):
        advance(state, before, df, LAGS, before)
    with pytest.raises(ValueError, match="wanted at lag 1"):
        state_of(df, {0: ("x",), 1: ("y",)}, before)
    with pytest.raises(Exception, match="more than one row"):
        twice = df.union(df.limit(1))
        month = twice.exceptAll(df).first().snapshot_date
        advance(state_of(df, LAGS, "199801"), "199801", twice, LAGS, month).collect()
