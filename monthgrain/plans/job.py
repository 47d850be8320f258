"""The monthly job: ingest files, clean tables, build features, report on every source.

Sources do not depend on each other, so several are submitted at a time and one that fails
does not stop the rest. What happened to each is returned, and stored, as a run report.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from monthgrain.months import MONTH, month_number, months_back
from monthgrain.operators.cleaning import clean_bank_table, clean_call_table
from monthgrain.operators.history import KEY
from monthgrain.operators.merge import duplicated_keys
from monthgrain.operators.snapshots import require_snapshot, stamp_snapshot
from monthgrain.plans import balance, holdings, transactions
from monthgrain.plans.labels import call_labels
from monthgrain.sources.delimited import MissingFile, read_source
from monthgrain.sources.manifest import BANK, CALLS, SOURCES, Source
from monthgrain.sources.warehouse import AUDIT, CLEAN, FEATURES, RAW, STATE, Warehouse

REPORT, BUILDS = "run_report", "builds"
REPORT_SCHEMA = (
    "stage string, source_group string, source string, snapshot_date string, "
    "status string, rows long, error string, losses map<string, long>"
)
#: What was built last, and the version of everything it was built from (none: not there then).
BUILDS_SCHEMA = (
    "stage string, source_group string, source string, snapshot_date string, version string, "
    "inputs map<string, string>"
)

OK, MISSING, EMPTY, FAILED, SKIPPED = "ok", "missing", "empty", "failed", "skipped"

FEATURE_KEYS = (KEY, MONTH)


#: Group and name of a source, or ``FEATURES`` and the name of a feature set.
Name = tuple[str, str]


class NoRows(ValueError):
    """A source has no rows for the month."""


def feature_table(name: str) -> str:
    return f"{name}_features"


def _replace_month(
    warehouse: Warehouse, layer: str, table: str, df: DataFrame, snapshot: str
) -> int:
    """Write the month, in one pass. Without rows nothing is replaced, which is an error."""
    rows = warehouse.replace_months(layer, table, stamp_snapshot(df, snapshot))
    if not rows:
        raise NoRows(f"{layer}/{table} has no rows for {snapshot}")
    return rows


@dataclass(frozen=True)
class Done:
    """What a piece of work has done: rows written, values lost on the way, versions read."""

    rows: int
    losses: dict[str, int] | None = None
    inputs: dict[str, str | None] | None = None


@dataclass(frozen=True)
class Outcome:
    """A row of the run report, and the versions of what was read if it went well."""

    stage: str
    name: Name
    snapshot: str
    status: str
    rows: int | None = None
    error: str | None = None
    losses: dict[str, int] | None = None
    inputs: dict[str, str | None] | None = None

    def row(self) -> tuple:
        return (
            self.stage, *self.name, self.snapshot, self.status, self.rows, self.error, self.losses
        )


def _outcome(stage: str, name: Name, snapshot: str, work: Callable[[], Done]) -> Outcome:
    try:
        done = work()
        return Outcome(stage, name, snapshot, OK, done.rows, None, done.losses, done.inputs or {})
    except MissingFile as error:
        return Outcome(stage, name, snapshot, MISSING, None, f"{type(error).__name__}: {error}")
    except NoRows as error:
        return Outcome(stage, name, snapshot, EMPTY, 0, f"{type(error).__name__}: {error}")
    except Exception as error:
        what = str(error).partition("\n")[0]
        return Outcome(stage, name, snapshot, FAILED, None, f"{type(error).__name__}: {what}")


def _run_all(
    warehouse: Warehouse,
    stage: str,
    snapshot: str,
    work: dict[Name, Callable[[], Done]],
    at_once: int,
) -> list[Outcome]:
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        run = inheritable_thread_target(warehouse.spark)(_outcome)
        runs = [pool.submit(run, stage, name, snapshot, job) for name, job in work.items()]
        return [r.result() for r in runs]


def _skipped(stage: str, names: Iterable[Name], snapshot: str) -> list[Outcome]:
    why = "an earlier stage of this run was not ok"
    return [Outcome(stage, name, snapshot, SKIPPED, None, why) for name in names]


def _not_ok(report: DataFrame) -> set[Name]:
    """What a stage did not bring up to date; later stages must not build on older rows of it."""
    return {(r.source_group, r.source) for r in report.where(f"status <> '{OK}'").collect()}


_BY_SOURCE = (MONTH, "stage", "source_group", "source")


def _report(warehouse: Warehouse, outcomes: Sequence[Outcome]) -> DataFrame:
    """Store outcomes, a row per source, in the audit layer; a source run again replaces its own.

    What went well also replaces its row among the builds, under a new version.
    """
    create = warehouse.spark.createDataFrame
    report = create([o.row() for o in outcomes], REPORT_SCHEMA)
    warehouse.replace_months(AUDIT, REPORT, report.coalesce(1), by=_BY_SOURCE)
    built = [
        (o.stage, *o.name, o.snapshot, uuid.uuid4().hex, o.inputs)
        for o in outcomes
        if o.status == OK
    ]
    if built:
        builds = create(built, BUILDS_SCHEMA).coalesce(1)
        warehouse.replace_months(AUDIT, BUILDS, builds, by=_BY_SOURCE)
    return report


# Ingest --------------------------------------------------------------------------------------


def run_ingest(
    warehouse: Warehouse,
    landing: str,
    snapshot: str,
    sources: Sequence[Source] = SOURCES,
    at_once: int = 4,
) -> DataFrame:
    """Load the month's files as they are into the raw layer; returns the run report."""

    def job(source: Source) -> Callable[[], Done]:
        def run() -> Done:
            df = read_source(warehouse.spark, landing, source, snapshot)
            return Done(_replace_month(warehouse, RAW, source.raw_table, df, snapshot))

        return run

    work = {(s.group, s.name): job(s) for s in sources}
    return _report(warehouse, _run_all(warehouse, "ingest", snapshot, work, at_once))


# Cleaning ------------------------------------------------------------------------------------


def clean_source(
    warehouse: Warehouse,
    source: Source,
    snapshot: str,
    observation: Observation | None = None,
) -> DataFrame:
    """The cleaned month of a raw table; of bank tables an observation counts what is lost."""
    if not warehouse.stored_months(RAW, source.raw_table, [snapshot]):
        raise NoRows(f"{RAW}/{source.raw_table} has no rows for {snapshot}")
    raw = warehouse.read(RAW, source.raw_table, [snapshot])
    if source.group == CALLS:
        return clean_call_table(raw)
    return clean_bank_table(
        raw,
        keep=source.keep,
        dates=source.dates,
        required=source.required,
        observation=observation,
    )


def _check_unique(df: DataFrame, source: Source) -> None:
    """One row per customer, by a count over the id alone; features rely on it."""
    key = KEY if KEY in df.columns else "cif"
    broken = duplicated_keys(df, [key]).take(1)
    if broken:
        raise ValueError(f"{key} of {source.name} is null or repeated: {broken[0].asDict()}")


def run_cleaning(
    warehouse: Warehouse,
    snapshot: str,
    sources: Sequence[Source] = SOURCES,
    at_once: int = 4,
    skip: Collection[Name] = (),
) -> DataFrame:
    """Clean the month of every raw table found; returns the run report.

    Those in ``skip`` keep the clean rows they have, if any, and are reported as skipped.

    Where customers must have one row a month, repeated or missing ids fail the source. Raw
    tables that ``sources`` does not describe are cleaned by the default rules.
    """
    described = {(s.group, s.name): s for s in sources}

    def job(source: Source) -> Callable[[], Done]:
        def run() -> Done:
            if source.unique:
                _check_unique(clean_source(warehouse, source, snapshot), source)
            observed = Observation()
            df = clean_source(warehouse, source, snapshot, observed)
            rows = _replace_month(warehouse, CLEAN, source.clean_table, df, snapshot)
            losses = observed.get if source.group != CALLS else {}
            return Done(rows, {k: n for k, n in losses.items() if n and k != "all rows"})

        return run

    work = {}
    for group in (BANK, CALLS):
        for name in warehouse.sources(RAW, group):
            if (group, name) not in skip:
                work[group, name] = job(described.get((group, name), Source(name, group)))
    outcomes = _run_all(warehouse, "clean", snapshot, work, at_once)
    return _report(warehouse, outcomes + _skipped("clean", skip, snapshot))


# Features ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureSet:
    """A feature set made from one clean table, and from how many months of it.

    With ``advance`` and ``from_state`` its history can be kept from month to month.
    """

    name: str
    source: str
    months: int
    build: Callable[[DataFrame, str], DataFrame]
    advance: Callable[..., DataFrame] | None = None
    from_state: Callable[[DataFrame], DataFrame] | None = None


def _checked(build: Callable[..., DataFrame]) -> Callable[[DataFrame, str], DataFrame]:
    """A builder on a table whose customers are unique, which cleaning has checked."""
    return partial(build, unique=True)


FEATURE_SETS = (
    FeatureSet(
        "balance_window",
        "cifsumm",
        6,
        _checked(balance.balance_window),
        balance.window_state,
        balance.window_from_state,
    ),
    FeatureSet("bank_ph", "phsumm", 1, holdings.bank_ph),
    FeatureSet("loan_diff", "phsumm", 4, _checked(holdings.loan_diff)),
    FeatureSet("saving_acct", "phsumm", 1, holdings.saving_acct),
    FeatureSet("axa_avr", "axa_avr", 1, holdings.axa_avr),
    FeatureSet("trx_net", "axa_tran_net", 6, _checked(transactions.trx_net)),
    FeatureSet("trx_outflow", "trx_outflow", 6, transactions.trx_outflow),
    FeatureSet("debit_edc", "debitcard_trx_edc_cif", 6, _checked(transactions.debit_edc)),
    FeatureSet("credit_type", "cc_type_cnt", 1, holdings.card_types),
    FeatureSet("debit_type", "dc_type_cnt", 1, holdings.card_types),
)


PURCHASES = "trx_outflow_purchase"


def _purchases(types: Sequence[str]) -> FeatureSet:
    """Purchases with a column pair for each configured type; the totals cover all types."""
    build = partial(transactions.trx_outflow_purchase, types=types)
    return FeatureSet(PURCHASES, "trx_outflow_payment_purchase", 6, build)


def _read_clean(warehouse: Warehouse, source: str, snapshot: str, months: int) -> DataFrame:
    """Clean months up to the anchor, which must be there; earlier ones may be missing."""
    table = Source(source).clean_table
    if not warehouse.stored_months(CLEAN, table, [snapshot]):
        raise NoRows(f"{CLEAN}/{table} has no rows for {snapshot}")
    return warehouse.read(CLEAN, table, months_back(snapshot, months))


def _read_features(warehouse: Warehouse, name: str, snapshot: str) -> DataFrame:
    table = feature_table(name)
    if not warehouse.stored_months(FEATURES, table, [snapshot]):
        raise NoRows(f"{FEATURES}/{table} has no rows for {snapshot}")
    return warehouse.read(FEATURES, table, [snapshot])


def _balance_loan(warehouse: Warehouse, snapshot: str) -> DataFrame:
    return balance.balance_loan(
        _read_features(warehouse, "balance_window", snapshot),
        _read_features(warehouse, "loan_diff", snapshot),
    )


def _balance_deduct(warehouse: Warehouse, snapshot: str) -> DataFrame:
    return balance.balance_deduct(
        _read_clean(warehouse, "cifsumm", snapshot, 1),
        _read_features(warehouse, "loan_diff", snapshot),
        snapshot,
    )


#: Feature sets made from others, and what each reads of the same month.
DERIVED_SETS = {"balance_loan": _balance_loan, "balance_deduct": _balance_deduct}
READS = {
    "balance_loan": ((FEATURES, "balance_window"), (FEATURES, "loan_diff")),
    "balance_deduct": ((BANK, "cifsumm"), (FEATURES, "loan_diff")),
}


def save_features(warehouse: Warehouse, name: str, df: DataFrame, snapshot: str) -> int:
    """Stamp features with their month and merge them into ``<name>_features``."""
    return warehouse.upsert(
        FEATURES, feature_table(name), stamp_snapshot(df, snapshot), FEATURE_KEYS
    )


def run_features(
    warehouse: Warehouse,
    snapshot: str,
    names: Sequence[str] | None = None,
    at_once: int = 4,
    purchase_types: Sequence[str] = (),
    skip: Collection[Name] = (),
    incremental: bool = False,
) -> DataFrame:
    """Build and merge the month's feature sets; returns the run report.

    Feature sets that read a source in ``skip``, or one that this run did not bring up to
    date, are reported as skipped.

    ``purchase_types`` are the transaction types that get columns of their own; without them
    purchases cannot be built, which is an error before anything runs. The loan-deducted
    balances come last, as they read other feature sets. ``incremental`` reads, where a
    feature set can, the month and the state of an earlier one in place of all its months.
    """
    if not purchase_types and (names is None or PURCHASES in names):
        raise ValueError(f"{PURCHASES} needs purchase_types, the types that get columns")
    current = _versions(warehouse)

    def job(name: str, build: Callable[[], DataFrame], *read: tuple[Name, str]) -> Callable[[], Done]:
        inputs = {_input(source, month): current.get(_input(source, month)) for source, month in read}
        return lambda: Done(save_features(warehouse, name, build(), snapshot), None, inputs)

    def from_clean(feature_set: FeatureSet) -> Callable[[], Done]:
        source, months = feature_set.source, feature_set.months

        def build() -> DataFrame:
            if incremental and feature_set.advance is not None:
                return _from_state(warehouse, feature_set, snapshot, current)
            return feature_set.build(_read_clean(warehouse, source, snapshot, months), snapshot)

        read = [((BANK, source), month) for month in months_back(snapshot, months)]
        return job(feature_set.name, build, *read)

    def derived(name: str, build: Callable[[Warehouse, str], DataFrame]) -> Callable[[], Done]:
        # what it reads may be built by this run, so versions are looked up then
        def run() -> Done:
            now = _versions(warehouse, [snapshot])
            inputs = {_input(n, snapshot): now.get(_input(n, snapshot)) for n in READS[name]}
            return Done(save_features(warehouse, name, build(warehouse, snapshot), snapshot), None, inputs)

        return run

    feature_sets = (*FEATURE_SETS, _purchases(purchase_types))
    first = {f.name: from_clean(f) for f in feature_sets}
    then = {name: derived(name, build) for name, build in DERIVED_SETS.items()}
    reads = {(FEATURES, f.name): {(BANK, f.source)} for f in feature_sets}
    reads |= {(FEATURES, name): set(read) for name, read in READS.items()}
    reports, stale = [], set(skip)
    for wave in (first, then):
        wanted = {(FEATURES, n): w for n, w in wave.items() if names is None or n in names}
        held_back = [n for n in wanted if reads[n] & stale]
        outcomes = _skipped("features", held_back, snapshot)
        work = {n: w for n, w in wanted.items() if n not in held_back}
        outcomes += _run_all(warehouse, "features", snapshot, work, at_once)
        stale |= {o.name for o in outcomes if o.status != OK}
        if outcomes:
            reports.append(_report(warehouse, outcomes))
    if not reports:
        return warehouse.spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, reports)


def _from_state(
    warehouse: Warehouse, feature_set: FeatureSet, snapshot: str, current: dict[str, str]
) -> DataFrame:
    """Features from the month and the latest usable state, which the month's own then joins.

    A state is usable if all months it was made from are still as they were then. Without
    one the state is made from all its months.
    """
    months = months_back(snapshot, feature_set.months)
    table, source = feature_set.name, (BANK, feature_set.source)
    stored = warehouse.stored_months(STATE, table, months[1:])
    before = next((m for m in stored if _as_built(warehouse, table, m, source, feature_set, current)), None)
    wanted = months if before is None else months[: month_number(snapshot) - month_number(before)]
    rows = _read_clean(warehouse, feature_set.source, snapshot, len(wanted))
    if before is None:
        state = feature_set.advance(rows, snapshot)
    else:
        old = warehouse.read(STATE, table, [before])
        for month in reversed(wanted[1:]):  # months between without a state of their own
            if warehouse.stored_months(CLEAN, Source(feature_set.source).clean_table, [month]):
                old, before = feature_set.advance(rows, month, old, before), month
        state = feature_set.advance(rows, snapshot, old, before)
    warehouse.replace_months(STATE, table, state)
    inputs = {_input(source, m): current.get(_input(source, m)) for m in months}
    built = [(STATE, STATE, table, snapshot, uuid.uuid4().hex, inputs)]
    builds = warehouse.spark.createDataFrame(built, BUILDS_SCHEMA).coalesce(1)
    warehouse.replace_months(AUDIT, BUILDS, builds, by=_BY_SOURCE)
    return feature_set.from_state(warehouse.read(STATE, table, [snapshot]))


def _as_built(
    warehouse: Warehouse,
    table: str,
    month: str,
    source: Name,
    feature_set: FeatureSet,
    current: dict[str, str],
) -> bool:
    """Whether the months a state was made from are those that are stored now."""
    builds = warehouse.read(AUDIT, BUILDS, [month])
    row = builds.where((F.col("stage") == STATE) & (F.col("source") == table)).first()
    wanted = [_input(source, m) for m in months_back(month, feature_set.months)]
    return row is not None and all(row.inputs.get(k) == current.get(k) for k in wanted)


# Builds and what has become stale ------------------------------------------------------------


def _input(name: Name, month: str) -> str:
    return "/".join((*name, month))


def _versions(warehouse: Warehouse, months: Sequence[str] | None = None) -> dict[str, str]:
    """The version of every clean table and feature set by month: a name each, no rows."""
    if not warehouse.stored_months(AUDIT, BUILDS, months):
        return {}
    builds = warehouse.read(AUDIT, BUILDS, months).where(F.col("stage").isin("clean", FEATURES))
    return {_input((r.source_group, r.source), r.snapshot_date): r.version for r in builds.collect()}


def stale_features(warehouse: Warehouse) -> DataFrame:
    """(source, snapshot_date, because) of feature months built from what has changed since.

    A feature month is stale if a month it was built from was delivered again, was delivered
    late, or is a feature month that is newer. Those only built from stale ones become stale
    when these are built again. ``because`` lists what has changed.
    """
    builds = warehouse.read(AUDIT, BUILDS)
    key = F.concat_ws("/", "source_group", "source", MONTH)
    now = builds.where(F.col("stage").isin("clean", FEATURES)).select(
        key.alias("input"), F.col("version").alias("now")
    )
    read = builds.where(F.col("stage") == FEATURES).select(
        "source", MONTH, F.explode("inputs").alias("input", "version")
    )
    changed = read.join(now, "input").where("NOT (version <=> now)")
    because = F.sort_array(F.collect_set("input")).alias("because")
    return changed.groupBy("source", MONTH).agg(because)


def rebuild_stale(
    warehouse: Warehouse,
    at_once: int = 4,
    purchase_types: Sequence[str] = (),
    incremental: bool = False,
) -> DataFrame:
    """Build the stale feature months again, and those made from them; returns the run report.

    Only these are built. One that fails is reported and left stale.
    """
    by_month: dict[str, list[str]] = {}
    for row in stale_features(warehouse).collect():
        by_month.setdefault(row.snapshot_date, []).append(row.source)
    reports = []
    for month, names in sorted(by_month.items()):
        closure = set(names)
        for name, read in READS.items():
            if closure & {n for _, n in read} and warehouse.stored_months(FEATURES, feature_table(name), [month]):
                closure.add(name)
        reports.append(
            run_features(
                warehouse,
                month,
                sorted(closure),
                at_once,
                purchase_types,
                incremental=incremental,
            )
        )
    if not reports:
        return warehouse.spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, reports)


def read_labels(warehouse: Warehouse, snapshot: str, per_customer: bool = False) -> DataFrame:
    """Call labels of a month, from the cleaned call log and account mapping."""
    mapping = _read_clean(warehouse, "cif_acct_mapping", snapshot, 1)
    table = Source("call_tracking", CALLS).clean_table
    calls = require_snapshot(
        warehouse.read(CLEAN, table, [snapshot]), snapshot, f"{CLEAN}/{table}"
    )
    return call_labels(calls, mapping, snapshot, per_customer=per_customer)


def run_month(
    warehouse: Warehouse,
    landing: str,
    snapshot: str,
    sources: Sequence[Source] = SOURCES,
    at_once: int = 4,
    purchase_types: Sequence[str] = (),
    incremental: bool = False,
) -> DataFrame:
    """Ingest, clean and build features for one month; returns the three reports together.

    A source that one stage could not bring up to date is skipped by the later ones, so that
    nothing is built on rows of an earlier delivery. ``purchase_types`` must be given, see
    ``run_features``.
    """
    if not purchase_types:
        raise ValueError(f"{PURCHASES} needs purchase_types, the types that get columns")
    ingested = run_ingest(warehouse, landing, snapshot, sources, at_once)
    cleaned = run_cleaning(warehouse, snapshot, sources, at_once, _not_ok(ingested))
    built = run_features(
        warehouse,
        snapshot,
        at_once=at_once,
        purchase_types=purchase_types,
        skip=_not_ok(cleaned),
        incremental=incremental,
    )
    return ingested.unionByName(cleaned).unionByName(built)


def register_feature_table(
    warehouse: Warehouse,
    table: str,
    feature_name: str,
    keys: Sequence[str],
    description: str,
    layer: str = CLEAN,
    months: Sequence[str] | None = None,
    database: str | None = None,
) -> str:
    """Merge a stored table, or some months of it, into a feature table by the given keys.

    The month is always one of the keys: without it a new month would replace the rows of the
    one before. Returns the feature table's full name. With a ``database``, the table is listed
    there, or what is listed is brought up to date: new columns, description and keys.
    """
    keys = (*keys, *([] if MONTH in keys else [MONTH]))
    warehouse.upsert(FEATURES, feature_name, warehouse.read(layer, table, months), keys, keep=False)
    if database is None:
        return warehouse.path(FEATURES, feature_name)
    return warehouse.register(FEATURES, feature_name, database, feature_name, description, keys)
