"""One query per operator, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import relations as rel
from checks.oracle import ANCHOR
from checks.relations import CALL_MONTH, PURCHASE_TYPES
from monthgrain.functions.text import named, ref
from monthgrain.months import months_back
from monthgrain.operators import cleaning
from monthgrain.operators.snapshots import preview, require_snapshot, scan_snapshot
from monthgrain.plans import balance, holdings, job, labels, transactions
from monthgrain.sources.catalog import table_keys
from monthgrain.sources.catalog_warehouse import CatalogWarehouse
from monthgrain.sources.delimited import read_source
from monthgrain.sources.manifest import CALLS, SOURCES, Source
from monthgrain.sources.warehouse import (
    AUDIT,
    CLEAN,
    FEATURES,
    RAW,
    STATE,
    Warehouse,
    shared_folder,
)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles, so that results do not hinge on the order of additions."""
    return df.selectExpr(
        *[
            named(f"round({ref(f.name)}, {digits})", f.name)
            if isinstance(f.dataType, T.DoubleType)
            else ref(f.name)
            for f in df.schema.fields
        ]
    )


def _source(name: str) -> Source:
    return next(s for s in SOURCES if s.name == name)


def _customer_text(spark: SparkSession, folder: str) -> DataFrame:
    return rel.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string"),
        "c_name",
        F.col("c_nationkey").cast("string"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
        "c_mktsegment",
    )


def _land(spark: SparkSession, folder: str, landing: str, sources: list[Source]) -> None:
    """Write the customers as this month's file of each source."""
    for source in sources:
        _customer_text(spark, folder).write.option("header", True).option("sep", source.sep).csv(
            f"{landing}/{CALL_MONTH}/{source.file_name(CALL_MONTH)}"
        )


def ingest_delimited(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_folder(spark)
    _land(spark, folder, f"{root}/landing", [_source("cif_acct_mapping")])
    warehouse = Warehouse(spark, root)
    source = _source("cif_acct_mapping")
    job.run_ingest(warehouse, f"{root}/landing", CALL_MONTH, [source])
    return warehouse.read(RAW, source.raw_table)


def ingest_multi_sep(spark: SparkSession, folder: str) -> DataFrame:
    landing = f"{shared_folder(spark)}/landing"
    names = ["all_status", "tso"]
    _land(spark, folder, landing, [_source(n) for n in names])
    read = [
        read_source(spark, landing, _source(n), CALL_MONTH).withColumn("source", F.lit(n))
        for n in names
    ]
    return read[0].unionByName(read[1])


def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """The stored report, with two sources of one name and one source ingested again."""
    root = shared_folder(spark)
    tso = _source("tso")
    there = [_source("cif_acct_mapping"), tso, Source("same"), Source("same", CALLS, sep=",")]
    _land(spark, folder, f"{root}/landing", there)
    warehouse = Warehouse(spark, root)
    sources = [*there, _source("cc_type_cnt")]
    job.run_ingest(warehouse, f"{root}/landing", CALL_MONTH, sources)
    job.run_cleaning(warehouse, CALL_MONTH, sources)
    job.run_ingest(warehouse, f"{root}/landing", CALL_MONTH, [tso])
    report = warehouse.read(AUDIT, job.REPORT, [CALL_MONTH])
    return report.withColumn("error", F.split_part("error", F.lit(":"), F.lit(1))).drop("losses")


def cleaning_losses(spark: SparkSession, folder: str) -> DataFrame:
    """What a month of awkward texts loses when cleaned, as the stored report has it."""
    root = shared_folder(spark)
    source = Source("dirty", keep=("cus_no", "rekening"), required=("rekening", "cus_no"))
    path = f"{root}/landing/{CALL_MONTH}/{source.file_name(CALL_MONTH)}"
    dirty = rel.fx_dirty(spark, folder).drop("snapshot_date")
    writer = dirty.write.option("header", True).option("sep", source.sep)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    warehouse = Warehouse(spark, root)
    job.run_ingest(warehouse, f"{root}/landing", CALL_MONTH, [source])
    job.run_cleaning(warehouse, CALL_MONTH, [source])
    report = warehouse.read(AUDIT, job.REPORT, [CALL_MONTH]).where("stage = 'clean'")
    return report.select("source", "rows", F.explode("losses").alias("what", "lost"))


def _catalog(spark: SparkSession, buckets: int = 0) -> CatalogWarehouse:
    root = shared_folder(spark)
    return CatalogWarehouse(spark, root, root.rsplit("-", 1)[-1], buckets)


def discover_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Names of raw sources, by folder and by catalog, and the months each has."""
    found = []
    tables = {
        "bank_amounts_raw": rel.fx_features_v1(spark, folder),
        "bank_orders_raw": rel.fx_features_v2(spark, folder),
        "calls_orders_raw": rel.fx_features_v2(spark, folder),
    }
    for where, warehouse in (
        ("folder", Warehouse(spark, shared_folder(spark))),
        ("catalog", _catalog(spark)),
    ):
        for name, df in tables.items():
            warehouse.replace_months(RAW, name, df.hint("rebalance", F.col("snapshot_date")))
        for name in warehouse.sources(RAW, "bank"):
            months = warehouse.stored_months(RAW, f"bank_{name}_raw")
            found += [(where, name, month) for month in months]
    return spark.createDataFrame(found, "place string, source string, snapshot_date string")


def empty_months(spark: SparkSession, folder: str) -> DataFrame:
    """Which months a source must have before work on it may begin."""
    rows = rel.fx_features_v1(spark, folder).cache()
    found = []
    for month in ("199412", "199501", ANCHOR, "203001"):
        try:
            n = require_snapshot(rows, month, "amounts").count()
            found.append((month, n, None))
        except ValueError as error:
            found.append((month, 0, str(error)))
    rows.unpersist()
    return spark.createDataFrame(found, "snapshot_date string, rows long, error string")


def register_feature(spark: SparkSession, folder: str) -> DataFrame:
    """A feature table registered twice, the second time with a new column and comment."""
    root = shared_folder(spark)
    warehouse, database = Warehouse(spark, root), f"db_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    second = rel.fx_features_v2(spark, folder).withColumn("mean", F.col("amount") / F.col("items"))
    versions = (rel.fx_features_v1(spark, folder), "Amounts"), (second, "Amounts and their mean")
    for k, (version, comment) in enumerate(versions):
        version = version.hint("rebalance", F.col("snapshot_date"))
        warehouse.replace_months(CLEAN, f"amounts{k}", version)
        name = job.register_feature_table(
            warehouse, f"amounts{k}", "amounts", ["cifno"], comment, database=database
        )
    return rounded(spark.table(name)).select(
        "*",
        F.lit(spark.catalog.getTable(name).description).alias("comment"),
        F.lit(",".join(table_keys(spark, name))).alias("keys"),
    )


def roundtrip_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Months switched in the catalog, with one write that is lost before the switch."""
    warehouse = _catalog(spark)
    second = scan_snapshot(rel.fx_features_v2(spark, folder), ANCHOR)
    warehouse.replace_months(RAW, "amounts", rel.fx_features_v1(spark, folder))
    warehouse.replace_months(RAW, "amounts", second)

    class Lost(CatalogWarehouse):
        def _switch(self, *args) -> None:
            raise ConnectionError

    lost = Lost(spark, warehouse.root, warehouse.prefix)
    try:
        lost.replace_months(RAW, "amounts", rel.fx_features_v2(spark, folder))
    except ConnectionError:
        return warehouse.read(RAW, "amounts")
    raise AssertionError("the write was to be lost")


def balance_window_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _catalog(spark, buckets=8)
    months = scan_snapshot(rel.fx_cifsumm(spark, folder), *months_back(ANCHOR, 6))
    warehouse.replace_months(CLEAN, "cifsumm", months)
    stored = warehouse.read(CLEAN, "cifsumm")
    return rounded(balance.balance_window(stored, ANCHOR, bucketed=True))


def balance_window_rolling(spark: SparkSession, folder: str) -> DataFrame:
    """The anchor month's window from a state that was advanced month by month."""
    root = shared_folder(spark)
    warehouse = Warehouse(spark, root)
    first, *later = months_back(ANCHOR, 8)[::-1]
    warehouse.replace_months(
        CLEAN, "cifsumm", scan_snapshot(rel.fx_cifsumm(spark, folder), first, *later)
    )
    summary = warehouse.read(CLEAN, "cifsumm")
    warehouse.replace_months(STATE, "window", balance.window_state(summary, first))
    for before, month in zip([first, *later], later, strict=False):
        state = warehouse.read(STATE, "window", [before])
        one = warehouse.read(CLEAN, "cifsumm", [month])
        state = balance.window_state(one, month, state, before)
        warehouse.replace_months(STATE, "window", state)
    return rounded(balance.window_from_state(warehouse.read(STATE, "window", [ANCHOR])))


def stale_months(spark: SparkSession, folder: str) -> DataFrame:
    """Feature months that a late and a repeated delivery have made stale, and what they read."""
    warehouse = Warehouse(spark, shared_folder(spark))
    sources = [_source("axa_tran_net")]
    net = rel.fx_tran_net(spark, folder).select(
        F.col("cifno").alias("CIF"), *["sum_cd", "num_cd", "sum_db", "num_db"], "snapshot_date"
    )
    text = net.selectExpr(*[f"string({c}) AS {c}" for c in net.columns])
    months = months_back(ANCHOR, 8)[::-1]
    warehouse.replace_months(RAW, sources[0].raw_table, scan_snapshot(text, *months))
    for month in months:
        if month != months[2]:  # late
            job.run_cleaning(warehouse, month, sources)
            job.run_features(warehouse, month, ["trx_net"])
    for month in (months[0], months[2]):
        job.run_cleaning(warehouse, month, sources)
    return job.stale_features(warehouse).select(
        "source", "snapshot_date", F.explode("because").alias("changed")
    )


def roundtrip_partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark, shared_folder(spark))
    second = scan_snapshot(rel.fx_features_v2(spark, folder), ANCHOR)
    for version in (rel.fx_features_v1(spark, folder), second, second):
        warehouse.replace_months(RAW, "amounts", version)
    return warehouse.read(RAW, "amounts")


def feature_upsert(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = Warehouse(spark, shared_folder(spark))
    for version in (rel.fx_features_v1(spark, folder), rel.fx_features_v2(spark, folder)):
        warehouse.upsert(FEATURES, "amounts", version, job.FEATURE_KEYS)
    return warehouse.read(FEATURES, "amounts")


def preview_limit(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows a preview has, and whether all of them are of the relation."""
    rows = rel.fx_features_v1(spark, folder)
    shown = preview(rows, rows=7)
    known = shown.join(rows.select("cifno", "snapshot_date", "amount"), ["cifno", "snapshot_date"])
    return known.agg(F.count("*").alias("shown"), F.count_distinct("cifno", "snapshot_date").alias("keys"))


def _loans(spark: SparkSession, folder: str) -> DataFrame:
    return holdings.loan_diff(rel.fx_phsumm(spark, folder), ANCHOR)


def _tidied(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.tidy_strings(cleaning.sanitize_columns(rel.fx_dirty(spark, folder)))


def _labels(spark: SparkSession, folder: str, per_customer: bool) -> DataFrame:
    return labels.call_labels(
        rel.fx_call(spark, folder),
        rel.fx_mapping(spark, folder),
        CALL_MONTH,
        per_customer=per_customer,
    )


def _purchases(spark: SparkSession, folder: str, snapshot: str | None) -> DataFrame:
    rows = rel.fx_purchase(spark, folder)
    return rounded(transactions.trx_outflow_purchase(rows, snapshot, PURCHASE_TYPES))


QUERIES: dict[str, Query] = {
    # Sources and sinks
    "ingest_delimited": ingest_delimited,
    "ingest_multi_sep": ingest_multi_sep,
    "scan_snapshot": lambda s, d: scan_snapshot(rel.fx_cifsumm(s, d), ANCHOR),
    "roundtrip_partition_overwrite": roundtrip_partition_overwrite,
    "feature_upsert": feature_upsert,
    "run_report": run_report,
    "register_feature": register_feature,
    "roundtrip_catalog": roundtrip_catalog,
    "discover_sources": discover_sources,
    "empty_months": empty_months,
    "stale_months": stale_months,
    "preview_limit": preview_limit,
    # Cleaning
    "sanitize_columns": lambda s, d: cleaning.sanitize_columns(rel.fx_dirty(s, d)),
    "clean_strings": _tidied,
    "standardize_ids": lambda s, d: cleaning.add_customer_id(
        _tidied(s, d), ("rekening", "cus_no")
    ),
    "harden_types": lambda s, d: cleaning.harden_types(
        _tidied(s, d), keep=("cus_no", "rekening")
    ),
    "clean_source": lambda s, d: cleaning.clean_bank_table(
        rel.fx_dirty(s, d), keep=("cus_no", "seg_ment", "rekening"), dates=("open_date",)
    ),
    "clean_call_source": lambda s, d: cleaning.clean_call_table(rel.fx_call_raw(s, d)),
    "cleaning_losses": cleaning_losses,
    "fill_nulls": lambda s, d: cleaning.fill_numbers(rel.fx_tran_net(s, d)),
    # Balances
    "lag_history": lambda s, d: balance.balance_history(rel.fx_cifsumm(s, d), ANCHOR),
    "balance_clean": lambda s, d: balance.clean_balances(rel.fx_cifsumm(s, d)),
    "balance_window": lambda s, d: rounded(balance.balance_window(rel.fx_cifsumm(s, d), ANCHOR)),
    "balance_window_backfill": lambda s, d: rounded(balance.balance_window(rel.fx_cifsumm(s, d))),
    "balance_loan": lambda s, d: rounded(
        balance.balance_loan(balance.balance_window(rel.fx_cifsumm(s, d), ANCHOR), _loans(s, d))
    ),
    "balance_deduct": lambda s, d: rounded(
        balance.balance_deduct(rel.fx_cifsumm(s, d), _loans(s, d), ANCHOR)
    ),
    "balance_window_unique": lambda s, d: rounded(
        balance.balance_window(rel.fx_cifsumm(s, d), ANCHOR, unique=True)
    ),
    "balance_window_absent": lambda s, d: rounded(
        balance.balance_window(rel.fx_cifsumm(s, d).drop("qt1", "mndt"), ANCHOR)
    ),
    "balance_window_bucketed": balance_window_bucketed,
    "balance_window_rolling": balance_window_rolling,
    "balance_window_backfill_unique": lambda s, d: rounded(
        balance.balance_window(rel.fx_cifsumm(s, d), unique=True)
    ),
    # Transactions
    "trx_net": lambda s, d: rounded(transactions.trx_net(rel.fx_tran_net(s, d), ANCHOR)),
    "trx_net_unique": lambda s, d: rounded(
        transactions.trx_net(rel.fx_tran_net(s, d), ANCHOR, unique=True)
    ),
    "trx_net_backfill_unique": lambda s, d: rounded(
        transactions.trx_net(rel.fx_tran_net(s, d), unique=True)
    ),
    "trx_net_backfill": lambda s, d: rounded(transactions.trx_net(rel.fx_tran_net(s, d))),
    "outflow_shares": lambda s, d: rounded(transactions.outflow_shares(rel.fx_outflow(s, d))),
    "outflow_features": lambda s, d: rounded(
        transactions.trx_outflow(rel.fx_outflow(s, d), ANCHOR)
    ),
    "outflow_backfill": lambda s, d: rounded(transactions.trx_outflow(rel.fx_outflow(s, d))),
    "purchase_pivot": lambda s, d: rounded(
        transactions.purchase_pivot(rel.fx_purchase(s, d), PURCHASE_TYPES)
    ),
    "purchase_features": lambda s, d: _purchases(s, d, ANCHOR),
    "purchase_backfill": lambda s, d: _purchases(s, d, None),
    "edc_groups": lambda s, d: rounded(transactions.edc_groups(rel.fx_edc(s, d))),
    "edc_features": lambda s, d: rounded(transactions.debit_edc(rel.fx_edc(s, d), ANCHOR)),
    "edc_backfill": lambda s, d: rounded(transactions.debit_edc(rel.fx_edc(s, d))),
    "edc_backfill_unique": lambda s, d: rounded(
        transactions.debit_edc(rel.fx_edc(s, d), unique=True)
    ),
    "edc_unique": lambda s, d: rounded(
        transactions.debit_edc(rel.fx_edc(s, d), ANCHOR, unique=True)
    ),
    # Holdings
    "product_holding": lambda s, d: holdings.product_counts(rel.fx_phsumm(s, d), ANCHOR).drop(
        *holdings.OPEN_DATES
    ),
    "product_vintage": lambda s, d: rounded(holdings.bank_ph(rel.fx_phsumm(s, d), ANCHOR)),
    "saving_account": lambda s, d: rounded(
        holdings.saving_acct(cleaning.fill_numbers(rel.fx_phsumm(s, d)))
    ),
    "saving_account_nulls": lambda s, d: rounded(holdings.saving_acct(rel.fx_phsumm(s, d))),
    "loan_diff": lambda s, d: rounded(_loans(s, d)),
    "loan_diff_unique": lambda s, d: rounded(
        holdings.loan_diff(rel.fx_phsumm(s, d), ANCHOR, unique=True)
    ),
    "avr_balance": lambda s, d: rounded(holdings.axa_avr(rel.fx_avr(s, d), ANCHOR)),
    "avr_balance_exact": lambda s, d: rounded(
        holdings.axa_avr(rel.fx_avr(s, d), ANCHOR, accuracy=None)
    ),
    "card_type_counts": lambda s, d: holdings.card_types(rel.fx_card(s, d), ANCHOR),
    # Labels
    "call_labels": lambda s, d: _labels(s, d, per_customer=False),
    "call_labels_by_customer": lambda s, d: _labels(s, d, per_customer=True),
}
