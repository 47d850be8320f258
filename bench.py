"""Timings of the feature sets over stored monthly tables; prints one JSON line.

The monthly tables are made from the shared star schema and written once, partitioned by
month, as the clean layer would hold them. That is not timed. Each query is then built and
run to the end, its rows going nowhere; the best of ``BENCH_RUNS`` runs counts, so that what
is compared is the work and not the warming up.

``compare`` times the same six-month history of balances in other ways: folded before the
shuffle or not, as a chain of left joins of one scan per month, and over all months.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import relations as rel
from checks.compare import session
from checks.oracle import ANCHOR
from checks.relations import CALL_MONTH, PURCHASE_TYPES
from monthgrain.months import MONTH, months_back
from monthgrain.operators.cleaning import clean_bank_table
from monthgrain.operators.snapshots import scan_snapshot
from monthgrain.plans import balance, holdings, labels, transactions
from monthgrain.plans.job import FEATURE_KEYS
from monthgrain.sources.warehouse import CLEAN, FEATURES, Warehouse, shared_folder

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

TABLES = {
    "cifsumm": rel.fx_cifsumm,
    "axa_tran_net": rel.fx_tran_net,
    "trx_outflow": rel.fx_outflow,
    "trx_outflow_payment_purchase": rel.fx_purchase,
    "debitcard_trx_edc_cif": rel.fx_edc,
    "phsumm": rel.fx_phsumm,
    "axa_avr": rel.fx_avr,
    "call_tracking": rel.fx_call,
}


def store(spark: SparkSession, warehouse: Warehouse) -> None:
    for name, make in TABLES.items():
        table = make(spark, FOLDER).hint("rebalance", F.col(MONTH))
        warehouse.replace_months(CLEAN, name, table)
    versions = {"v1": rel.fx_features_v1, "v2": rel.fx_features_v2}
    for name, make in versions.items():
        table = make(spark, FOLDER).hint("rebalance", F.col(MONTH))
        warehouse.replace_months(CLEAN, name, table)


def joined_history(read: Callable[..., DataFrame]) -> DataFrame:
    """Lags of the balances by one scan and one left join per earlier month."""
    wide = None
    for lag, month in enumerate(months_back(ANCHOR, 6)):
        rows = scan_snapshot(balance.clean_balances(read("cifsumm")), month)
        names = (*balance.BALANCES, *balance.DERIVED) if lag < 3 else balance.OLDER
        one = rows.selectExpr("cifno", *[f"{c} AS {c}_lag{lag}" for c in names])
        wide = one if wide is None else wide.join(one, "cifno", "left")
    return wide


def main() -> None:
    spark = session("monthgrain-bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = Warehouse(spark, shared_folder(spark))

    start = time.time()
    store(spark, warehouse)
    setup = time.time() - start

    def read(name: str, months: int = 0) -> DataFrame:
        return warehouse.read(CLEAN, name, months_back(ANCHOR, months) if months else None)

    def loans() -> DataFrame:
        return holdings.loan_diff(read("phsumm", 4), ANCHOR, unique=True)

    def window() -> DataFrame:
        return balance.balance_window(read("cifsumm", 6), ANCHOR, unique=True)

    def upserted() -> DataFrame:
        table = f"amounts_{time.time_ns()}"
        for version in ("v1", "v2"):
            warehouse.upsert(FEATURES, table, read(version), FEATURE_KEYS, keep=False)
        return warehouse.read(FEATURES, table)

    queries: dict[str, Callable[[], DataFrame]] = {
        "balance_window": window,
        "balance_window_backfill": lambda: balance.balance_window(read("cifsumm"), unique=True),
        "balance_loan": lambda: balance.balance_loan(window(), loans()),
        "balance_deduct": lambda: balance.balance_deduct(read("cifsumm", 1), loans(), ANCHOR),
        "trx_net": lambda: transactions.trx_net(
            read("axa_tran_net", 6), ANCHOR, unique=True
        ),
        "trx_net_backfill": lambda: transactions.trx_net(read("axa_tran_net"), unique=True),
        "outflow_features": lambda: transactions.trx_outflow(read("trx_outflow", 6), ANCHOR),
        "outflow_backfill": lambda: transactions.trx_outflow(read("trx_outflow")),
        "purchase_features": lambda: transactions.trx_outflow_purchase(
            read("trx_outflow_payment_purchase", 6), ANCHOR, PURCHASE_TYPES
        ),
        "purchase_backfill": lambda: transactions.trx_outflow_purchase(
            read("trx_outflow_payment_purchase"), None, PURCHASE_TYPES
        ),
        "edc_features": lambda: transactions.debit_edc(
            read("debitcard_trx_edc_cif", 6), ANCHOR, unique=True
        ),
        "edc_backfill": lambda: transactions.debit_edc(
            read("debitcard_trx_edc_cif"), unique=True
        ),
        "bank_ph": lambda: holdings.bank_ph(read("phsumm", 1), ANCHOR),
        "loan_diff": loans,
        "saving_account": lambda: holdings.saving_acct(read("phsumm")),
        "avr_balance": lambda: holdings.axa_avr(read("axa_avr", 1), ANCHOR),
        "call_labels": lambda: labels.call_labels(
            read("call_tracking"), rel.fx_mapping(spark, FOLDER), CALL_MONTH
        ),
        "clean_source": lambda: clean_bank_table(
            rel.fx_dirty(spark, FOLDER), keep=("cus_no", "seg_ment", "rekening"), dates=("open_date",)
        ),
        "feature_upsert": upserted,
    }
    compare: dict[str, Callable[[], DataFrame]] = {
        "history_one_scan": lambda: balance.balance_history(read("cifsumm", 6), ANCHOR),
        "history_one_scan_unique": lambda: balance.balance_history(
            read("cifsumm", 6), ANCHOR, unique=True
        ),
        "history_six_joins": lambda: joined_history(read),
        "history_all_months": lambda: balance.balance_history(read("cifsumm")),
        "history_all_months_unique": lambda: balance.balance_history(read("cifsumm"), unique=True),
    }

    def timed(query: Callable[[], DataFrame]) -> float:
        runs = []
        for _ in range(RUNS):
            begin = time.time()
            query().write.format("noop").mode("overwrite").save()
            runs.append(time.time() - begin)
        return round(min(runs), 3)

    seconds = {name: timed(query) for name, query in queries.items()}
    result = {
        "metric": "monthly_feature_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "setup_sec": round(setup, 1),
        "compare": {name: timed(query) for name, query in compare.items()},
    }
    sys.stdout.write(json.dumps(result) + "\n")


if __name__ == "__main__":
    main()
