import os

import pytest

from checks import relations as rel
from monthgrain.months import months_back
from monthgrain.plans import balance, holdings, job
from monthgrain.sources.manifest import SOURCES, Source
from monthgrain.sources.warehouse import AUDIT, CLEAN, FEATURES, RAW, Warehouse
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
MONTH = "200106"
TYPES = rel.PURCHASE_TYPES

BANK_FILES = {
    "cifsumm": rel.fx_cifsumm,
    "phsumm": rel.fx_phsumm,
    "axa_avr": rel.fx_avr,
    "axa_tran_net": rel.fx_tran_net,
    "trx_outflow": rel.fx_outflow,
    "trx_outflow_payment_purchase": rel.fx_purchase,
    "debitcard_trx_edc_cif": rel.fx_edc,
    "cc_type_cnt": rel.fx_card,
}


def landed(spark, landing, name, df, month):
    """Write one month of a table as its delimited file."""
    source = next(s for s in SOURCES if s.name == name)
    text = df.where(f"snapshot_date = '{month}'").drop("snapshot_date")
    text = text.selectExpr(*[f"string(`{c}`) AS `{c}`" for c in text.columns])
    path = f"{landing}/{month}/{source.file_name(month)}"
    text.coalesce(1).write.option("header", True).option("sep", source.sep).csv(path)


def statuses(report, stage):
    return {r.source: (r.status, r.rows) for r in report.where(f"stage = '{stage}'").collect()}


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """Three months of files, ingested and cleaned, and the features of the last."""
    root = str(tmp_path_factory.mktemp("job"))
    warehouse = Warehouse(spark, f"{root}/wh")
    months = months_back(MONTH, 3)[::-1]
    tables = {name: make(spark, FOLDER).cache() for name, make in BANK_FILES.items()}
    for month in months:
        for name, df in tables.items():
            landed(spark, f"{root}/landing", name, df, month)
    mapping = rel.fx_mapping(spark, FOLDER).selectExpr("*", f"'{MONTH}' AS snapshot_date")
    landed(spark, f"{root}/landing", "cif_acct_mapping", mapping, MONTH)
    calls = rel.fx_call(spark, FOLDER).selectExpr("* except (snapshot_date)", f"'{MONTH}' AS snapshot_date")
    landed(spark, f"{root}/landing", "call_tracking", calls, MONTH)
    for month in months[:-1]:
        job.run_ingest(warehouse, f"{root}/landing", month)
        job.run_cleaning(warehouse, month)
    report = job.run_month(warehouse, f"{root}/landing", MONTH, purchase_types=TYPES).cache()
    return warehouse, tables, report, f"{root}/landing"


def test_every_source_is_reported(ran):
    _, tables, report, _ = ran
    ingested = statuses(report, "ingest")
    assert len(ingested) == 21
    assert ingested["tso"] == ("missing", None)
    for name, df in tables.items():
        rows_of_month = df.where(f"snapshot_date = '{MONTH}'").count()
        assert ingested[name] == ("ok", rows_of_month)
        assert statuses(report, "clean")[name] == ("ok", rows_of_month)


def test_features_are_built_and_the_rest_reported(ran):
    _, _, report, _ = ran
    built = statuses(report, "features")
    assert built.pop("debit_type") == ("skipped", None)
    assert len(built) == 12 and {s for s, _ in built.values()} == {"ok"}


def test_report_is_stored_and_replaced(ran):
    warehouse, _, report, _ = ran
    stored = warehouse.read(AUDIT, job.REPORT, [MONTH])
    assert stored.count() == report.count()
    job.run_cleaning(warehouse, MONTH)  # in place of the rows of before
    assert warehouse.read(AUDIT, job.REPORT, [MONTH]).count() == report.count()


def test_stored_features_equal_those_of_the_relations(ran):
    """From files through text and typing, with three months only."""
    warehouse, tables, _, _ = ran
    months = months_back(MONTH, 3)
    recent = tables["cifsumm"].where(f"snapshot_date IN ('{months[0]}', '{months[1]}', '{months[2]}')")
    expected = balance.balance_window(recent, MONTH)
    stored = warehouse.read(FEATURES, "balance_window_features", [MONTH])
    assert rows(stored, *expected.columns) == rows(expected)
    expected = holdings.bank_ph(tables["phsumm"], MONTH)
    stored = warehouse.read(FEATURES, "bank_ph_features", [MONTH])
    assert rows(stored, *expected.columns) == rows(expected)


def test_running_again_changes_nothing(ran):
    warehouse, _, report, _ = ran
    before = rows(warehouse.read(FEATURES, "trx_net_features"))
    again = job.run_features(warehouse, MONTH, ["trx_net"])
    assert statuses(again, "features") == {"trx_net": statuses(report, "features")["trx_net"]}
    assert rows(warehouse.read(FEATURES, "trx_net_features")) == before


def test_labels_of_the_month(ran):
    warehouse, _, _, _ = ran
    every = job.read_labels(warehouse, MONTH)
    best = job.read_labels(warehouse, MONTH, per_customer=True)
    assert every.columns == ["cifno", "label", "snapshot_date"]
    assert best.count() == every.select("cifno").distinct().count() > 0


def test_purchases_need_their_types(ran):
    """Without them the table would silently have no column of a type."""
    warehouse, _, _, landing = ran
    for run in (
        lambda: job.run_month(warehouse, landing, MONTH),
        lambda: job.run_features(warehouse, MONTH),
        lambda: job.run_features(warehouse, MONTH, ["trx_outflow_purchase"]),
    ):
        with pytest.raises(ValueError, match="needs purchase_types"):
            run()
    stored = warehouse.read(FEATURES, "trx_outflow_purchase_features", [MONTH])
    assert {f"{t}_freq" for t in TYPES} <= set(stored.columns)


def test_losses_are_reported(spark, tmp_path):
    """Texts that do not parse and missing types, counted by the job that writes the month."""
    folder = tmp_path / "landing" / "202401"
    folder.mkdir(parents=True)
    (folder / "trx_outflow_payment_purchase_202401.txt").write_text(
        "customer_no|transaction_type|frek|nominal\n1||1|n/a\n2|A|x|\n3|(null)|2| \n4|B|3|-\n"
    )
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    sources = [s for s in SOURCES if s.name == "trx_outflow_payment_purchase"]
    job.run_ingest(warehouse, str(tmp_path / "landing"), "202401", sources)
    report = job.run_cleaning(warehouse, "202401")
    want = {"nominal": 2, "frek": 1, "transaction_type is null": 2}
    assert report.first().losses == want
    stored = warehouse.read(AUDIT, job.REPORT).where("stage = 'clean'").first()
    assert stored.losses == want and stored.rows == 4


def test_one_bad_file_does_not_stop_the_others(spark, tmp_path):
    folder = tmp_path / "landing" / "202401"
    folder.mkdir(parents=True)
    (folder / "cifsumm_202401.txt").write_text("Open Date|open_date\na|b\n")
    (folder / "phsumm_202401.txt").write_text("cifno|t1\n1|2\n")
    (folder / "master_filter_202401.txt").write_text("cifno|x\n")
    (folder / "axa_tran_net_202401.txt").write_text("cif|sum_cd\n1|2\n1|3\n")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    names = ("cifsumm", "phsumm", "master_filter", "axa_tran_net")
    sources = [s for s in SOURCES if s.name in names]
    ingested = job.run_ingest(warehouse, str(tmp_path / "landing"), "202401", sources)
    assert statuses(ingested, "ingest") == {
        "cifsumm": ("ok", 1),
        "phsumm": ("ok", 1),
        "axa_tran_net": ("ok", 2),
        "master_filter": ("empty", 0),
    }
    cleaned = job.run_cleaning(warehouse, "202401")
    found = statuses(cleaned, "clean")
    assert found["cifsumm"] == ("failed", None) and found["phsumm"] == ("ok", 1)
    errors = {r.source: r.error for r in cleaned.collect()}
    assert "share a name" in errors["cifsumm"]
    assert "cif of axa_tran_net is null or repeated" in errors["axa_tran_net"]
    assert not warehouse.exists(CLEAN, "bank_axa_tran_net")


def test_nothing_is_built_on_an_earlier_delivery(spark, tmp_path):
    folder = tmp_path / "landing" / "202401"
    folder.mkdir(parents=True)
    file = folder / "phsumm_202401.txt"
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    sources = [s for s in SOURCES if s.name == "phsumm"]

    def run(text):
        file.write_text("cifno|loanall_s|snapshot\n" + text)
        report = job.run_month(
            warehouse, str(tmp_path / "landing"), "202401", sources, purchase_types=["a"]
        )
        return {r.stage: r.status for r in report.where("source IN ('phsumm', 'loan_diff')").collect()}

    good, repeated, empty = "1|2|x\n", "1|2|x\n1|3|x\n", ""
    assert run(good)["clean"] == "ok"
    assert run(repeated) == {"ingest": "ok", "clean": "failed", "features": "skipped"}
    assert run(empty) == {"ingest": "empty", "clean": "skipped", "features": "skipped"}
    assert run(good)["clean"] == "ok"


def test_tables_the_manifest_does_not_know(spark, tmp_path):
    folder = tmp_path / "landing" / "202401"
    folder.mkdir(parents=True)
    (folder / "extra_202401.txt").write_text("CusNo|Amount\n007|5\n")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    job.run_ingest(warehouse, str(tmp_path / "landing"), "202401", [Source("extra")])
    job.run_cleaning(warehouse, "202401")
    assert rows(warehouse.read(CLEAN, "bank_extra"), "cusno", "amount", "cifno") == [
        ("007", 5.0, "007")
    ]


def test_feature_tables_from_stored_tables(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    schema = "cifno string, x double, snapshot_date string"
    keys = ["cifno", "snapshot_date"]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS mg_features LOCATION '{tmp_path}/db'")
    try:
        for month, x in (("200105", 1.0), ("200106", 2.0)):
            warehouse.replace_months(
                CLEAN, "scores", spark.createDataFrame([("a", x, month)], schema)
            )
            name = job.register_feature_table(
                warehouse, "scores", "scores_features", keys, "Scores", months=[month],
                database="mg_features",
            )
        assert name == "mg_features.scores_features"
        assert rows(spark.table(name), "x", "snapshot_date") == [(1.0, "200105"), (2.0, "200106")]
        path = job.register_feature_table(warehouse, "scores", "scores_features", keys, "Scores")
        assert os.path.isdir(path)
    finally:
        spark.sql("DROP DATABASE mg_features CASCADE")
    assert warehouse.tables(RAW) == []
