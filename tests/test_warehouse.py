import pytest

from monthgrain.operators.snapshots import require_snapshot, scan_snapshot, stamp_snapshot
from monthgrain.sources.delimited import MissingFile, read_delimited, read_source
from monthgrain.sources.manifest import SOURCES, Source
from monthgrain.sources.warehouse import CLEAN, FEATURES, RAW, Warehouse, discover_sources
from tests.conftest import rows

KEYS = ("cifno", "snapshot_date")
SCHEMA = "cifno string, x double, snapshot_date string"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_months_are_replaced_whole_and_others_left(spark, warehouse):
    first = frame(spark, ("a", 1.0, "200105"), ("b", 2.0, "200106"))
    assert warehouse.replace_months(RAW, "t", first) == 2
    second = frame(spark, ("c", 3.0, "200106"))
    for _ in range(2):
        assert warehouse.replace_months(RAW, "t", second) == 1
    table = warehouse.read(RAW, "t")
    assert rows(table) == [("a", 1.0, "200105"), ("c", 3.0, "200106")]
    assert table.schema["snapshot_date"].dataType.simpleString() == "string"


def test_reading_some_months(spark, warehouse):
    warehouse.replace_months(RAW, "t", frame(spark, ("a", 1.0, "200105"), ("b", 2.0, "200106")))
    assert rows(warehouse.read(RAW, "t", ["200106", "200104"])) == [("b", 2.0, "200106")]
    assert len(warehouse.read(RAW, "t", ["200106"]).inputFiles()) == 1
    with pytest.raises(ValueError, match="none of the months"):
        warehouse.read(RAW, "t", ["199901"])


def test_columns_may_change_from_month_to_month(spark, warehouse):
    warehouse.replace_months(RAW, "t", frame(spark, ("a", 1.0, "200105")))
    wider = frame(spark, ("b", 2.0, "200106")).selectExpr("*", "'n' AS note")
    warehouse.replace_months(RAW, "t", wider)
    table = warehouse.read(RAW, "t")
    assert rows(table, "cifno", "note") == [("a", None), ("b", "n")]


def test_upsert(spark, warehouse):
    first = frame(spark, ("a", 1.0, "200105"), ("a", 1.0, "200106"), ("b", 2.0, "200106"))
    assert warehouse.upsert(FEATURES, "f", first, KEYS) == 3
    second = frame(spark, ("b", 9.0, "200106"), ("c", 3.0, "200106"), ("a", 5.0, "200107"))
    for _ in range(2):
        assert warehouse.upsert(FEATURES, "f", second, KEYS) == 4
    assert rows(warehouse.read(FEATURES, "f")) == [
        ("a", 1.0, "200105"),
        ("a", 1.0, "200106"),
        ("a", 5.0, "200107"),
        ("b", 9.0, "200106"),
        ("c", 3.0, "200106"),
    ]


def test_upsert_leaves_files_of_other_months(spark, warehouse):
    warehouse.upsert(FEATURES, "f", frame(spark, ("a", 1.0, "200105")), KEYS)
    before = warehouse.read(FEATURES, "f", ["200105"]).inputFiles()
    warehouse.upsert(FEATURES, "f", frame(spark, ("a", 2.0, "200106")), KEYS)
    assert warehouse.read(FEATURES, "f", ["200105"]).inputFiles() == before


@pytest.mark.parametrize(
    "data", [[("a", 1.0, "200106"), ("a", 2.0, "200106")], [(None, 1.0, "200106")]]
)
def test_upsert_of_a_broken_key_writes_nothing(spark, warehouse, data):
    with pytest.raises(ValueError, match="null or repeated"):
        warehouse.upsert(FEATURES, "f", frame(spark, *data), KEYS)
    assert not warehouse.exists(FEATURES, "f")


def test_upsert_key_holds_the_month(spark, warehouse):
    with pytest.raises(ValueError):
        warehouse.upsert(FEATURES, "f", frame(spark), ("cifno",))


def test_tables_by_pattern(spark, warehouse):
    for name in ("bank_phsumm_raw", "bank_raw_bank_raw", "calls_tso_raw", "bank_x"):
        warehouse.replace_months(RAW, name, frame(spark, ("a", 1.0, "200105")))
    assert warehouse.sources(RAW, "bank") == ["phsumm", "raw_bank"]
    assert warehouse.sources(RAW, "calls") == ["tso"]
    assert warehouse.sources(CLEAN, "bank") == []


def test_catalog_tables_and_registration(spark, warehouse, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS mg_test LOCATION '{tmp_path}/db'")
    try:
        warehouse.replace_months(RAW, "t", frame(spark, ("a", 1.0, "200105")))
        name = warehouse.register(RAW, "t", "mg_test", "bank_t_raw", "it's a test")
        assert rows(spark.table(name)) == [("a", 1.0, "200105")]
        warehouse.replace_months(RAW, "t", frame(spark, ("b", 1.0, "200106")))
        warehouse.register(RAW, "t", "mg_test", "bank_t_raw", "it's a test")
        assert rows(spark.table(name), "cifno") == [("a",), ("b",)]
        assert discover_sources(spark, "mg_test", "bank") == ["t"]
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
        assert ("Comment", "it's a test") in [(r[0], r[1]) for r in details]
    finally:
        spark.sql("DROP DATABASE mg_test CASCADE")


def test_snapshots(spark):
    df = frame(spark, ("a", 1.0, "200105"), ("b", 2.0, "200106"))
    assert rows(scan_snapshot(df, "200106"), "cifno") == [("b",)]
    assert rows(stamp_snapshot(df, "200107"), "snapshot_date") == [("200107",), ("200107",)]
    assert rows(require_snapshot(df, "200105", "t"), "cifno") == [("a",)]
    with pytest.raises(ValueError, match="t has no rows for 200101"):
        require_snapshot(df, "200101", "t")
    with pytest.raises(ValueError):
        scan_snapshot(df, "2001")


def test_manifest():
    assert len(SOURCES) == 21
    names = {s.name: s for s in SOURCES}
    assert names["axa_avr"].file_name("202505") == "axa_avr_202505.txt"
    assert names["tso"].file_name("202505") == "TSO_202505.txt"
    assert names["all_status"].file_name("202505") == "ALL_STATUS_202505.csv"
    assert names["call_tracking"].file_name("202505") == "call_tracking_savings_202505.csv"
    assert names["phsumm"].raw_table == "bank_phsumm_raw"
    assert names["tso"].clean_table == "calls_tso"


def test_delimited_files(spark, tmp_path):
    folder = tmp_path / "202401"
    folder.mkdir()
    (folder / "x_202401.txt").write_text('Cus No|Bal(IDR)|note\n001| 5 |"a|b"\n002||\n')
    df = read_source(spark, str(tmp_path), Source("x"), "202401")
    assert df.columns == ["Cus No", "Bal(IDR)", "note", "snapshot_date"]
    assert rows(df) == [("001", " 5 ", "a|b", "202401"), ("002", None, None, "202401")]
    (folder / "TSO_202401.txt").write_text("a\tb\n1\t2\n")
    tso = read_delimited(spark, str(folder / "TSO_202401.txt"), "\t")
    assert rows(tso) == [("1", "2")]
    with pytest.raises(MissingFile):
        read_delimited(spark, str(folder / "nothing.txt"))
