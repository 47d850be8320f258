"""Catalog tables: registration, months switched in one step, columns that come later, buckets."""

import uuid

import pytest

from monthgrain.operators.history import attach_history
from monthgrain.plans.balance import balance_window
from monthgrain.plans.job import register_feature_table
from monthgrain.sources import catalog
from monthgrain.sources.catalog_warehouse import CatalogWarehouse
from monthgrain.sources.warehouse import CLEAN, FEATURES, RAW, Warehouse
from tests.conftest import rows

SCHEMA = "cifno string, x double, snapshot_date string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture
def prefix(spark):
    name = f"p{uuid.uuid4().hex[:8]}"
    yield name
    for database in spark.catalog.listDatabases():
        if database.name.startswith(name):
            spark.sql(f"DROP DATABASE {database.name} CASCADE")


@pytest.fixture
def store(spark, tmp_path, prefix):
    return CatalogWarehouse(spark, str(tmp_path / "wh"), prefix, buckets=4)


def test_registered_twice(spark, tmp_path, prefix):
    """A new column, another comment and keys widened by the month, read by name."""
    spark.sql(f"CREATE DATABASE {prefix}")
    plain = Warehouse(spark, str(tmp_path / "plain"))
    plain.replace_months(CLEAN, "a", frame(spark, ("a", 1.0, "200105"), ("b", 2.0, "200106")))
    more = frame(spark, ("a", 3.0, "200106"), ("b", 4.0, "200106")).selectExpr("*", "'n' AS note")
    plain.replace_months(CLEAN, "b", more)
    for table, comment in (("a", "first"), ("b", "it's second")):
        name = register_feature_table(plain, table, "f", ["cifno"], comment, database=prefix)
    assert name == f"{prefix}.f"
    assert spark.catalog.getTable(name).description == "it's second"
    assert catalog.table_keys(spark, name) == ["cifno", "snapshot_date"]
    assert rows(spark.table(name), "cifno", "x", "note", "snapshot_date") == [
        ("a", 1.0, None, "200105"), ("a", 3.0, "n", "200106"), ("b", 4.0, "n", "200106")
    ]
    with pytest.raises(ValueError, match="column x is double, not string"):
        catalog.evolve_table(spark, name, more.selectExpr("'t' AS x").schema.fields)


def test_months_are_switched_whole(spark, store, monkeypatch):
    old = frame(spark, ("a", 1.0, "200105"), ("b", 2.0, "200106"))
    assert store.replace_months(RAW, "t", old) == 2
    new = frame(spark, ("c", 3.0, "200106"), ("d", 4.0, "200107"))

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(catalog, "switch_partitions", lost)
        with pytest.raises(RuntimeError):
            store.replace_months(RAW, "t", new)
    assert rows(store.read(RAW, "t")) == [("a", 1.0, "200105"), ("b", 2.0, "200106")]
    assert store.tables(RAW) == ["t"]
    begun = store.read(RAW, "t", ["200106"])
    begun.count()  # a reader that has listed its files
    assert store.replace_months(RAW, "t", new) == 2
    assert rows(store.read(RAW, "t")) == [
        ("a", 1.0, "200105"), ("c", 3.0, "200106"), ("d", 4.0, "200107")
    ]
    assert store.stored_months(RAW, "t", ["200107", "200101"]) == ["200107"]
    assert len(store.drop_replaced(RAW, "t")) == 1  # of the write that was lost
    assert store.read(RAW, "t").count() == 3


def test_months_merged_by_key(spark, store):
    store.upsert(FEATURES, "f", frame(spark, ("a", 1.0, "200105"), ("b", 2.0, "200105")), ("cifno", "snapshot_date"))
    more = frame(spark, ("b", 3.0, "200105"), ("c", 4.0, "200106")).selectExpr("*", "1 AS n")
    assert store.upsert(FEATURES, "f", more, ("cifno", "snapshot_date")) == 3
    assert rows(store.read(FEATURES, "f"), "cifno", "x", "n") == [
        ("a", 1.0, None), ("b", 3.0, 1), ("c", 4.0, 1)
    ]
    with pytest.raises(ValueError, match="column n is int, not double"):
        store.replace_months(FEATURES, "f", more.selectExpr("cifno", "x", "1D AS n", "snapshot_date"))


def test_buckets_meet_without_exchange(spark, store):
    """Six months of a customer are read where they lie, and give the same rows."""
    folder = "/root/testdata/sf0.001"
    from checks import relations as rel

    summary = rel.fx_cifsumm(spark, folder).cache()
    store.replace_months(CLEAN, "cifsumm", summary)
    stored = store.read(CLEAN, "cifsumm")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = balance_window(stored, "200106", bucketed=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 6 and "Exchange" not in plan
        backfill = balance_window(stored, unique=True)
        assert "Exchange" not in backfill._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(found) == rows(balance_window(summary, "200106"))
    assert rows(backfill) == rows(balance_window(summary))
    summary.unpersist()


def test_buckets_check_their_key(spark):
    twice = frame(spark, ("a", 1.0, "200106"), ("a", 2.0, "200105"), ("a", 3.0, "200105"))
    with pytest.raises(Exception, match="more than one row"):
        attach_history(twice, {0: ("x",), 1: ("x",)}, "200106", bucketed=True).collect()
    late = frame(spark, ("a", 1.0, "200106"), ("b", 2.0, "200104"))
    found = attach_history(late, {0: ("x",), 2: ("x",)}, "200106", bucketed=True)
    assert rows(found) == [("a", "200106", 1.0, None)]


def test_reads_open_no_file(spark, tmp_path):
    """Columns come from the ledger: no job runs before the read is used, later ones are there."""
    plain = Warehouse(spark, str(tmp_path / "wh"))
    plain.replace_months(RAW, "t", frame(spark, ("a", 1.0, "200105")))
    plain.replace_months(RAW, "t", frame(spark, ("b", 2.0, "200106")).selectExpr("*", "'n' AS note"))
    spark.sparkContext.setJobGroup("reading", "reading")
    table = plain.read(RAW, "t")
    merged = plain.read(RAW, "t", ["200105"])
    tracker = spark.sparkContext.statusTracker()
    assert list(tracker.getJobIdsForGroup("reading")) == []
    plain.read(RAW, "t", merge_schema=True)
    assert len(tracker.getJobIdsForGroup("reading")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(table) == [("a", 1.0, None, "200105"), ("b", 2.0, "n", "200106")]
    assert merged.columns == ["cifno", "x", "note", "snapshot_date"]
    with pytest.raises(ValueError, match="column x is double, not string"):
        plain.replace_months(RAW, "t", frame(spark).selectExpr("cifno", "'t' AS x", "snapshot_date"))
