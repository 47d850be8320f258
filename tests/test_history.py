import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from monthgrain.months import months_back
from monthgrain.operators.history import attach_history
from tests.conftest import rows

SCHEMA = "cifno string, snapshot_date string, a double, b double"
LAGS = {0: ("a", "b"), 1: ("a",), 2: ("a",), 5: ("b",)}
NAMES = ["a_lag0", "b_lag0", "a_lag1", "a_lag2", "b_lag5"]


def sparse(seed, customers=40):
    """Random months of random customers, with gaps and null values."""
    pick = random.Random(seed)
    months = months_back("200203", 16)
    return [
        (f"{c:03d}", m, pick.choice([None, float(pick.randint(-5, 5))]), float(pick.randint(0, 9)))
        for c in range(customers)
        for m in months
        if pick.random() < 0.5
    ]


def by_hand(data, anchor):
    months = months_back(anchor, 6)
    at = {(c, m): (a, b) for c, m, a, b in data}
    out = []
    for c in sorted({c for c, m, _, _ in data if m == anchor}):
        a = [at.get((c, m), (None, None))[0] for m in months]
        b = [at.get((c, m), (None, None))[1] for m in months]
        out.append((c, anchor, a[0], b[0], a[1], a[2], b[5]))
    return out


@pytest.mark.parametrize("seed, unique", [(1, False), (2, True)])
def test_both_forms_and_brute_force_agree(spark, seed, unique):
    data = sparse(seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    everywhere = attach_history(df, LAGS, unique=unique).cache()
    assert everywhere.count() == len(data)
    for anchor in months_back("200203", 16):
        one = attach_history(df, LAGS, anchor, unique=unique)
        assert one.columns == ["cifno", "snapshot_date", *NAMES]
        expected = sorted(by_hand(data, anchor), key=str)
        assert rows(one) == expected
        assert rows(everywhere.where(F.col("snapshot_date") == anchor)) == expected


def test_a_range_of_anchors_keeps_its_history(spark):
    data = sparse(3)
    df = spark.createDataFrame(data, SCHEMA)
    some = attach_history(df, LAGS, since="200108", until="200110")
    expected = [r for m in ("200108", "200109", "200110") for r in by_hand(data, m)]
    assert rows(some) == sorted(expected, key=str)


def test_sums_over_a_hot_customer(spark):
    """A third of all rows belong to one customer; they are added up before the shuffle."""
    hot = spark.range(30_000).selectExpr(
        "'hot' AS cifno", "if(id % 2 = 0, '200106', '200104') AS snapshot_date", "1D AS n"
    )
    rest = spark.range(60_000).selectExpr(
        "string(id % 20000) AS cifno", "'200106' AS snapshot_date", "1D AS n"
    )
    df = hot.unionByName(rest)
    lags = {0: ("n",), 2: ("n",)}
    for snapshot in ("200106", None):
        wide = attach_history(df, lags, snapshot, sums={"n": "n"})
        assert rows(wide.where("cifno = 'hot' AND snapshot_date = '200106'")) == [
            ("hot", "200106", 15_000.0, 15_000.0)
        ]
        assert wide.where("snapshot_date = '200106'").count() == 20_001
        assert wide.where("snapshot_date = '200106'").agg(F.sum("n_lag0")).first()[0] == 75_000


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("snapshot", ["200106", None])
@pytest.mark.parametrize(
    "data, message",
    [
        ([("c", "200106", 1.0, 1.0), ("c", "200106", 1.0, 1.0)], "more than one row"),
        ([("c", "200106", 1.0, 1.0)] + 2 * [("c", "200104", 1.0, 1.0)], "more than one row"),
        ([(None, "200106", 1.0, 1.0)], "cifno is null"),
    ],
)
def test_broken_keys_stop_the_run(spark, snapshot, unique, data, message):
    df = spark.createDataFrame(data, SCHEMA)
    with pytest.raises(PySparkException, match=message):
        attach_history(df, LAGS, snapshot, unique=unique).collect()


def test_sums_are_not_unique(spark):
    with pytest.raises(ValueError):
        attach_history(
            spark.createDataFrame([], SCHEMA), {0: ("a",)}, "200106", sums={"a": "a"}, unique=True
        )


def test_nobody_at_the_anchor(spark):
    df = spark.createDataFrame([("c", "200105", 1.0, 1.0)], SCHEMA)
    assert rows(attach_history(df, LAGS, "200106")) == []


def test_lag_zero_is_required(spark):
    with pytest.raises(ValueError):
        attach_history(spark.createDataFrame([], SCHEMA), {1: ("a",)}, "200106")


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(sparse(4), SCHEMA)
    df.write.partitionBy("snapshot_date").parquet(path)
    return spark.read.parquet(path).withColumn(
        "snapshot_date", F.col("snapshot_date").cast("string")
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_of_one_anchor(stored):
    plan = plan_of(attach_history(stored, LAGS, "200203"))
    assert plan.count("Exchange") == 1
    assert "Join" not in plan and "SortAggregate" not in plan
    assert plan.count("HashAggregate") == 2


def test_each_month_is_scanned_once_for_what_it_is_asked_for(stored):
    plan = plan_of(attach_history(stored, LAGS, "200203"))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    found = {
        re.search(r"cast\(snapshot_date#\d+ as string\) (.*?)\]", s)[1]: re.search(
            r"ReadSchema: struct<(.*)>", s
        )[1]
        for s in scans
    }
    assert found == {
        "= 200203)": "cifno:string,a:double,b:double",
        "IN (200202,200201)": "cifno:string,a:double",
        "= 200110)": "cifno:string,b:double",
    }


def test_plan_reads_only_what_is_used(stored):
    plan = plan_of(attach_history(stored, LAGS, "200203").select("cifno", "b_lag5"))
    assert set(re.findall(r"ReadSchema: struct<(.*)>", plan)) == {
        "cifno:string",
        "cifno:string,b:double",
    }


def test_plan_of_all_anchors(stored):
    plan = plan_of(attach_history(stored, LAGS))
    assert "Join" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange") == 2
    assert plan.count("Window [") == 1


@pytest.mark.parametrize("snapshot", ["200203", None])
def test_plan_for_unique_rows_has_one_shuffle_of_plain_rows(stored, snapshot):
    plan = plan_of(attach_history(stored, LAGS, snapshot, unique=True))
    assert plan.count("Exchange") == 1
    assert "Join" not in plan and "SortAggregate" not in plan
    below = plan[plan.index("Exchange"):]
    assert "Aggregate" not in below and "Window" not in below


def test_default_backfill_holds_no_wide_rows_in_hash_tables(stored):
    plan = plan_of(attach_history(stored, LAGS))
    assert "HashAggregate" not in plan.replace("ObjectHashAggregate", "")
