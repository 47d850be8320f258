from monthgrain.plans.labels import call_labels
from tests.conftest import rows

CALLS = "accnumber string, callid string, calldate string, snapshot_date string"


def calls(spark, *pairs, month="202401"):
    return spark.createDataFrame([(a, c, "2024-01-05", month) for a, c in pairs], CALLS)


def mapping(spark, *pairs):
    return spark.createDataFrame(list(pairs), "cifno string, rekening string")


def test_outcomes(spark):
    log = calls(
        spark, ("R1", "901"), ("R1", "202"), ("R2", "201"), ("R3", "900"), ("R4", "ERR"),
        ("R5", "901.0"), ("R6", None), (None, "901"), ("R9", "901"),
    )
    known = mapping(spark, *[(f"c{i}", f"R{i}") for i in range(1, 8)], ("cx", None))
    out = call_labels(log, known, "202401")
    assert rows(out) == [("c1", 0, "202401"), ("c1", 1, "202401"), ("c3", 0, "202401")]
    best = call_labels(log, known, "202401", per_customer=True)
    assert rows(best) == [("c1", 1, "202401"), ("c3", 0, "202401")]


def test_other_months_and_other_keys(spark):
    log = calls(spark, ("c1", "901")).unionByName(calls(spark, ("c1", "202"), month="202402"))
    known = mapping(spark, ("c1", "R1"))
    out = call_labels(log, known, "202402", mapping_key="cifno")
    assert rows(out) == [("c1", 0, "202402")]


def test_accounts_shared_by_customers(spark):
    log = calls(spark, ("R1", "901"), ("R1", "300"))
    known = mapping(spark, ("a", "R1"), ("b", "R1"))
    assert len(rows(call_labels(log, known, "202401"))) == 4
    assert rows(call_labels(log, known, "202401", per_customer=True), "cifno", "label") == [
        ("a", 1),
        ("b", 1),
    ]


def test_one_account_with_a_third_of_all_calls(spark, tmp_path):
    """The join of a hot account is split by adaptive execution, and nothing is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        log = spark.range(0, 300_000, 1, 8).selectExpr(
            "if(id % 3 = 0, 'R7', 'R' || (id % 5000)) AS accnumber",
            "if(id % 2 = 0, '901', '202') AS callid",
            "'2024-01-05' AS calldate",
            "'202401' AS snapshot_date",
        )
        known = spark.range(5000).selectExpr("string(id) AS cifno", "'R' || id AS rekening")
        out = call_labels(log, known, "202401")
        assert len(out.collect()) == 300_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        best = call_labels(log, known, "202401", per_customer=True)
        assert best.count() == 5000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
