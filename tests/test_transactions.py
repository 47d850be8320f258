import random

import pytest

from monthgrain.plans import transactions as trx
from tests.conftest import rows

NET = "cifno string, snapshot_date string, sum_cd double, sum_db double, num_cd double, num_db double"


def test_net_flow(spark):
    data = [
        ("a", "200106", 10.0, 4.0, None, 1.0),
        ("a", "200104", 0.0, 8.0, 1.0, 1.0),
        ("a", "200101", None, 2.0, 1.0, 1.0),
        ("b", "200105", 1.0, 1.0, 1.0, 1.0),
    ]
    out = trx.trx_net(spark.createDataFrame(data, NET), "200106")
    (row,) = out.collect()
    assert row.cifno == "a" and row.num_cd == 0.0
    assert row.sum_cd_db_diff == 6.0 and row.num_cd_db_diff == -1.0
    assert row.db_lm_lm3_diff == -0.5 and row.db_lm3_lm6_diff == 3.0
    assert row.cd_lm_lm3_diff == 10.0 and row.cd_lm3_lm6_diff == 0.0
    assert (row.max_db_lm3, row.min_db_lm3, row.mean_db_lm3) == (8.0, 4.0, 6.0)
    assert (row.max_db_lm6, row.min_db_lm6, row.mean_db_lm6) == (8.0, 2.0, 14 / 3)


def test_a_past_amount_but_no_recent_one(spark):
    data = [("a", "200106", 1.0, 1.0, 1.0, 1.0), ("a", "200101", 1.0, 5.0, 1.0, 1.0)]
    (row,) = trx.trx_net(spark.createDataFrame(data, NET), "200106").collect()
    assert row.db_lm3_lm6_diff is None
    assert row.db_lm_lm3_diff == 0.0


def test_net_flow_by_another_key_name(spark):
    df = spark.createDataFrame([("a", "200106", 1.0, 1.0, 1.0, 1.0)], NET)
    out = trx.trx_net(df.withColumnRenamed("cifno", "cif"), "200106")
    assert rows(out, "cifno", "sum_cd") == [("a", 1.0)]


OUT = (
    "cifno_pengirim string, rekening_pengirim string, snapshot_date string, withdrawal double, "
    "transfer_to_others double, trx_total double"
)


def test_outflow_shares(spark):
    data = [
        ("a", "1", "200106", 1.0, None, 2.0),
        ("a", "2", "200106", 2.0, None, 2.0),
        ("b", "3", "200106", 1.0, 0.0, 0.0),
    ]
    out = trx.outflow_shares(spark.createDataFrame(data, OUT), "200106")
    assert rows(out, "cifno", "withdrawal_per", "transfer_to_others_per", "trx_total") == [
        ("a", 0.75, 0.0, 4.0),
        ("b", 0.0, 0.0, 0.0),
    ]


def test_outflow_where_cleaning_added_the_customer(spark):
    df = spark.createDataFrame([("p", "1", "200106", 1.0, 1.0, 2.0)], OUT)
    out = trx.trx_outflow(df.selectExpr("*", "'k' AS cifno"), "200106")
    assert rows(out, "cifno", "trx_total", "max_trxout_lm6") == [("k", 2.0, 2.0)]
    assert "cifno_pengirim" not in out.columns


BUY = "customer_no string, snapshot_date string, transaction_type string, frek double, nominal double"


def test_purchases_count_unlisted_types_in_the_totals(spark):
    data = [
        ("a", "200106", "X", 1.0, 30.0),
        ("a", "200106", "Y", 1.0, 60.0),
        ("a", "200106", None, 1.0, 10.0),
        ("a", "200106", "X", None, None),
        ("a", "200104", "Z", 2.0, 50.0),
    ]
    df = spark.createDataFrame(data, BUY)
    (row,) = trx.trx_outflow_purchase(df, "200106", ["X", "Y"]).collect()
    assert (row.X_freq, row.Y_freq, row.sum_purchase_freq) == (1.0, 1.0, 3.0)
    assert (row.X_amt_per, row.Y_amt_per, row.sum_purchase_amt) == (0.3, 0.6, 100.0)
    assert row.purchase_amt_lm_lm3_diff == 1.0 and row.mean_purchase_amt_lm3 == 75.0


def test_purchase_types_with_odd_names(spark):
    df = spark.createDataFrame([("a", "200106", "O'Neil's - 5%", 1.0, 2.0)], BUY)
    out = trx.trx_outflow_purchase(df, "200106", ["O'Neil's - 5%"])
    assert rows(out, "O'Neil's - 5%_amt", "O'Neil's - 5%_amt_per") == [(2.0, 1.0)]


def test_names_with_lag_are_kept(spark):
    df = spark.createDataFrame([("a", "200106", "pay_lagoon", 2.0, 5.0)], BUY)
    out = trx.trx_outflow_purchase(df, "200106", ["pay_lagoon"])
    assert rows(out, "pay_lagoon_freq", "pay_lagoon_amt") == [(2.0, 5.0)]
    net = spark.createDataFrame(
        [("a", "200106", 1.0, 2.0, 3.0, 4.0, 5.0)],
        "cifno string, snapshot_date string, sum_cd double, sum_db double, "
        "num_cd double, num_db double, avg_lag_days double",
    )
    assert rows(trx.trx_net(net, "200106"), "avg_lag_days") == [(5.0,)]


@pytest.mark.parametrize("types", [["Pay", "PAY"], ["sum_purchase"]])
def test_clashing_types(spark, types):
    df = spark.createDataFrame([], BUY)
    with pytest.raises(ValueError, match=types[-1]):
        trx.purchase_pivot(df, types)


def test_backfill_needs_types(spark):
    with pytest.raises(ValueError):
        trx.trx_outflow_purchase(spark.createDataFrame([], BUY))


EDC = (
    "cifno string, snapshot_date string, spbu_freq double, spbu_sv double, vehicle_freq double, "
    "vehicle_sv double, hotel_sv double"
)


def test_group_named_like_its_category(spark):
    df = spark.createDataFrame([("a", "200106", 1.0, 10.0, 2.0, 20.0, None)], EDC)
    out = trx.edc_groups(df, "200106")
    assert out.columns.count("vehicle_sv") == 1
    assert rows(out, "vehicle_freq", "vehicle_sv", "spbu_sv", "travel_sv", "sum_sv") == [
        (3.0, 30.0, 10.0, 0.0, 30.0)
    ]
    assert rows(out, "vehicle_sv_per", "luxury_sv_per") == [(1.0, 0.0)]


def test_both_ways_to_group_sums_agree(spark):
    pick = random.Random(5)
    data = [
        (f"{c}", m, *[pick.choice([None, float(pick.randint(0, 9))]) for _ in range(5)])
        for c in range(30)
        for m in ("200106", "200105", "200101")
    ]
    df = spark.createDataFrame(data, EDC)
    rolled = trx.edc_groups(df, "200106")
    features = trx.debit_edc(df, "200106")
    assert rows(features, *rolled.columns) == rows(rolled, *rolled.columns)
    shares = [c for c in rolled.columns if c.endswith("_sv_per")]
    for row in rolled.collect():
        assert sum(row[c] for c in shares) == pytest.approx(1.0 if row.sum_sv > 0 else 0.0)


@pytest.mark.parametrize("snapshot", ["200106", None])
@pytest.mark.parametrize("unique", [False, True])
def test_all_categories_plan_quickly_and_alike(spark, snapshot, unique):
    """33 categories under one sum, filtered: must not set the optimizer multiplying."""
    names = [f"{c}_{m}" for g in trx.EDC_GROUPS.values() for c in g for m in ("freq", "sv")]
    row = ", ".join(f"double({i}) AS {n}" for i, n in enumerate(names))
    df = spark.sql(f"SELECT 'a' AS cifno, '200106' AS snapshot_date, {row}")
    out = trx.debit_edc(df, snapshot, unique=unique).where("snapshot_date = '200106'")
    assert rows(out, "sum_sv", "max_sv_lm6") == [(1089.0, 1089.0)]


def test_card_payments_are_spread_from_the_few_categories_held(spark, tmp_path):
    from checks import relations

    orders = [(k, k // 2) for k in range(6)] + [(6, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    parts = [(1, 1, "a"), (2, 34, "b"), (3, None, "c"), (4, 32, None), (5, -2, "d")]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_type string").write.parquet(
        f"{tmp_path}/part.parquet"
    )
    items = [
        (0, 1, "2001-01-05", 10.0), (1, 2, "2001-01-09", 5.0), (1, 4, "2001-01-10", None),
        (2, 3, "2001-02-01", 7.0), (4, 5, "2001-02-01", 1.0), (6, 1, None, 3.0),
    ]
    spark.createDataFrame(
        [(o, p, 1, price, "A", "F", d) for o, p, d, price in items],
        "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate string",
    ).selectExpr("* EXCEPT (l_shipdate)", "cast(l_shipdate AS timestamp) AS l_shipdate").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    out = relations.fx_edc(spark, str(tmp_path))
    found = {}
    for r in out.collect():
        row = r.asDict()
        key = row.pop("cifno"), row.pop("snapshot_date")
        found[key] = {n: v for n, v in row.items() if v is not None}
    first, last = relations.CATEGORIES[1], relations.CATEGORIES[32]
    assert found == {
        ("0", "200101"): {f"{first}_freq": 2.0, f"{first}_sv": 15.0, f"{last}_freq": 1.0},
        ("1", "200102"): {},
        ("2", "200102"): {},
        (None, None): {f"{first}_freq": 1.0, f"{first}_sv": 3.0},
    }
    # no hash table of rows as wide as the result
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "max(" not in plan
