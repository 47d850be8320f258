"""Bank-like monthly tables derived from the shared star schema.

Each function takes (spark, folder) and returns a DataFrame over the whole tables. The SQL
twins in ``checks/oracle.py`` define the same relations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrain.plans.transactions import EDC_GROUPS, OUTFLOW_CHANNELS

CALL_MONTH = "202401"

CATEGORIES = [c for listed in EDC_GROUPS.values() for c in listed]
CELLS = [(flag, status) for flag in "ANR" for status in "FO"]
PURCHASE_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
OPENED = {"s": "SMALL", "d": "MEDIUM", "g": "LARGE", "c": "ECONOMY"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _double(c: Column) -> Column:
    return c.cast("double")


def lines(spark: SparkSession, folder: str, parts: bool = False) -> DataFrame:
    """Line items with customer, month and price; with part size and type on request."""
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    extra = []
    if parts:
        part = table(spark, folder, "part")
        joined = joined.join(part, items.l_partkey == part.p_partkey)
        extra = ["p_size", "p_type"]
    return joined.select(
        F.col("o_custkey").cast("string").alias("cifno"),
        F.date_format("l_shipdate", "yyyyMM").alias("snapshot_date"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        # Eight digits hold any price, and their sums still fit a machine word.
        F.col("l_extendedprice").cast("decimal(8,2)").alias("price"),
        "o_custkey",
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        *extra,
    )


def fx_cifsumm(spark: SparkSession, folder: str) -> DataFrame:
    price, day = F.col("price"), F.col("shipped")
    grouped = (
        lines(spark, folder)
        .groupBy("o_custkey", "cifno", "snapshot_date")
        .agg(
            (F.expr("cast(sum(price) * 100 as bigint) div count(price)") / 100.0).alias("avg"),
            F.round(F.stddev_samp(_double(price)), 2).alias("sdev"),
            *[
                _double(F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY price)")).alias(n)
                for n, p in (("med", 0.5), ("qt1", 0.25), ("qt3", 0.75))
            ],
            _double(F.max(price)).alias("mx"),
            _double(F.min(price)).alias("mn"),
            _double(F.sum(F.when(F.dayofmonth(day) <= 20, price))).alias("d20"),
            _double(F.sum(price)).alias("eom"),
            _double(
                F.bit_count(F.bit_or(F.expr("shiftleft(1L, dayofmonth(shipped))")))
            ).alias("nod"),
            F.min(F.struct(-price, day)).getField("shipped").alias("mxdt"),
            F.min(F.struct(price, day)).getField("shipped").alias("mndt"),
        )
    )

    def shifted(c: str) -> Column:
        return (
            F.when(F.col("o_custkey") % 17 == 0, F.date_add(F.add_months(c, 1), 1))
            .when(F.col("o_custkey") % 19 == 0, F.lit(None).cast("date"))
            .otherwise(F.col(c))
        )

    return grouped.withColumns(
        {
            "mxdt": shifted("mxdt"),
            "mndt": shifted("mndt"),
            "avgd": F.col("avg"),
            "mnd": F.col("mn"),
            "eomd": F.col("eom"),
        }
    ).drop("o_custkey")


def fx_tran_net(spark: SparkSession, folder: str) -> DataFrame:
    def side(status: str, what: Column) -> Column:
        return _double(F.sum(F.when(F.col("l_linestatus") == status, what)))

    return (
        lines(spark, folder)
        .groupBy("cifno", "snapshot_date")
        .agg(
            side("O", F.col("price")).alias("sum_cd"),
            side("O", F.lit(1)).alias("num_cd"),
            side("F", F.col("price")).alias("sum_db"),
            side("F", F.lit(1)).alias("num_db"),
        )
    )


def fx_outflow(spark: SparkSession, folder: str) -> DataFrame:
    def cell(flag: str, status: str) -> Column:
        here = (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)
        return _double(F.sum(F.when(here, F.col("price"))))

    return (
        lines(spark, folder)
        .groupBy(
            F.col("cifno").alias("cifno_pengirim"),
            F.col("l_orderkey").cast("string").alias("rekening_pengirim"),
            "snapshot_date",
        )
        .agg(
            *[cell(*CELLS[i]).alias(c) for i, c in enumerate(OUTFLOW_CHANNELS)],
            _double(F.sum("price")).alias("trx_total"),
        )
    )


def fx_purchase(spark: SparkSession, folder: str) -> DataFrame:
    return lines(spark, folder, parts=True).select(
        F.col("cifno").alias("customer_no"),
        F.col("p_type").alias("transaction_type"),
        F.lit(1.0).alias("frek"),
        _double(F.col("price")).alias("nominal"),
        "snapshot_date",
    )


def fx_edc(spark: SparkSession, folder: str) -> DataFrame:
    by_category = (
        lines(spark, folder, parts=True)
        .selectExpr(
            "cifno", "snapshot_date", f"int(p_size % {len(CATEGORIES)}) AS category", "price"
        )
        .groupBy("cifno", "snapshot_date", "category")
        .agg(F.expr("double(count(*)) AS freq"), F.expr("double(sum(price)) AS sv"))
    )
    # The few categories of a customer are held, not a wide row of mostly nulls for each.
    held = "collect_list(struct(category, struct(freq, sv))) FILTER (WHERE category IS NOT NULL)"
    monthly = by_category.groupBy("cifno", "snapshot_date").agg(
        F.expr(f"map_from_entries({held}) AS held")
    )
    return monthly.selectExpr(
        "cifno",
        "snapshot_date",
        *[f"held[{i}].{m} AS {c}_{m}" for i, c in enumerate(CATEGORIES) for m in ("freq", "sv")],
    )


def fx_phsumm(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("p_size") % 18 + 1
    years = 18 + F.col("o_custkey") % 6
    opened = F.add_months("shipped", (-12 * years).cast("int"))

    def dated(c: Column) -> Column:
        text = F.date_format(c, "yyyy-MM-dd")
        return F.when(
            c.isNotNull(),
            F.when(F.col("o_custkey") % 13 == 0, F.lit("1900-01-01"))
            .when(F.col("o_custkey") % 29 == 0, F.lit("2999-12-31"))
            .otherwise(text),
        )

    grouped = (
        lines(spark, folder, parts=True)
        .groupBy("o_custkey", "cifno", "snapshot_date")
        .agg(
            *[_double(4 * F.sum(F.when(kind == k, 1))).alias(f"t{k}") for k in range(1, 19)],
            _double(4 * F.count(F.lit(1))).alias("lines"),
            _double(F.sum(F.when(kind.between(12, 17), F.col("price")))).alias("loanall_s"),
            *[
                f(F.when(F.col("p_type") == kind_of, opened)).alias(f"{p}{end}stopn")
                for p, kind_of in OPENED.items()
                for end, f in (("f", F.min), ("l", F.max))
            ],
        )
    )
    dates = {f"{p}{e}stopn": dated(F.col(f"{p}{e}stopn")) for p in OPENED for e in "fl"}
    return grouped.withColumns(
        {**dates, "totph": F.when(F.col("o_custkey") % 23 != 0, F.col("lines"))}
    ).drop("o_custkey", "lines")


def fx_avr(spark: SparkSession, folder: str) -> DataFrame:
    return lines(spark, folder).select(
        "cifno",
        "snapshot_date",
        F.when(F.col("l_linenumber") != 7, _double(F.col("price"))).alias("sum_end_bal"),
        F.when(F.col("l_orderkey") % 10 != 0, _double(3 * F.col("l_linenumber"))).alias("nb_accts"),
    )


def fx_card(spark: SparkSession, folder: str) -> DataFrame:
    return (
        lines(spark, folder)
        .groupBy("cifno", "snapshot_date")
        .agg(
            *[
                _double(F.count_if(F.col("l_returnflag") == flag)).alias(f"cnt_{flag.lower()}")
                for flag in "ANR"
            ]
        )
    )


def fx_call(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.concat(F.lit("R"), F.col("user_id").cast("string")).alias("accnumber"),
        F.when(kind == "view", "101")
        .when(kind == "click", "202")
        .when(kind == "signup", "500")
        .when(kind == "purchase", "901")
        .when(kind == "error", "ERR")
        .alias("callid"),
        F.date_format("ts", "yyyy-MM-dd").alias("calldate"),
        F.lit(CALL_MONTH).alias("snapshot_date"),
    )


def fx_call_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Calls as they are delivered: awkward headers, ids as numbers, texts not trimmed."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias(" AccNumber"),
        F.col("event_id").alias("Account No"),
        F.when(F.col("event_id") % 7 == 0, F.lit("(null)"))
        .otherwise(F.concat(F.lit(" "), F.col("event_type")))
        .alias("Call(Type)"),
        F.col("value").alias("Value=1"),
        F.lit(CALL_MONTH).alias("snapshot_date"),
    )


def fx_mapping(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        key.alias("cifno"), F.concat(F.lit("R"), key).alias("rekening")
    )


def fx_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with awkward headers and values, as they would come from a raw table."""
    key = F.col("c_custkey")
    text = key.cast("string")

    def every(n: int) -> Column:
        return key % n == 0

    return table(spark, folder, "customer").select(
        F.when(every(5), F.lit("(null)")).otherwise(F.concat(F.lit(" C"), text)).alias("Cus No"),
        F.when(every(7), F.lit(" (null) "))
        .when(every(8), F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
        .alias(" Seg,ment"),
        F.when(every(9), F.lit("n/a"))
        .when(every(11), F.lit("(null)"))
        .otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
        .alias("Bal(IDR)"),
        F.concat(
            F.lit("2001-06-"),
            F.lpad((key % 28 + 1).cast("string"), 2, "0"),
            F.when(every(6), F.lit(" 00:00:00")).otherwise(F.lit("")),
        ).alias("Open Date"),
        F.when(every(10), F.lit("(null)")).otherwise(F.concat(F.lit("0"), text)).alias("Rekening"),
        F.lit(CALL_MONTH).alias("snapshot_date"),
    )


def fx_features_v1(spark: SparkSession, folder: str) -> DataFrame:
    """A first version of a feature set: amounts by shipping month."""
    return (
        lines(spark, folder)
        .groupBy("cifno", "snapshot_date")
        .agg(_double(F.sum("price")).alias("amount"), F.count(F.lit(1)).alias("items"))
    )


def fx_features_v2(spark: SparkSession, folder: str) -> DataFrame:
    """A second version: amounts by order month, so some keys are changed and some are new."""
    return (
        table(spark, folder, "orders")
        .groupBy(
            F.col("o_custkey").cast("string").alias("cifno"),
            F.date_format("o_orderdate", "yyyyMM").alias("snapshot_date"),
        )
        .agg(
            _double(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).alias("amount"),
            F.count(F.lit(1)).alias("items"),
        )
    )
