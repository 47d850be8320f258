"""Training labels from the call log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.functions.text import named, ref
from monthgrain.months import MONTH
from monthgrain.operators.history import KEY
from monthgrain.operators.snapshots import scan_snapshot

# Call outcomes from here on were answered, and bought.
CONTACTED = 202
CONVERTED = 901

_ACCOUNT = "_account"


def call_labels(
    calls: DataFrame,
    mapping: DataFrame,
    snapshot: str,
    *,
    call_key: str = "accnumber",
    mapping_key: str = "rekening",
    per_customer: bool = False,
) -> DataFrame:
    """Label 1 for converted and 0 for merely answered calls, by customer.

    One row per call and mapped customer, or with ``per_customer`` one row per customer
    holding the best outcome. Outcomes that are not whole numbers count as unanswered.
    """
    outcome = "try_cast(callid AS int)"
    labels = (
        scan_snapshot(calls, snapshot)
        .where(f"{outcome} >= {CONTACTED}")
        .selectExpr(named(ref(call_key), _ACCOUNT), f"int({outcome} >= {CONVERTED}) AS label")
    )
    if per_customer:
        # One row per account before the join: an account with many calls stays small.
        labels = labels.groupBy(_ACCOUNT).agg(F.max("label").alias("label"))
    joined = labels.join(mapping.selectExpr(named(ref(mapping_key), _ACCOUNT), KEY), _ACCOUNT)
    if per_customer:
        joined = joined.groupBy(KEY).agg(F.max("label").alias("label"))
    return joined.select(KEY, "label", F.lit(snapshot).alias(MONTH))
