"""Turning raw text tables into typed ones. Every operator here is a single projection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.functions.dates import ISO_DATE, parse_date
from monthgrain.functions.text import clean_name, named, ref, tidy_text
from monthgrain.operators.history import KEY

# Id columns that may stand in for the customer id, by priority.
CUSTOMER_IDS = ("rekening", "cusno", "cifno_15", "cifno_01", "cifno_pengirim")

# Id columns of the call-centre tables.
CALL_IDS = ("accnumber", "cifno", "account_no")

# Columns, and endings of column names, that are never turned into numbers.
KEPT_AS_TEXT = (
    "cifno",
    "acct_no",
    "accnumber",
    "calldate",
    "type",
    "id",
    "zipcode",
    "status",
    "date",
    "periodp_id",
    "cusno",
    "branch_id",
    "snapshot_date",
)
KEPT_ENDINGS = ("_id", "_fg", "_date")


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Clean all column names; two columns ending up with one name is an error."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted(n for n, count in Counter(names).items() if count > 1)
    if clashes:
        raise ValueError(f"columns share a name once cleaned: {', '.join(clashes)}")
    return df.toDF(*names)


def tidy_strings(df: DataFrame) -> DataFrame:
    """Apply ``tidy_text`` to every string column."""
    return df.selectExpr(
        *[
            named(tidy_text(ref(f.name)), f.name) if _is_text(f) else ref(f.name)
            for f in df.schema.fields
        ]
    )


def add_customer_id(
    df: DataFrame, candidates: Sequence[str] = CUSTOMER_IDS, key: str = KEY
) -> DataFrame:
    """Add the customer id as the first non-null candidate, unless it is there already.

    The candidates stay in the table. A table without any of them is returned unchanged.
    """
    if key in df.columns:
        return ids_to_text(df, (key,))
    present = [f"string({ref(c)})" for c in candidates if c in df.columns]
    if not present:
        return df
    return df.selectExpr("*", named(f"coalesce({', '.join(present)})", key))


def ids_to_text(df: DataFrame, ids: Collection[str] = CALL_IDS) -> DataFrame:
    """Cast the id columns that are present to text."""
    return df.selectExpr(
        *[named(f"string({ref(c)})", c) if c in ids else ref(c) for c in df.columns]
    )


def _stays_text(name: str) -> bool:
    return name.lower() in KEPT_AS_TEXT or name.lower().endswith(KEPT_ENDINGS)


def as_dates(
    df: DataFrame, names: Collection[str], formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """Parse the named columns, where present and not dates already."""
    parsed = [f.name for f in df.schema.fields if f.name in names and _not_date(f)]
    if not parsed:
        return df
    return df.selectExpr(
        *[
            named(parse_date(ref(c), formats), c) if c in parsed else ref(c)
            for c in df.columns
        ]
    )


def _not_date(field: T.StructField) -> bool:
    return not isinstance(field.dataType, T.DateType)


def harden_types(
    df: DataFrame,
    keep: Collection[str] = (),
    dates: Collection[str] = (),
    date_formats: Sequence[str] = (ISO_DATE,),
) -> DataFrame:
    """Turn columns into doubles, those in ``dates`` into dates; what does not parse is null.

    Columns of ``keep``, and those ids and flags that are text everywhere, stay as they are.
    """

    cast = _casts(df.columns, keep, dates, date_formats)
    return df.selectExpr(*[named(cast[c], c) if c in cast else ref(c) for c in df.columns])


def _casts(
    names: Sequence[str],
    keep: Collection[str],
    dates: Collection[str],
    date_formats: Sequence[str],
) -> dict[str, str]:
    """How each column that does not stay text is read."""
    read = {c: parse_date(ref(c), date_formats) for c in names if c in dates}
    for c in names:
        if c not in read and c not in keep and not _stays_text(c):
            read[c] = f"try_cast({ref(c)} AS double)"
    return read


def observe_losses(
    df: DataFrame,
    observation: Observation,
    keep: Collection[str] = (),
    dates: Collection[str] = (),
    date_formats: Sequence[str] = (ISO_DATE,),
    required: Collection[str] = (),
) -> DataFrame:
    """``df``, counting on the way what ``harden_types`` will lose.

    The observation has, for each column to be read as a number or date, how many texts that
    are not empty do not parse, and as ``<name> is null`` how often a required column is null.
    Nothing is read a second time: the job that writes the result counts.
    """
    cast = _casts(df.columns, keep, dates, date_formats)
    lost = [
        F.expr(named(f"count_if(nullif(trim({ref(c)}), '') IS NOT NULL AND {read} IS NULL)", c))
        for c, read in cast.items()
    ]
    nulls = [
        F.expr(named(f"count_if({ref(c)} IS NULL)", f"{c} is null"))
        for c in required
        if c in df.columns
    ]
    return df.observe(observation, F.count(F.lit(1)).alias("all rows"), *lost, *nulls)


def fill_numbers(df: DataFrame, value: float = 0) -> DataFrame:
    """Replace nulls in numeric columns; text and dates stay null."""
    return df.na.fill(value)


def rename_if_absent(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename ``old`` to ``new`` unless the table has a ``new`` already."""
    return df if new in df.columns else df.withColumnRenamed(old, new)


def clean_bank_table(
    df: DataFrame,
    keep: Collection[str] = (),
    dates: Collection[str] = (),
    date_formats: Sequence[str] = (ISO_DATE,),
    required: Collection[str] = (),
    observation: Observation | None = None,
) -> DataFrame:
    """Names, texts, customer id and types of a bank table.

    An ``observation`` counts what is lost, see ``observe_losses``.
    """
    tidied = add_customer_id(tidy_strings(sanitize_columns(df)))
    if observation is not None:
        tidied = observe_losses(tidied, observation, keep, dates, date_formats, required)
    return harden_types(tidied, keep, dates, date_formats)


def clean_call_table(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Names and ids of a call-centre table; texts are tidied only on request."""
    named = sanitize_columns(df)
    return ids_to_text(tidy_strings(named) if tidy else named)
