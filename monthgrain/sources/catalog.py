"""Month-partitioned tables of the catalog, whose months are switched in one step.

A month is written beside the old one, to a folder of its own, and then the catalog is told
that the partition lies there. Until that moment every reader sees the old month, afterwards the
new one; a job that dies in between leaves the old one whole. The catalog also keeps the columns,
so reads open no file to find them, and can keep tables in buckets of the customer, so that months
of one customer meet without moving.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from monthgrain.functions.text import ref, text


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"{ref(f.name)} {f.dataType.simpleString()}" for f in fields)


def create_table(
    spark: SparkSession,
    name: str,
    fields: Sequence[T.StructField],
    by: Sequence[str],
    location: str,
    key: str | None = None,
    buckets: int = 0,
) -> None:
    """A table over a folder, partitioned by ``by`` and, on request, in buckets of ``key``."""
    dealt = ""
    if buckets:
        dealt = f"CLUSTERED BY ({ref(key)}) SORTED BY ({ref(key)}) INTO {buckets} BUCKETS "
    spark.sql(
        f"CREATE TABLE {name} ({_columns(fields)}) USING parquet "
        f"PARTITIONED BY ({', '.join(map(ref, by))}) {dealt}LOCATION {text(location)}"
    )


def evolve_table(spark: SparkSession, name: str, fields: Sequence[T.StructField]) -> None:
    """Add the columns that a table does not have; another type for one it has is an error."""
    known = {f.name.lower(): f.dataType for f in spark.table(name).schema.fields}
    for field in fields:
        before = known.get(field.name.lower(), field.dataType)
        if before != field.dataType:
            raise ValueError(
                f"{name}: column {field.name} is {before.simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    new = [f for f in fields if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(new)})")


def describe_table(spark: SparkSession, name: str, comment: str, keys: Sequence[str] = ()) -> None:
    """Replace a table's comment and the names of its key columns."""
    spark.sql(f"COMMENT ON TABLE {name} IS {text(comment)}")
    if keys:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('keys' = {text(','.join(keys))})")


def table_keys(spark: SparkSession, name: str) -> list[str]:
    """Key columns as ``describe_table`` has noted them."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'keys'").collect()
    return found[0]["value"].split(",") if found else []


def partitions(spark: SparkSession, name: str) -> list[str]:
    """Partitions of a table as ``a=x/b=y``."""
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def partition_spec(partition: str) -> str:
    parts = (p.split("=", 1) for p in partition.split("/"))
    return ", ".join(f"{ref(column)} = {text(value)}" for column, value in parts)


def switch_partitions(spark: SparkSession, name: str, folder: str, new: Sequence[str]) -> None:
    """Tell the catalog that these partitions of a table lie in ``folder``.

    Each is switched in one step: readers have it as it was, or as it is in the folder.
    """
    known = set(partitions(spark, name))
    added = [p for p in new if p not in known]
    for partition in new:
        if partition in known:
            spark.sql(
                f"ALTER TABLE {name} PARTITION ({partition_spec(partition)}) "
                f"SET LOCATION {text(f'{folder}/{partition}')}"
            )
    if added:
        listed = " ".join(
            f"PARTITION ({partition_spec(p)}) LOCATION {text(f'{folder}/{p}')}" for p in added
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {listed}")
    spark.catalog.refreshTable(name)


def staging_name(name: str) -> str:
    return f"{name}__{uuid.uuid4().hex[:12]}"
