"""Tables stored as Parquet folders, partitioned by month."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from monthgrain.months import MONTH
from monthgrain.operators.merge import broken_keys, merge_by_key
from monthgrain.sources.catalog import create_table, describe_table, evolve_table
from monthgrain.sources.files import folders, path_exists, read_text, write_text

RAW, CLEAN, FEATURES, AUDIT = "raw", "clean", "features", "audit"
#: The history of feature sets, kept between months.
STATE = "state"

#: File with the columns of a table; Spark passes over names that begin like this.
LEDGER = "_columns.json"


def shared_folder(spark: SparkSession) -> str:
    """A new folder name in the cluster's shared folder, which ``spark.checkpoint.dir`` names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{root.rstrip('/')}/monthgrain-{uuid.uuid4().hex}"


def strip_affixes(tables: Sequence[str], prefix: str, suffix: str) -> list[str]:
    """Names between ``<prefix>_`` and ``suffix``; other tables are left out."""
    start = f"{prefix}_"
    return sorted(
        t.removeprefix(start).removesuffix(suffix)
        for t in tables
        if t.startswith(start) and t.endswith(suffix) and len(t) > len(start) + len(suffix)
    )


def discover_sources(
    spark: SparkSession, database: str, prefix: str, suffix: str = "_raw"
) -> list[str]:
    """Source names of the catalog tables ``<prefix>_<name><suffix>`` of a database."""
    return strip_affixes([t.name for t in spark.catalog.listTables(database)], prefix, suffix)


def merged_schema(
    known: T.StructType | None, new: T.StructType, by: Sequence[str], what: str
) -> T.StructType:
    """Columns of a table after a write: new ones behind the known ones, partitions last.

    A column keeps its type; another one for it is an error. Partition values are text.
    """
    fields = {f.name: f for f in (known.fields if known else ())}
    for field in new.fields:
        before = fields.setdefault(field.name, field)
        if field.name not in by and before.dataType != field.dataType:
            raise ValueError(
                f"{what}: column {field.name} is {before.dataType.simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    merged = [T.StructField(f.name, f.dataType) for n, f in fields.items() if n not in by]
    return T.StructType(merged + [T.StructField(n, T.StringType()) for n in by])


class Warehouse:
    """Layers of month-partitioned Parquet tables under one root folder.

    Months are replaced whole, so a repeated run leaves the same rows behind. Overwriting is
    always by partition, set on each write and never left to the session. Every write merges
    its columns into the table's ledger, so reads know them without opening a file.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return path_exists(self.spark, self.path(layer, table))

    def tables(self, layer: str) -> list[str]:
        """Table names of a layer."""
        return folders(self.spark, f"{self.root}/{layer}")

    def sources(self, layer: str, prefix: str, suffix: str = "_raw") -> list[str]:
        """Source names of the tables ``<prefix>_<name><suffix>`` of a layer."""
        return strip_affixes(self.tables(layer), prefix, suffix)

    def schema(self, layer: str, table: str) -> T.StructType | None:
        """Columns of a table as its writes have left them, the month among the last."""
        ledger = read_text(self.spark, f"{self.path(layer, table)}/{LEDGER}")
        return T.StructType.fromJson(json.loads(ledger)) if ledger else None

    def read(
        self,
        layer: str,
        table: str,
        months: Sequence[str] | None = None,
        schema: T.StructType | None = None,
        merge_schema: bool = False,
    ) -> DataFrame:
        """A table, or the stored ones of some months.

        With ``months``, no other folder is listed or opened. Columns are those of the ledger,
        null where a month has none; no file is opened to find them out. Tables that something
        else has written have no ledger: ``merge_schema`` looks into all files that are read,
        as do reads of tables without one. The month is text.
        """
        path = self.path(layer, table)
        reader = self.spark.read.option("basePath", path)
        schema = schema or (None if merge_schema else self.schema(layer, table))
        reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
        wanted = [path]
        if months is not None:
            wanted = [f"{path}/{MONTH}={m}" for m in self.stored_months(layer, table, months)]
            if not wanted:
                raise ValueError(f"{layer}/{table} has none of the months {', '.join(months)}")
        rows = reader.parquet(*wanted)
        if rows.schema[MONTH].dataType == T.StringType():
            return rows
        return rows.withColumn(MONTH, F.col(MONTH).cast("string"))

    def stored_months(
        self, layer: str, table: str, months: Sequence[str] | None = None
    ) -> list[str]:
        """The months that the table holds, or those of ``months``."""
        start = f"{MONTH}="
        listed = folders(self.spark, self.path(layer, table))
        stored = [f.removeprefix(start) for f in listed if f.startswith(start)]
        return stored if months is None else [m for m in months if m in stored]

    def replace_months(
        self, layer: str, table: str, df: DataFrame, by: Sequence[str] = (MONTH,)
    ) -> int:
        """Write ``df``, replacing the months it holds and leaving the others alone.

        Returns the number of rows, counted by the writing job itself.
        """
        merged = merged_schema(self.schema(layer, table), df.schema, by, f"{layer}/{table}")
        written = Observation()
        (
            df.observe(written, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(self.path(layer, table))
        )
        rows = written.get["rows"]
        if rows:
            write_text(self.spark, f"{self.path(layer, table)}/{LEDGER}", merged.json())
        return rows

    def upsert(
        self, layer: str, table: str, df: DataFrame, keys: Sequence[str], keep: bool = True
    ) -> int:
        """Merge rows into a table by key; returns the rows the touched months have then.

        The month must be among the keys, so that only the months of ``df`` are rewritten.
        Keys that are null or repeated are an error and nothing is written. With ``keep``
        the rows are computed once and kept, on disk where memory is short, for the key
        check and the write; a stored table that is only passed on is better read again.
        """
        if MONTH not in keys:
            raise ValueError(f"{MONTH} must be one of the keys")
        incoming = df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df
        try:
            months = []
            for month, broken in broken_keys(incoming, keys, MONTH).collect():
                if broken is not None:
                    raise ValueError(f"key of {table} is null or repeated: {broken.asDict()}")
                months.append(month)
            stored = self.stored_months(layer, table, months)
            merged = incoming
            if stored:
                merged = merge_by_key(self.read(layer, table, stored), incoming, keys)
            if len(months) > 1:
                # Few files per month: AQE merges small partitions and splits large ones.
                merged = merged.hint("rebalance", F.col(MONTH))
            return self.replace_months(layer, table, merged)
        finally:
            if keep:
                incoming.unpersist()

    def register(
        self,
        layer: str,
        table: str,
        database: str,
        name: str,
        comment: str,
        keys: Sequence[str] = (),
    ) -> str:
        """Make a stored table known to the catalog, or bring what it knows up to date.

        Columns that are new are added, the comment and the keys are replaced. Returns the
        table's full name.
        """
        full_name = f"{database}.{name}"
        fields = self.read(layer, table).schema.fields
        if self.spark.catalog.tableExists(full_name):
            evolve_table(self.spark, full_name, fields)
        else:
            create_table(self.spark, full_name, fields, (MONTH,), self.path(layer, table))
        describe_table(self.spark, full_name, comment, keys)
        self.spark.catalog.recoverPartitions(full_name)
        self.spark.catalog.refreshTable(full_name)
        return full_name
