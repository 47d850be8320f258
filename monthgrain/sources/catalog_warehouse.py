"""The layers of a warehouse as databases of the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.functions.text import named, ref, text
from monthgrain.months import MONTH
from monthgrain.operators.history import KEY
from monthgrain.sources import catalog
from monthgrain.sources.files import file_system, folders
from monthgrain.sources.warehouse import CLEAN, STATE, Warehouse, merged_schema


class CatalogWarehouse(Warehouse):
    """Layers as databases ``<prefix>_<layer>``, with the data under one root folder.

    A month is replaced by switching its partition in the catalog, see ``catalog``. With
    ``buckets``, clean tables and states that have a customer id are dealt into that many buckets of it
    and sorted, at the price of one shuffle when they are written: the join of a customer's
    months, and everything grouped by customer, then needs none. What is switched stays as
    long as the catalog lasts, so a run over several sessions needs a catalog that does.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str, buckets: int = 0):
        super().__init__(spark, root)
        self.prefix, self.buckets = prefix, buckets

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def tables(self, layer: str) -> list[str]:
        if not self.spark.catalog.databaseExists(self.database(layer)):
            return []
        listed = self.spark.catalog.listTables(self.database(layer))
        return sorted(t.name for t in listed if "__" not in t.name and not t.isTemporary)

    def schema(self, layer: str, table: str) -> T.StructType | None:
        if not self.exists(layer, table):
            return None
        return self.spark.table(self.name(layer, table)).schema

    def stored_months(
        self, layer: str, table: str, months: Sequence[str] | None = None
    ) -> list[str]:
        if not self.exists(layer, table):
            return []
        listed = catalog.partitions(self.spark, self.name(layer, table))
        stored = sorted({p.split("/")[0].split("=", 1)[1] for p in listed})
        return stored if months is None else [m for m in months if m in stored]

    def read(
        self,
        layer: str,
        table: str,
        months: Sequence[str] | None = None,
        schema: T.StructType | None = None,
        merge_schema: bool = False,
    ) -> DataFrame:
        """A table by its catalog entry; the month filter picks the partitions to list."""
        if schema is not None or merge_schema:
            raise ValueError("columns of a catalog table are those of the catalog")
        rows = self.spark.table(self.name(layer, table))
        if months is None:
            return rows
        stored = self.stored_months(layer, table, months)
        if not stored:
            raise ValueError(f"{layer}/{table} has none of the months {', '.join(months)}")
        return rows.where(F.col(MONTH).isin(stored))

    def replace_months(
        self, layer: str, table: str, df: DataFrame, by: Sequence[str] = (MONTH,)
    ) -> int:
        """Write ``df`` beside the months it holds, then switch those; others are left alone."""
        name = self.name(layer, table)
        known = self.schema(layer, table)
        merged = merged_schema(known, df.schema, by, name)
        key = KEY if layer in (CLEAN, STATE) and KEY in merged.names else None
        buckets = self.buckets if key and tuple(by) == (MONTH,) else 0
        if known is None:
            database = self.database(layer)
            place = text(f"{self.root}/{layer}")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {place}")
            path = self.path(layer, table)
            catalog.create_table(self.spark, name, merged.fields, by, path, key, buckets)
        else:
            catalog.evolve_table(self.spark, name, merged.fields)
        staging = catalog.staging_name(name)
        folder = f"{self.path(layer, table)}/{staging.split('__')[-1]}"
        catalog.create_table(self.spark, staging, merged.fields, by, folder, key, buckets)
        try:
            rows = self._write(df, staging, merged, key, buckets)
            new = catalog.partitions(self.spark, staging)
        finally:
            self.spark.sql(f"DROP TABLE {staging}")  # the files stay
        self._switch(name, folder, new)
        return rows

    def _write(
        self, df: DataFrame, staging: str, columns: T.StructType, key: str | None, buckets: int
    ) -> int:
        written = Observation()
        rows = df.observe(written, F.count(F.lit(1)).alias("rows")).selectExpr(
            *[
                named(f"CAST({ref(f.name) if f.name in df.columns else 'NULL'} AS "
                      f"{f.dataType.simpleString()})", f.name)
                for f in columns.fields
            ]
        )
        if buckets:
            rows = rows.repartition(buckets, F.col(key))  # as buckets are, so one file each
        rows.write.insertInto(staging)
        return written.get["rows"]

    def _switch(self, name: str, folder: str, new: Sequence[str]) -> None:
        catalog.switch_partitions(self.spark, name, folder, new)

    def register(
        self,
        layer: str,
        table: str,
        database: str,
        name: str,
        comment: str,
        keys: Sequence[str] = (),
    ) -> str:
        """Replace comment and keys of the table, which the catalog knows already."""
        if f"{database}.{name}" != self.name(layer, table):
            raise ValueError(f"{layer}/{table} is {self.name(layer, table)} in the catalog")
        catalog.describe_table(self.spark, self.name(layer, table), comment, keys)
        return self.name(layer, table)

    def drop_replaced(self, layer: str, table: str) -> list[str]:
        """Delete folders that no partition lies in any more; returns their names.

        For times when nothing reads or writes the table: a reader that has begun before the
        switch still opens the old files.
        """
        name, path = self.name(layer, table), self.path(layer, table)
        used = set()
        for partition in catalog.partitions(self.spark, name):
            told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({catalog.partition_spec(partition)})")
            place = told.where("col_name = 'Location'").first()["data_type"]
            used.add(place.removesuffix(f"/{partition}").rsplit("/", 1)[-1])
        gone = [f for f in folders(self.spark, path) if f not in used]
        for folder in gone:
            fs, place = file_system(self.spark, f"{path}/{folder}")
            fs.delete(place, True)
        return gone
