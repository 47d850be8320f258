"""Monthly delimited files as all-text DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthgrain.operators.snapshots import stamp_snapshot
from monthgrain.sources.files import path_exists
from monthgrain.sources.manifest import Source


class MissingFile(FileNotFoundError):
    """The month's file of a source has not arrived."""


def read_delimited(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Read a file with a header line; all columns are text, empty fields are null."""
    if not path_exists(spark, path):
        raise MissingFile(path)
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_source(spark: SparkSession, landing: str, source: Source, snapshot: str) -> DataFrame:
    """``<landing>/<yyyyMM>/<file>`` of a source, stamped with its month."""
    path = f"{landing}/{snapshot}/{source.file_name(snapshot)}"
    return stamp_snapshot(read_delimited(spark, path, source.sep), snapshot)
