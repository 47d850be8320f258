"""Written intermediate results, so that a lost executor costs no long recomputation."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths written in each open scope, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def folder(spark: SparkSession) -> str:
    """The folder all executors share, which ``spark.checkpoint.dir`` names."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage and gives later joins a measured size, by which Spark decides whether
    a side is small enough to broadcast. The files belong to the ``scope`` they were written
    in; outside of any, to the shared folder's owner, and may go once the result that reads
    them has been written.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    for owned in _SCOPES.get()[-1:]:
        owned.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, what was stored in it, also when it ends by an error.

    Nothing that reads those tables may be used afterwards: what has to stay is stored by
    ``kept`` before.
    """
    owned: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), owned))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in owned:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
            files.delete(place, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for a result that outlives the current scope: the one around it owns it."""
    token = _SCOPES.set(_SCOPES.get()[:-1])
    try:
        return stored(df, name)
    finally:
        _SCOPES.reset(token)
