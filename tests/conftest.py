import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    os.environ["PYSPARK_SUBMIT_ARGS"] = f"--conf spark.checkpoint.dir={shared} pyspark-shell"
    spark = session("monthgrain-tests")
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def evaluate(spark):
    """Value of one SQL expression over named values (``None`` is a null double)."""

    def run(expression, **values):
        def literal(v):
            if v is None:
                return "double(NULL)"
            if isinstance(v, str):
                return f"'{v}'"
            return repr(v) + "D" if isinstance(v, float) else repr(v)

        given = ", ".join(f"{literal(v)} AS {n}" for n, v in values.items())
        source = f"(SELECT {given})" if given else "(SELECT 1)"
        return spark.sql(f"SELECT {expression} AS out FROM {source}").first()["out"]

    return run


def rows(df, *columns):
    """Sorted tuples of some columns, or of all."""
    picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
