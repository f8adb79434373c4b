import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kbvec.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def vectors(spark):
    """A small table: three sources, two tenants, one row without a URL."""
    from kbvec.schema import conform, vector_schema
    from pyspark.sql import functions as F

    rows = [
        ("a1", "default", [1.0, 0.0, 0.0], "alpha beta", "u/a", "public", "post", 0, 2, True),
        ("a2", "default", [0.9, 0.1, 0.0], "alpha", "u/a", "public", "post", 1, 2, True),
        ("b", "default", [0.8, 0.2, 0.0], "gamma beta", "u/b", "subscriber", "page", None, None, False),
        ("c", "default", [0.0, 1.0, 0.0], "delta", "", "public", "product", None, None, False),
        ("d", "default", [0.0, 0.9, 0.1], "delta delta", "", "public", "product", None, None, False),
        ("z", "default", [0.0, 0.0, 0.0], "nothing", "u/z", "public", "post", None, None, False),
        ("x", "other", [1.0, 0.0, 0.0], "alpha", "u/a", "public", "post", None, None, False),
    ]
    names = [f.name for f in vector_schema().fields][:10]
    kinds = ("string, string, array<double>, string, string, string, string, int, int, boolean").split(", ")
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return conform(df, now=F.expr("timestamp_ntz'2024-01-01 00:00:00'"))
