import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidepost.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="warehouse-"),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def column(spark):
    """Values of an expression over a one-column string frame named ``x``."""

    def values(texts, expression):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r[1] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]

    return values


def plan_of(df) -> str:
    """Physical plan after execution, without the initial one that adaptive execution keeps."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)
