"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sql import with_views
from checks.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places, dates and times as text, so that two engines give equal values."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of ``Views`` under a name, with SQL over the tables and named views."""

    def wrap(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(Views(spark, folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, *views.split())
        return build

    return wrap
