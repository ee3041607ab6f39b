"""Registry: query name -> (function of session and folder, equivalent SQL or nothing)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import load_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return load_table(spark, f"{folder}/{name}.parquet")


# The tables carry no coordinates; these place a key on the map by integer arithmetic.
def latitude(key: Column) -> Column:
    """Spread over 25 to 50 degrees north."""
    return 25.0 + F.pmod(key * 7919, F.lit(10007)) / 400.0


def longitude(key: Column) -> Column:
    """Spread over 120 to 70 degrees west."""
    return -120.0 + F.pmod(key * 104729, F.lit(20011)) / 400.0


LATITUDE_SQL = "(25e0 + (({k}) * 7919 % 10007) / 400e0)"
LONGITUDE_SQL = "(-120e0 + (({k}) * 104729 % 20011) / 400e0)"

MILES_SQL = (
    "(2 * 3958.7613e0 * asin(sqrt(least(1e0, "
    "pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
    "pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
)


def miles_sql(a: str, b: str) -> str:
    """Distance between points with columns lat and lon of two aliases."""
    return MILES_SQL.format(lat1=f"{a}.lat", lon1=f"{a}.lon", lat2=f"{b}.lat", lon2=f"{b}.lon")
