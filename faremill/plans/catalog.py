"""Registered queries: each runs one operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import round_half_up
from ..operators import gold, silver
from ..session import configure
from . import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every engine prints alike: text dates, bigint, double."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.typed_from_columns(inputs.raw_trips(spark, sf_dir))


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build_silver(typed(spark, sf_dir))


def hourly_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_hourly(silver_of(spark, sf_dir), inputs.zones(spark, sf_dir))


def daily_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_daily(hourly_of(spark, sf_dir))



def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Cut floating-point noise that depends on the order of a sum."""
    return df.withColumns({c: round_half_up(c, digits) for c in columns})


# SQL text of timestamps and dates as printed by ``plain``.
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
DT = "strftime({0}, '%Y-%m-%d') AS {0}"
