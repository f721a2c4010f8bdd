"""Small dimension files with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import ZONE_SCHEMA


def read_seed(spark: SparkSession, path: str, schema: T.StructType = ZONE_SCHEMA) -> DataFrame:
    """Header CSV with declared types; a malformed line aborts the load.

    Labels such as ``N/A`` are data, so no text is turned into NULL. The header is
    checked against the declared columns.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
