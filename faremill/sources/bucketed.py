"""Tables laid out by their merge key: a merge never shuffles the rows that are already there.

A table is partitioned by a text month and, within a month, cut into a fixed number of buckets by a hash of the merge
key, each file sorted by it. Only the change set is shuffled, to the table's buckets; the anti join then runs bucket
by bucket, and the rewritten months keep the layout.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import materialise
from .tables import exists, touched_values

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _whole_partitions(spark: SparkSession):
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE, before)


@dataclass(frozen=True)
class BucketedTable:
    """A table of the session's catalog over files at ``path``; ``buckets`` should be near the tasks of a merge."""

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...]
    partition_by: str
    buckets: int

    def register(self, schema: T.StructType) -> None:
        """Make the table known, with the partitions that already lie at its path."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._ordered(schema))
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet PARTITIONED BY (`{self.partition_by}`)"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        if exists(self.spark, self.path):
            self.spark.catalog.recoverPartitions(self.name)

    def _ordered(self, schema: T.StructType) -> list[T.StructField]:
        last = [f for f in schema.fields if f.name == self.partition_by]
        if len(last) != 1:
            raise ValueError(f"no column {self.partition_by}")
        return [f for f in schema.fields if f.name != self.partition_by] + last

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def replace(self, df: DataFrame) -> None:
        """Make the months in ``df`` hold exactly its rows."""
        self._write(df.repartition(self.buckets, *self.keys))

    def _write(self, df: DataFrame) -> None:
        with _whole_partitions(self.spark):
            df.select(*self.read().columns).write.mode("overwrite").insertInto(self.name)

    def untouched(self, change: DataFrame, months: Sequence[str]) -> DataFrame:
        """Rows of some months whose key is not in ``change``; a NULL key is in no change set."""
        old = self.read().where(self.read()[self.partition_by].isin(list(months)))
        own = change.select(*self.keys).distinct().repartition(self.buckets, *self.keys)
        return old.join(own.hint("merge"), list(self.keys), "left_anti")

    def upsert(self, new: DataFrame) -> list[str]:
        """Merge ``new`` by key, rewriting only the months it touches; returns them.

        A key must determine its month. Each bucket of a month is read, merged and written by one task.
        """
        change = materialise(new.select(*self.read().columns), "upsert")
        months = touched_values(change, self.partition_by)
        if months:
            rows = self.untouched(change, months).select(*change.columns)
            self._write(rows.unionByName(change.repartition(self.buckets, *self.keys)))
        return months
