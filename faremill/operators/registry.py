"""Model versions and aliases in two small Parquet tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import exists
from .models import FittedModel, load_model

ALIASES = ("staging", "production", "archived")
_VERSIONS = (
    "model_name string, version int, run_id string, model_type string, path string, run_date date,"
    " metrics map<string,double>, registered_at timestamp"
)
_ALIAS_LOG = "model_name string, alias string, version int, set_at timestamp"


class ModelRegistry:
    """Versions are append-only; an alias points at the version it was last set to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, name: str, ddl: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if exists(self.spark, path):
            return self.spark.read.schema(ddl).parquet(path)
        return self.spark.createDataFrame([], ddl)

    def versions(self) -> DataFrame:
        return self._read("versions", _VERSIONS)

    def aliases(self) -> DataFrame:
        log = self._read("aliases", _ALIAS_LOG)
        return log.groupBy("model_name", "alias").agg(F.max_by("version", "set_at").alias("version"))

    def register(self, name: str, model: FittedModel, run_date, metrics: dict[str, float], alias: str = "staging") -> int:
        """Save the model, record a new version and point ``alias`` at it."""
        last = self.versions().filter(F.col("model_name") == name).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
        path = f"{self.root}/models/{name}/v{version}"
        model.save(path)
        now = datetime.now(timezone.utc)
        run_id = f"{name}-{run_date}-v{version}"
        row = [(name, version, run_id, model.model_type, path, run_date, {k: float(v) for k, v in metrics.items()}, now)]
        self.spark.createDataFrame(row, _VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.root}/versions")
        self.set_alias(name, alias, version)
        return version

    def set_alias(self, name: str, alias: str, version: int) -> None:
        alias = alias.strip().lower()
        if alias not in ALIASES:
            raise ValueError(f"unsupported alias {alias!r}")
        row = [(name, alias, version, datetime.now(timezone.utc))]
        self.spark.createDataFrame(row, _ALIAS_LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/aliases")

    def resolve(self, name: str, alias: str = "production"):
        """Version row behind an alias; scoring must not start without one."""
        pointer = self.aliases().filter((F.col("model_name") == name) & (F.col("alias") == alias))
        row = self.versions().join(pointer.select("model_name", "version"), ["model_name", "version"]).first()
        if row is None:
            raise RuntimeError(f"model {name!r} has no {alias} version")
        return row

    def load(self, name: str, alias: str = "production") -> tuple[FittedModel, int]:
        row = self.resolve(name, alias)
        return load_model(row.path, row.model_type), row.version
