"""Versions of the transformer dimension: every batch knows which one it used."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from feederlens.sources.storage import delete, is_complete, rename


def _fingerprint(cleaned: DataFrame) -> str:
    """Number of rows and a sum of hashes, whatever their order."""
    rows, total = cleaned.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64(*sorted(cleaned.columns)).cast("decimal(38,0)")), F.lit(0))
    ).first()
    return f"{rows}-{int(total) & ((1 << 64) - 1):016x}"


@dataclass(frozen=True)
class DimensionVersions:
    """Snapshots named by their content: an unchanged dimension is stored once, however often it is loaded."""

    root: str

    def path(self, version: str) -> str:
        return f"{self.root}/version={version}"

    def put(self, spark: SparkSession, cleaned: DataFrame) -> str:
        """Version of a cleaned dimension, which is written if it is new."""
        version = _fingerprint(cleaned)
        if is_complete(spark, self.path(version)):
            return version
        # The source may change between two reads of it: the name follows from what was written.
        made = f"{self.root}/_new-{uuid.uuid4().hex}"
        cleaned.write.parquet(made)
        version = _fingerprint(spark.read.schema(cleaned.schema).parquet(made))
        if not rename(spark, made, self.path(version)):
            delete(spark, made)
        return version

    def get(self, spark: SparkSession, version: str) -> DataFrame:
        return spark.read.parquet(self.path(version))
