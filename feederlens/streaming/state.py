"""Latest status of every measuring point between micro-batches.

Each batch writes only the points it touched (a delta); now and then all points are written anew (a
base). The state before a batch is the newest base before it plus the deltas after that base, so a
repeated batch sees what it saw the first time, and reading never costs more than one base and a
bounded number of deltas.

A base lies in folders by hash bucket of the point. A batch reads only the buckets of the points that it
touches, and of those and of the deltas only rows of such points reach the aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feederlens.operators.latest import latest
from feederlens.schema import STATUS_COLUMNS, STATUS_SCHEMA
from feederlens.sources.ledger import Ledger, View
from feederlens.sources.storage import children, delete, is_complete

_BUCKETED = T.StructType([*STATUS_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash("mp_id"), F.lit(buckets))


@dataclass(frozen=True)
class StateStore:
    """With a ledger only committed batches count. The number of buckets is kept with each base, so it may
    change at any time."""

    root: str
    base_every: int = 50
    buckets: int = 64
    ledger: Ledger | None = None

    def _view(self, spark: SparkSession) -> View | None:
        return self.ledger.view(spark) if self.ledger is not None and self.ledger.exists(spark) else None

    def _batches(self, spark: SparkSession, kind: str, view: View | None, own: int | None) -> list[int]:
        """Whole batches that are committed, or are ``own``."""
        folder = f"{self.root}/{kind}"
        numbers = [int(n.split("=")[1]) for n in children(spark, folder) if n.startswith("batch=")]
        return sorted(
            n for n in numbers
            if (view is None or n == own or view.committed(n)) and self._layout(spark, f"{folder}/batch={n}") is not None
        )

    def _layout(self, spark: SparkSession, path: str) -> tuple[str, int] | None:
        """Folder of the rows, and how many buckets they are in (0: none); None if it was not written to its end."""
        for name in (n for n in children(spark, path) if n.startswith("of=")):
            return (f"{path}/{name}", int(name[3:])) if is_complete(spark, f"{path}/{name}") else None
        return (path, 0) if is_complete(spark, path) else None

    def before(
        self, spark: SparkSession, batch: int, touched: DataFrame | None = None, own: int | None = None
    ) -> DataFrame | None:
        """State that the batches before this one left, of all points or of those touched (mp_id); None when
        there is none. ``own`` is a batch that counts before it is committed."""
        view = self._view(spark)
        base = max((b for b in self._batches(spark, "base", view, own) if b < batch), default=None)
        deltas = [
            f"{self.root}/delta/batch={n}" for n in self._batches(spark, "delta", view, own)
            if n < batch and (base is None or n > base)
        ]
        if base is None and not deltas:
            return None
        keys = None if touched is None else touched.select("mp_id").distinct()
        parts = [spark.read.schema(STATUS_SCHEMA).parquet(*deltas)] if deltas else []
        if base is not None:
            path, buckets = self._layout(spark, f"{self.root}/base/batch={base}")
            rows = spark.read.schema(_BUCKETED if buckets else STATUS_SCHEMA).parquet(path)
            if buckets and keys is not None:
                # As many numbers as there are buckets, at most.
                wanted = [r[0] for r in keys.select(_bucket(buckets)).distinct().collect()]
                rows = rows.where(F.col("bucket").isin(wanted))
            parts.append(rows.select(*STATUS_COLUMNS))
        found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if keys is not None:
            found = found.join(keys, "mp_id", "left_semi")
        return latest(found) if deltas else found

    def save(self, spark: SparkSession, batch: int, rows: DataFrame) -> None:
        """Keeps the newest of the given status rows per point as the delta of a batch."""
        newest = latest(rows.select(*STATUS_COLUMNS))
        newest.write.mode("overwrite").parquet(f"{self.root}/delta/batch={batch}")
        base = max((b for b in self._batches(spark, "base", self._view(spark), None) if b < batch), default=None)
        if batch - (base if base is not None else -1) >= self.base_every:
            path = f"{self.root}/base/batch={batch}"
            delete(spark, path)  # of an attempt with another number of buckets
            (
                self.before(spark, batch + 1, own=batch).withColumn("bucket", _bucket(self.buckets))
                .hint("rebalance", "bucket").sortWithinPartitions("bucket", "mp_id")
                .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/of={self.buckets}")
            )
            self._drop_before(spark, base)

    def _drop_before(self, spark: SparkSession, base: int | None) -> None:
        """Removes what is older than the base before the newest one; that one stays, as the last
        batch may be repeated."""
        if base is None:
            return
        for kind, last in (("base", base - 1), ("delta", base)):
            for n in self._batches(spark, kind, None, None):
                if n <= last:
                    delete(spark, f"{self.root}/{kind}/batch={n}")
