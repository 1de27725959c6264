"""Result tables, partitioned by the batch that wrote them and by day (``dt``, yyyyMMdd).

A batch is replaced as a whole: writing it again leaves nothing of what it wrote before, days that
have no rows any more included. Once a root has commits, readers see only committed batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from feederlens.functions.times import day_text
from feederlens.operators.episodes import apply_marks
from feederlens.schema import (
    EPISODE_COLUMNS, MARK_COLUMNS, PRIMARY_COLUMNS, SECONDARY_COLUMNS, STATUS_COLUMNS, table_schema,
)
from feederlens.settings import Limits
from feederlens.sources.ledger import Leaf, Ledger, View
from feederlens.sources.storage import age_seconds, children, delete, exists, is_complete

# Table name -> (columns, column that gives the day).
TABLES = {
    "secondary": (SECONDARY_COLUMNS, "time"),
    "primary": (PRIMARY_COLUMNS, "time"),
    "status": (STATUS_COLUMNS, "time"),
    "episodes": (EPISODE_COLUMNS, "ts"),
    "marks": (MARK_COLUMNS, "start"),
}


@dataclass(frozen=True)
class DayTables:
    root: str
    limits: Limits = field(default_factory=Limits)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self, spark: SparkSession, database: str) -> None:
        """Catalog entries for all tables, where they do not exist yet."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, (columns, _) in TABLES.items():
            fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(columns))
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {database}.{name} "
                f"({fields}, batch bigint, dt string) USING parquet "
                f"PARTITIONED BY (batch, dt) LOCATION '{self.path(name)}'"
            )

    @property
    def ledger(self) -> Ledger:
        return Ledger(f"{self.root}/_commits")

    def register(self, spark: SparkSession, database: str) -> None:
        """Makes what was committed since the last time visible in the catalog tables, and takes out what was
        replaced. Under a root without commits everything written counts."""
        if not self.ledger.exists(spark):
            for name in filter(lambda n: exists(spark, self.path(n)), TABLES):
                spark.sql(f"MSCK REPAIR TABLE {database}.{name} SYNC PARTITIONS")
            return
        view = self.ledger.view(spark)
        for name in TABLES:
            known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {database}.{name}").collect()}
            wanted = set(view.folders(name))
            for verb, some in (("ADD IF NOT EXISTS", wanted - known), ("DROP IF EXISTS", known - wanted)):
                specs = [_spec(x) for x in sorted(some)]
                for at in range(0, len(specs), 500):
                    between = " " if verb.startswith("ADD") else ", "
                    spark.sql(f"ALTER TABLE {database}.{name} {verb} {between.join(specs[at : at + 500])}")

    def _days(self, spark: SparkSession, name: str, folder: str) -> list[Leaf]:
        return [(name, folder, d[3:]) for d in children(spark, f"{self.path(name)}/{folder}") if d.startswith("dt=")]

    def is_committed(self, spark: SparkSession, batch: int) -> bool:
        return self.ledger.view(spark).committed(batch)

    def commit(self, spark: SparkSession, batch: int, info: dict | None = None) -> None:
        """All that a batch wrote becomes visible at once. Whole batches of a root that had no commits so far are
        taken over first."""
        if not self.ledger.exists(spark):
            for n in self._unlogged(spark) - {batch}:
                self.ledger.commit(spark, n, [x for t in TABLES for x in self._days(spark, t, f"batch={n}")])
        self.ledger.commit(spark, batch, [x for t in TABLES for x in self._days(spark, t, f"batch={batch}")], info)
        self.ledger.fold(spark)

    def _unlogged(self, spark: SparkSession) -> set[int]:
        found = {int(f[6:]) for t in TABLES for f in children(spark, self.path(t)) if f.startswith("batch=")}
        return {n for n in found if all(
            is_complete(spark, f"{self.path(t)}/batch={n}") for t in TABLES if exists(spark, f"{self.path(t)}/batch={n}")
        )}

    def write(self, name: str, rows: DataFrame, batch: int) -> None:
        self._write(name, rows, f"batch={batch}")

    def _write(self, name: str, rows: DataFrame, folder: str) -> None:
        columns, day = TABLES[name]
        (
            rows.select(*columns, day_text(F.col(day)).alias("dt"))
            # Even file sizes per day: AQE splits big days and merges small ones. Sorting makes the
            # row groups selective for a measuring point.
            .hint("rebalance", "dt")
            .sortWithinPartitions("dt", "mp_id", day)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("dt")
            .parquet(f"{self.path(name)}/{folder}")
        )

    def closed_days(self, spark: SparkSession, open_days: int = 2) -> list[str]:
        """Days that more than one folder holds, but for the newest ones, to which batches still add."""
        view = self.ledger.view(spark)
        days = [d for d in view.days() if d.isdigit()]
        return [d for d in days[: len(days) - open_days] if any(len(view.folders(t, [d])) > 1 for t in TABLES)]

    def merge_days(self, spark: SparkSession, days: Sequence[str] | None = None) -> list[str]:
        """The folders of each day become one per table, with the marks applied to its status rows; readers see
        either the old ones or the new ones, in all tables. Marks stay, since later rows may need them, and rows
        that come for a merged day later form a folder of their own until it is merged again."""
        view = self.ledger.view(spark)
        wanted = [d for d in (self.closed_days(spark) if days is None else days) if d in view.days()]
        if not wanted:
            return []
        folder = f"batch=-{uuid.uuid4().int >> 66}"
        goes = {leaf for leaf in view.leaves if leaf[2] in wanted}
        for name in TABLES:
            if any(leaf[0] == name for leaf in goes):
                rows = self._status(spark, view, wanted) if name == "status" else self._rows(spark, view, name, wanted)
                self._write(name, rows, folder)
        comes = [x for t in TABLES for x in self._days(spark, t, folder)]
        self.ledger.exchange(spark, comes, goes)
        return wanted

    def clean(self, spark: SparkSession, older_than_hours: float = 24) -> list[str]:
        """Deletes folders that no reader sees: replaced ones and those of failed attempts. The age protects
        readers that began before and the batch that is being written."""
        gone, view = [], self.ledger.view(spark)
        for name in TABLES:
            seen = set(view.folders(name))
            for folder in (f for f in children(spark, self.path(name)) if f.startswith("batch=")):
                for _, _, day in self._days(spark, name, folder):
                    path = f"{self.path(name)}/{folder}/dt={day}"
                    if f"{folder}/dt={day}" not in seen and age_seconds(spark, path) >= older_than_hours * 3600:
                        delete(spark, path)
                        gone.append(path)
        return gone

    def read(
        self, spark: SparkSession, name: str, days: Sequence[str] | None = None, batch: int | None = None
    ) -> DataFrame:
        """The committed rows of a table, or only some days of it. With ``batch`` the rows of that batch,
        whether it is committed or not."""
        columns, _ = TABLES[name]
        if batch is None and self.ledger.exists(spark):
            return self._rows(spark, self.ledger.view(spark), name, days)
        schema = T.StructType(
            table_schema(columns).fields
            + [T.StructField("batch", T.LongType()), T.StructField("dt", T.StringType())]
        )
        path = self.path(name)
        found = f"{path}/batch={batch}" if batch is not None else path
        rows = spark.read.schema(schema).option("basePath", path).parquet(found)
        if days is not None:
            rows = rows.where(F.col("dt").isin(list(days)))
        return rows.select(*columns)

    def _rows(self, spark: SparkSession, view: View, name: str, days: Sequence[str] | None) -> DataFrame:
        """The days' folders by name: no other folder is listed."""
        schema = table_schema(TABLES[name][0])
        paths = [f"{self.path(name)}/{leaf}" for leaf in view.folders(name, days)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def read_status(self, spark: SparkSession, days: Sequence[str] | None = None) -> DataFrame:
        """Status rows with the confirmations of later batches applied.

        A confirmation comes at most gap plus confirmation time after the row it changes, so it
        can start on the day before; its start is never after the row.
        """
        if self.ledger.exists(spark):
            return self._status(spark, self.ledger.view(spark), days)
        marks = self.read(spark, "marks", _with_days_before(days))
        return apply_marks(self.read(spark, "status", days), marks, self.limits)

    def _status(self, spark: SparkSession, view: View, days: Sequence[str] | None) -> DataFrame:
        marks = self._rows(spark, view, "marks", _with_days_before(days))
        return apply_marks(self._rows(spark, view, "status", days), marks, self.limits)


def _with_days_before(days: Sequence[str] | None) -> list[str] | None:
    if days is None:
        return None
    before = [(datetime.strptime(d, "%Y%m%d") - timedelta(days=1)).strftime("%Y%m%d") for d in days]
    return sorted({*days, *before})


def _spec(leaf: str) -> str:
    """<batch folder>/dt=<day> as the partition of a catalog table."""
    folder, day = leaf.split("/dt=")
    return f"PARTITION (batch={folder[6:]}, dt='{day}')"
