"""Commits of a root: which batches are whole, and which folders hold each day of each table.

A batch writes its tables one by one; only a commit, a small file that appears whole or not at all, makes all of
them visible. Merging days is a commit too: it names folders that come and folders that go. Files of commits are
folded into a snapshot now and then, so readers open one snapshot and a bounded number of newer files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from feederlens.sources.storage import children, delete, read_text, write_text

#: Commits that may lie outside a snapshot before the next one is written.
FOLD_EVERY = 100

#: (table, batch folder, day)
Leaf = tuple[str, str, str]


def _runs(numbers: Iterable[int]) -> list[list[int]]:
    """Numbers as runs [first, last]."""
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


@dataclass
class View:
    """What readers see at one moment."""

    leaves: set[Leaf] = field(default_factory=set)
    runs: list[list[int]] = field(default_factory=list)
    names: set[str] = field(default_factory=set)

    def committed(self, batch: int) -> bool:
        return any(a <= batch <= b for a, b in self.runs)

    @property
    def last(self) -> int | None:
        return self.runs[-1][1] if self.runs else None

    def folders(self, table: str, days: Iterable[str] | None = None) -> list[str]:
        """Folders of a table, of all days or some, as <batch folder>/dt=<day>."""
        wanted = None if days is None else set(days)
        return sorted(f"{folder}/dt={day}" for name, folder, day in self.leaves if name == table and (wanted is None or day in wanted))

    def days(self) -> list[str]:
        return sorted({day for _, _, day in self.leaves})


@dataclass(frozen=True)
class Ledger:
    folder: str

    def exists(self, spark: SparkSession) -> bool:
        return any(n.endswith(".json") for n in children(spark, self.folder))

    def _read(self, spark: SparkSession, name: str) -> dict:
        return json.loads(read_text(spark, f"{self.folder}/{name}"))

    def view(self, spark: SparkSession) -> View:
        """All commits so far. A file that is folded away meanwhile is read from the snapshot it went into."""
        for tries in range(5):
            names = [n for n in children(spark, self.folder) if n.endswith(".json")]
            try:
                return self._fold(spark, names)
            except Py4JJavaError as gone:
                if "FileNotFoundException" not in str(gone.java_exception) or tries == 4:
                    raise
        raise AssertionError("not reached")

    def _fold(self, spark: SparkSession, names: list[str]) -> View:
        view, goes, batches = View(), set(), []
        if shots := [n for n in names if n.startswith("snapshot-")]:
            shot = self._read(spark, max(shots))
            view.leaves, view.runs, view.names = set(map(tuple, shot["leaves"])), shot["runs"], set(shot["names"])
        for name in sorted(n for n in names if not n.startswith("snapshot-") and n not in view.names):
            entry = self._read(spark, name)
            view.leaves |= set(map(tuple, entry["comes"]))
            goes |= set(map(tuple, entry["goes"]))
            batches += [entry["batch"]] if "batch" in entry else []
            view.names.add(name)
        # Folders have names of their own, so the order of commits doesn't matter.
        view.leaves -= goes
        view.runs = _runs({n for a, b in view.runs for n in range(a, b + 1)} | set(batches)) if batches else view.runs
        return view

    def commit(self, spark: SparkSession, batch: int, comes: Iterable[Leaf], info: dict | None = None) -> None:
        """The outputs of a batch become visible, all at once. A batch is committed once only."""
        entry = {"batch": batch, "comes": sorted(comes), "goes": [], "info": info or {}}
        write_text(spark, f"{self.folder}/batch-{batch:018d}.json", json.dumps(entry))

    def info(self, spark: SparkSession, batch: int) -> dict:
        """What a commit was given; empty once it is folded."""
        name = f"batch-{batch:018d}.json"
        return self._read(spark, name)["info"] if name in children(spark, self.folder) else {}

    def exchange(self, spark: SparkSession, comes: Iterable[Leaf], goes: Iterable[Leaf]) -> None:
        """Folders take the place of others, for all tables and days at once."""
        entry = {"comes": sorted(comes), "goes": sorted(goes)}
        write_text(spark, f"{self.folder}/merge-{uuid.uuid4().hex}.json", json.dumps(entry))

    def fold(self, spark: SparkSession, every: int = FOLD_EVERY) -> bool:
        """Writes a snapshot once so many commits are outside the last one, and deletes what it holds. One writer
        at a time folds: the job that commits batches."""
        names = [n for n in children(spark, self.folder) if n.endswith(".json")]
        shots = sorted(n for n in names if n.startswith("snapshot-"))
        if len(names) - len(shots) < every:
            return False
        view = self._fold(spark, names)
        number = int(shots[-1][9:-5]) + 1 if shots else 0
        there = sorted(n for n in names if n in view.names)
        shot = {"leaves": sorted(view.leaves), "runs": view.runs, "names": there}
        write_text(spark, f"{self.folder}/snapshot-{number:012d}.json", json.dumps(shot))
        for name in [*there, *shots]:
            delete(spark, f"{self.folder}/{name}")
        return True
