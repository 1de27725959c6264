"""A watched folder as a stream to a topic: a file is sent once it is whole, and again when it was changed.

Nobody says when a file is written to its end, so a file is admitted when it is not empty and two polls in a row
find the same size and time. Admissions are written to a log folder, and the log is what the stream reads: its
checkpoint knows which admissions have been sent, and a restart loses none."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feederlens.sources import files, kafka
from feederlens.sources.storage import children, delete, exists, listing, read_text, write_text

#: (bytes, time of the last change)
Mark = tuple[int, int]


@dataclass
class Admission:
    """Which files of a folder are whole, from one poll to the next."""

    sent: dict[str, Mark] = field(default_factory=dict)
    seen: dict[str, Mark] = field(default_factory=dict)

    def poll(self, found: dict[str, Mark]) -> list[str]:
        """Files that are not empty, are as they were at the poll before, and were not admitted like this."""
        whole = sorted(p for p, m in found.items() if m[0] and self.seen.get(p) == m and self.sent.get(p) != m)
        self.seen = dict(found)
        self.sent = {p: m for p, m in self.sent.items() if p in found} | {p: found[p] for p in whole}
        return whole


@dataclass
class FolderFeed:
    """Sends the lines of a folder's files to ``sink`` (lines with value, file and line; batch number). A batch
    that failed is sent again, so lines arrive at least once."""

    folder: str
    root: str
    sink: Callable[[DataFrame, int], None]
    admission: Admission | None = None

    @property
    def log(self) -> str:
        return f"{self.root}/admitted"

    def admit(self, spark: SparkSession) -> list[str]:
        """One poll; what is admitted goes to the log as one file."""
        names = [n for n in children(spark, self.log) if n.startswith("poll-")]
        if self.admission is None:
            entries = [json.loads(x) for n in names for x in read_text(spark, f"{self.log}/{n}").splitlines()]
            self.admission = Admission({e["path"]: (e["bytes"], e["changed"]) for e in entries})
        found = listing(spark, self.folder)
        whole = self.admission.poll(found)
        if whole:
            number = max((int(n[5:17]) for n in names), default=-1) + 1
            texts = [json.dumps({"path": p, "bytes": found[p][0], "changed": found[p][1]}) for p in whole]
            write_text(spark, f"{self.log}/poll-{number:012d}", "\n".join(texts) + "\n")
        return whole

    def _send(self, entries: DataFrame, batch: int) -> None:
        # As many paths as files were admitted, never lines.
        paths = sorted({json.loads(r["value"])["path"] for r in entries.select("value").collect()})
        spark = entries.sparkSession
        there = [p for p in paths if exists(spark, p)]
        if there:
            self.sink(files.numbered_lines(spark, there), batch)

    def start(self, spark: SparkSession, interval: str | None = "10 seconds", name: str = "feed") -> StreamingQuery:
        """The stream from the log to the sink. Without an interval it handles what is admitted and ends."""
        if not children(spark, self.log):
            write_text(spark, f"{self.log}/_log", "")
        writer = (
            spark.readStream.text(self.log).writeStream.queryName(name)
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}").foreachBatch(self._send)
        )
        return (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)).start()

    def run(self, spark: SparkSession, marker: str, poll_seconds: float = 10) -> None:
        """Polls the folder and sends what is whole, until the marker exists."""
        query = self.start(spark, f"{max(1, round(poll_seconds))} seconds")
        try:
            while not exists(spark, marker):
                self.admit(spark)
                if query.awaitTermination(poll_seconds):
                    return
            query.processAllAvailable()
        finally:
            query.stop()
        delete(spark, marker)


def to_topic(brokers: str, topic: str) -> Callable[[DataFrame, int], None]:
    return lambda lines, batch: kafka.feed_topic(lines, brokers, topic)
