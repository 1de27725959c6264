"""The stream against the same lines in one batch, and its pieces."""

import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from feederlens.plans import jobs
from feederlens.sources import files
from feederlens.schema import table_schema
from feederlens.sources.daytables import TABLES, DayTables
from feederlens.streaming.interval import trigger_interval
from feederlens.streaming.job import LoadJob, batch_durations
from feederlens.streaming.stopping import run_until_marker
from helpers import at, table, to_dt
from test_detection import many

DIMENSION = [(k, "1", 1.0) for k in range(40)]


def new_folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def line(key, t, rate):
    """A reading whose load rate at ratio 1 and capacity 1 is the given one."""
    stamp = to_dt(t).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
    return "||".join([str(key), stamp, str(rate), *["x"] * 3, "0", *["x"] * 11])


def dimension(spark):
    return spark.createDataFrame(DIMENSION, "mp_id bigint, bl string, capacity double")


def lines_of(by_key):
    """Lines in time order; unusable rates become text that is no number."""
    rows = sorted((t, k, r) for k, s in by_key.items() for t, r in s)
    return [line(k, t, "bad" if r == 9999.99 else r) for t, k, r in rows]


def write_parts(lines, cuts):
    folder = new_folder()
    edges = [0, *cuts, len(lines)]
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        with open(f"{folder}/part{n:03}.txt", "w") as f:
            f.write("\n".join(lines[a:b]) + "\n")
        time.sleep(0.02)  # files are taken in the order of their times
    return folder


def small():
    """Half a day of eight points, so that one 24-hour window holds everything."""
    end = at("23:00")
    return {k: [(t, r) for t, r in s if t < end] for k, s in many(41, keys=8, n=60).items()}


def test_stream_equals_batch(spark):
    lines = lines_of(small())
    rng = random.Random(5)
    folder = write_parts(lines, sorted(rng.sample(range(1, len(lines)), 3)))
    root = new_folder()
    job = LoadJob(root, dimension, as_of="2024-03-06 00:00:00", state_base_every=2)
    query = job.start(files.watch_lines(spark, folder, 1), interval=None, checkpoint=f"{root}/cp")
    query.awaitTermination()
    assert sum(job.counts.values()) == len(lines) and len(job.counts) == 4
    assert len(batch_durations(query)) >= 4

    whole = new_folder()
    latest = jobs.analyse(
        files.read_lines(spark, folder), dimension(spark), whole, work_folder=whole
    )
    stream, batch = DayTables(f"{root}/tables"), DayTables(whole)
    for name in ("secondary", "primary", "episodes", "marks"):
        assert table(stream.read(spark, name)) == table(batch.read(spark, name)), name
    assert table(stream.read_status(spark)) == table(batch.read(spark, "status"))
    assert table(job.state.before(spark, 99)) == table(latest)

    # A repeated batch, as after a crash, changes nothing.
    before = table(stream.read(spark, "status"))
    last = files.read_lines(spark, f"{folder}/part003.txt")
    job.process(last, 3)
    assert table(stream.read(spark, "status")) == before
    assert table(job.state.before(spark, 99)) == table(latest)


def test_late_rows_are_kept_and_flagged(spark):
    root = new_folder()
    job = LoadJob(root, dimension, as_of="2024-03-05 12:00:00")
    frames = [
        [line(1, at("10:00"), 0.7)],
        [line(1, at("09:30"), 0.9), line(1, at("09:45"), 0.9), line(1, at("10:15"), 0.9)],
    ]
    for n, texts in enumerate(frames):
        job.process(spark.createDataFrame([(t,) for t in texts], "value string"), n)
    rows = {r["time"]: r for r in job.tables.read(spark, "status").collect()}
    assert [rows[to_dt(at(t))]["status"] for t in ("10:00", "09:30", "09:45", "10:15")] == [0, 4, 4, 0]
    assert rows[to_dt(at("10:15"))]["ths"] == to_dt(at("10:07:30"))
    assert rows[to_dt(at("10:15"))]["thd"] == 7
    assert job.tables.read(spark, "secondary").count() == 4
    (state,) = job.state.before(spark, 9).collect()
    assert state["time"] == to_dt(at("10:15"))


def test_day_edge(spark):
    """An episode is stored under the day of its start; earlier rows are repaired on both days."""
    from test_detection import S1

    shift = at("23:30") - at("00:00")
    texts = [line(1, t + shift, r) for t, r in S1]
    root = new_folder()
    job = LoadJob(root, dimension, as_of="2024-03-06 01:00:00")
    for n, part in enumerate([texts[:1], texts[1:3], texts[3:]]):
        job.process(spark.createDataFrame([(t,) for t in part], "value string"), n)
    assert job.tables.read(spark, "episodes", ["20240305"]).count() == 1
    status = job.tables.read_status(spark).orderBy("time")
    assert [r["status"] for r in status.collect()] == [0, 1, 1, 1, 1, 1, 0]
    assert [r["status"] for r in job.tables.read_status(spark, ["20240306"]).orderBy("time").collect()] == [
        1, 1, 1, 0]


def test_empty_batch_writes_nothing(spark):
    root = new_folder()
    job = LoadJob(root, dimension)
    job.process(spark.createDataFrame([], "value string"), 0)
    assert job.state.before(spark, 1) is None and not job.counts


def test_stop_marker(spark):
    folder, root = new_folder(), new_folder()
    query = (
        files.watch_lines(spark, folder).writeStream.format("noop")
        .option("checkpointLocation", f"{root}/cp").trigger(processingTime="100 milliseconds").start()
    )
    marker = f"{root}/stop"
    open(marker, "w").close()
    run_until_marker(spark, query, marker, poll_seconds=0.5)
    import os

    assert not query.isActive and not os.path.exists(marker)


def test_intervals():
    assert trigger_interval("5 second") == "5 seconds"
    assert trigger_interval("3  MINUTES") == "3 minutes"
    for bad in ["5", "5 hours", "0 second", "x second", "5 second now"]:
        with pytest.raises(ValueError):
            trigger_interval(bad)


def test_tables_in_catalog(spark):
    root = new_folder()
    tables = DayTables(root)
    tables.create(spark, "loads_test")
    tables.create(spark, "loads_test")
    names = {r["tableName"] for r in spark.sql("SHOW TABLES IN loads_test").collect()}
    assert names == {"secondary", "primary", "status", "episodes", "marks"}
    days = spark.range(30).selectExpr(
        "id AS mp_id", "timestamp_ntz '2024-01-01' + make_dt_interval(cast(id AS int)) AS start", "1 AS n")
    columns, _ = TABLES["marks"]
    rows = days.select(*[F.col(c) if c in days.columns else F.lit(None).cast(f.dataType).alias(c)
                         for c, f in zip(columns, table_schema(columns).fields)])
    tables.write("marks", rows, 0)
    tables.write("marks", rows.where("mp_id > 10"), 1)
    tables.write("marks", rows.where("mp_id < 4"), 0)  # a repeated batch replaces all its days
    assert tables.read(spark, "marks").count() == 4 + 19
    assert tables.read(spark, "marks", ["20240102", "20240112"]).count() == 2
    tables.register(spark, "loads_test")
    assert spark.table("loads_test.marks").count() == 23
    spark.sql("DROP DATABASE loads_test CASCADE")


def test_dimension_is_reloaded_on_its_day(spark):
    loads = []

    def counted(session):
        loads.append(1)
        return dimension(session)

    job = LoadJob(new_folder(), counted, refresh_weekday=2)
    for now, expected in [("2024-03-04", 1), ("2024-03-05", 2), ("2024-03-05", 2), ("2024-03-06", 2),
                          ("2024-03-12", 3)]:
        assert job._dimension(spark, f"{now} 10:00:00").count() == 40
        assert len(loads) == expected, now
