"""Commits, merged days, state by bucket, dimension versions, feeds and stops."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from feederlens.operators.episodes import apply_marks
from feederlens.operators.latest import latest
from feederlens.plans import jobs
from feederlens.schema import STATUS_SCHEMA, table_schema
from feederlens.sources import files, kafka
from feederlens.sources.daytables import TABLES, DayTables
from feederlens.sources.ledger import Ledger, _runs
from feederlens.streaming import job as job_module
from feederlens.streaming.dimension import DimensionVersions
from feederlens.streaming.feeding import Admission, FolderFeed
from feederlens.streaming.job import LoadJob
from feederlens.streaming.state import StateStore
from feederlens.streaming.stopping import BatchListener, run_until_marker
from helpers import at, order, table, to_dt
from test_detection import S1
from test_streaming import dimension, line, lines_of, new_folder, small


def texts(spark, lines):
    return spark.createDataFrame([(t,) for t in lines], "value string")


def parts_of(lines, n):
    return [lines[i * len(lines) // n : (i + 1) * len(lines) // n] for i in range(n)]


def everything(spark, job):
    """All that readers see: the rows of all tables, status with marks, state."""
    read = {name: table(job.tables.read(spark, name)) for name in TABLES}
    state = job.state.before(spark, 10**6)
    return read | {"repaired": table(job.tables.read_status(spark)), "state": [] if state is None else table(state)}


@pytest.fixture(scope="module")
def streamed(spark):
    """Three batches without any fault, and what readers saw after each."""
    parts = parts_of(lines_of(small()), 3)
    job = LoadJob(new_folder(), dimension, as_of="2024-03-06 00:00:00", state_base_every=2)
    seen = []
    for n, part in enumerate(parts):
        job.process(texts(spark, part), n)
        seen.append(everything(spark, job))
    return parts, job, seen


@pytest.mark.parametrize("fails", ["status", "marks", "state", "commit"])
def test_a_failing_batch_shows_nothing(spark, streamed, monkeypatch, fails):
    parts, _, seen = streamed
    job = LoadJob(new_folder(), dimension, as_of="2024-03-06 00:00:00", state_base_every=2)
    job.process(texts(spark, parts[0]), 0)

    class Broken(Exception):
        pass

    def broken(original, name):
        def write(self, *args, **kwargs):
            if fails in ("state", "commit") or args[0] == fails:
                raise Broken(name)
            return original(self, *args, **kwargs)
        return write

    with monkeypatch.context() as m:
        owner, name = {"state": (StateStore, "save"), "commit": (Ledger, "commit")}.get(fails, (DayTables, "write"))
        m.setattr(owner, name, broken(getattr(owner, name), name))
        with pytest.raises(Broken):
            job.process(texts(spark, parts[1]), 1)
        assert everything(spark, job) == seen[0]
    job.process(texts(spark, parts[1]), 1)
    assert everything(spark, job) == seen[1]
    job.process(texts(spark, parts[2]), 2)
    assert everything(spark, job) == seen[2]
    job.process(texts(spark, parts[0]), 2)  # committed: whatever comes under its number is not handled
    assert everything(spark, job) == seen[2]
    assert not os.listdir(f"{job.root}/plans")


def test_whole_batches_without_commits_are_taken_over(spark, streamed):
    parts, _, seen = streamed
    job = LoadJob(new_folder(), dimension, as_of="2024-03-06 00:00:00")
    job.process(texts(spark, parts[0]), 0)
    for name in os.listdir(f"{job.root}/tables/_commits"):
        os.remove(f"{job.root}/tables/_commits/{name}")
    assert everything(spark, job) == seen[0]
    job.process(texts(spark, parts[1]), 1)
    assert everything(spark, job) == seen[1]


def test_snapshots_say_what_their_commits_said(spark):
    log = Ledger(new_folder())
    assert not log.exists(spark) and log.view(spark).last is None
    for n in range(7):
        log.commit(spark, n, [("status", f"batch={n}", d) for d in ("20240101", "20240102")], {"n": n})
        if n == 2:
            log.exchange(spark, [("status", "batch=-5", "20240101")], [("status", f"batch={i}", "20240101") for i in (0, 1, 2)])
        before = log.view(spark)
        assert log.info(spark, n) == {"n": n}
        log.fold(spark, every=3)
        after = log.view(spark)
        assert (before.leaves, before.runs) == (after.leaves, after.runs)
        assert len([x for x in os.listdir(log.folder) if x.endswith(".json")]) <= 4
    view = log.view(spark)
    assert view.runs == [[0, 6]] and view.committed(3) and not view.committed(7)
    assert view.folders("status", ["20240101"]) == ["batch=-5/dt=20240101", *(f"batch={n}/dt=20240101" for n in (3, 4, 5, 6))]
    assert _runs([5, 1, 2, 9, 8]) == [[1, 2], [5, 5], [8, 9]]
    with pytest.raises(OSError, match="could not create"):
        log.commit(spark, 99, [])
        log.commit(spark, 99, [])


def test_merged_days_hold_the_same_rows(spark):
    """Runs over midnight: a mark of the second day repairs rows of the first."""
    shift = at("23:30") - at("00:00")
    lines = [line(k, t + shift + k * 60_000, r) for k in (1, 2, 3) for t, r in S1]
    lines.sort(key=lambda x: x.split("||")[1])
    job = LoadJob(new_folder(), dimension, as_of="2024-03-06 01:00:00")
    for n, part in enumerate(parts_of(lines, 6)):
        job.process(texts(spark, part), n)
    tables = job.tables
    tables.create(spark, "loads_merged")
    tables.register(spark, "loads_merged")
    before = {d: {name: table(tables.read(spark, name, [d])) for name in TABLES if name != "status"} for d in ("20240305", "20240306")}
    status = {d: table(tables.read_status(spark, [d])) for d in before}
    assert table(tables.read(spark, "status")) != order(status["20240305"] + status["20240306"])
    assert tables.closed_days(spark, open_days=1) == ["20240305"]
    old = {name: spark.read.parquet(*[f"{tables.path(name)}/{x}" for x in tables.ledger.view(spark).folders(name)]) for name in TABLES}
    rows = {name: df.count() for name, df in old.items()}

    assert tables.merge_days(spark, ["20240305", "19990101"]) == ["20240305"]
    view = tables.ledger.view(spark)
    assert all(len(view.folders(name, ["20240305"])) <= 1 for name in TABLES)
    assert any(len(view.folders(name, ["20240306"])) > 1 for name in TABLES)
    assert tables.merge_days(spark, list(before)) == list(before)
    view = tables.ledger.view(spark)
    assert all(len(view.folders(name, [d])) <= 1 for name in TABLES for d in before)
    for d in before:
        assert {name: table(tables.read(spark, name, [d])) for name in TABLES if name != "status"} == before[d]
        assert table(tables.read_status(spark, [d])) == status[d] == table(tables.read(spark, "status", [d]))
    # Readers that began before still find their files; later ones see the merged days in the catalog too.
    assert rows == {name: df.count() for name, df in old.items()}
    tables.register(spark, "loads_merged")
    assert spark.table("loads_merged.status").count() == sum(map(len, status.values()))
    # Rows that come later for a merged day are seen, and merged the next time.
    job.as_of = "2024-03-06 02:00:00"
    job.process(texts(spark, [line(7, at("23:59"), 0.2), line(7, at("23:59") + 15 * 60_000, 0.3)]), 6)
    assert tables.read(spark, "status", ["20240305"]).count() == len(status["20240305"]) + 1
    tables.merge_days(spark, ["20240305"])
    assert tables.read_status(spark, ["20240305"]).count() == len(status["20240305"]) + 1
    assert not tables.clean(spark, older_than_hours=1)
    assert tables.clean(spark, older_than_hours=0)
    assert table(tables.read_status(spark, ["20240306"]).where("mp_id < 7")) == status["20240306"]
    spark.sql("DROP DATABASE loads_merged CASCADE")


def test_repaired_rows_are_read_once(spark, streamed):
    """In either form of the joins, and next to a point with very many rows."""
    _, job, seen = streamed
    stored, marked = job.tables.read(spark, "status"), job.tables.read(spark, "marks")
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        df = apply_marks(stored, marked)
        assert table(df) == seen[-1]["repaired"] != seen[-1]["status"]
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert sum("FileScan" in x and "loadrate" in x for x in plan.splitlines()) == 1
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def states(spark, rows):
    """Status rows (point, minute, load rate) that are otherwise plain."""
    made = spark.createDataFrame([(k, to_dt(at("00:00") + m * 60_000), r) for k, m, r in rows], "mp_id long, time timestamp_ntz, loadrate double")
    return made.select(*[F.col(f.name) if f.name in made.columns else F.lit(0 if f.name == "status" else None).cast(f.dataType).alias(f.name) for f in STATUS_SCHEMA])


def test_state_of_touched_points_reads_their_buckets(spark, capsys):
    store = StateStore(new_folder(), base_every=3, buckets=16)
    batches = [[(k, n, k / 100) for k in range(n, 400, 3 + n)] for n in range(5)]
    for n, rows in enumerate(batches):
        store.save(spark, n, states(spark, rows))
    assert sorted(os.listdir(f"{store.root}/base")) == ["batch=2"]
    whole = store.before(spark, 5)
    assert table(whole) == table(latest(states(spark, [r for b in batches for r in b])))
    keys = spark.createDataFrame([(3,), (3,), (6,), (100_000,)], "mp_id long")
    got = store.before(spark, 5, touched=keys)
    assert table(got) == table(whole.where("mp_id IN (3, 6)"))
    got.explain("formatted")
    plan = capsys.readouterr().out
    scans = [x for x in plan.split("\n\n") if "Scan parquet" in x and "/base/" in x]
    (filters,) = [x for x in scans[0].split("\n") if x.startswith("PartitionFilters")]
    assert len(scans) == 1 and "bucket" in filters
    assert "LeftSemi" in plan
    # Another number of buckets counts from the next base on.
    wider = StateStore(store.root, base_every=3, buckets=5)
    assert table(wider.before(spark, 5, touched=keys)) == table(got)
    wider.save(spark, 5, states(spark, [(3, 50, 0.5)]))
    assert os.listdir(f"{store.root}/base/batch=5") == ["of=5"]
    assert table(store.before(spark, 6, touched=keys)) == table(latest(states(spark, [r for b in batches for r in b] + [(3, 50, 0.5)])).where("mp_id IN (3, 6)"))


def test_a_repeated_batch_uses_its_dimension(spark, monkeypatch):
    ratio = ["1"]
    job = LoadJob(new_folder(), lambda s: s.createDataFrame([(1, ratio[0], 1.0)], "mp_id bigint, bl string, capacity double"), as_of="2024-03-05 12:00:00")
    lines = texts(spark, [line(1, at("10:00"), 0.7)])
    with monkeypatch.context() as m:
        m.setattr(StateStore, "save", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.process(lines, 0)
    ratio[0] = "2"
    again = LoadJob(job.root, job.dimension, as_of="2024-03-06 12:00:00")
    again.process(lines, 0)
    assert [r["loadrate"] for r in again.tables.read(spark, "primary").collect()] == [0.7]
    again.process(texts(spark, [line(1, at("10:15", "2024-03-06"), 0.7)]), 1)
    assert sorted(r["loadrate"] for r in again.tables.read(spark, "primary").collect()) == [0.7, 1.4]
    used = [again.tables.ledger.info(spark, n)["dimension"] for n in (0, 1)]
    assert used[0] != used[1] and sorted(os.listdir(f"{job.root}/dimension")) == sorted(f"version={v}" for v in used)


def test_equal_dimensions_are_one_version(spark):
    versions = DimensionVersions(new_folder())
    rows = [(k, float(k), 2.0) for k in range(50)]
    frame = lambda some: spark.createDataFrame(some, "mp_id bigint, ratio double, capacity double")
    first = versions.put(spark, frame(rows))
    assert versions.put(spark, frame(rows[::-1]).repartition(7)) == first
    assert versions.put(spark, frame(rows[1:])) != first
    assert versions.put(spark, frame([])) == "0-0000000000000000"
    assert table(versions.get(spark, first)) == order(rows)
    assert len(os.listdir(versions.root)) == 3


def test_stop_with_a_backlog(spark, monkeypatch):
    """Always another file to read: the query is never idle, yet the marker ends it between two batches."""
    folder, root = new_folder(), new_folder()
    for n in range(60):
        with open(f"{folder}/part{n:03}.txt", "w") as f:
            f.write(f"{n}\n")
    done = []

    def slow(rows, batch):
        time.sleep(0.3)
        done.append(rows.count())

    query = (
        files.watch_lines(spark, folder, 1).writeStream.foreachBatch(slow).option("checkpointLocation", f"{root}/cp")
        .trigger(processingTime="0 seconds").start()
    )
    listener = BatchListener(query, keep=3)
    spark.streams.addListener(listener)
    try:
        marker = f"{root}/stop"
        threading.Timer(3, lambda: open(marker, "w").close()).start()
        began = time.time()
        run_until_marker(spark, query, marker, poll_seconds=0.5)
        assert time.time() - began < 15 and not query.isActive and not os.path.exists(marker)
        committed = len([x for x in os.listdir(f"{root}/cp/commits") if not x.startswith(".")])
        assert 1 <= committed < 60 and committed <= len(done) <= committed + 1
        time.sleep(0.5)
        assert 1 <= listener.ended <= committed and len(listener.last) <= 3
        assert listener.rows == listener.ended and listener.milliseconds >= 300 * listener.ended
    finally:
        spark.streams.removeListener(listener)
    monkeypatch.setattr(job_module, "KEPT_COUNTS", 5)
    job = LoadJob(root, dimension)
    for n in range(20):
        job._count(n, n)
    assert list(job.counts) == [15, 16, 17, 18, 19]


def test_root_and_checkpoint_belong_together(spark):
    folder, root = new_folder(), new_folder()
    with open(f"{folder}/a.txt", "w") as f:
        f.write(line(1, at("10:00"), 0.7) + "\n")
    job = LoadJob(root, dimension, as_of="2024-03-05 12:00:00")
    job.start(files.watch_lines(spark, folder), interval=None).awaitTermination()
    assert job.tables.read(spark, "primary").count() == 1
    job.start(files.watch_lines(spark, folder), interval=None).awaitTermination()
    for other in (f"{new_folder()}/cp", f"{root}/checkpoints/other"):
        with pytest.raises(ValueError, match="batches of another checkpoint"):
            job.start(files.watch_lines(spark, folder), interval=None, checkpoint=other)
    with pytest.raises(ValueError, match="batches of another checkpoint"):
        LoadJob(new_folder(), dimension).start(files.watch_lines(spark, folder), interval=None, checkpoint=f"{root}/checkpoints/load_rates")
    used = LoadJob(new_folder(), dimension, as_of="2024-03-05 12:00:00")
    used.process(texts(spark, [line(1, at("10:00"), 0.7)]), 0)
    with pytest.raises(ValueError, match="batches of another checkpoint"):
        used.start(files.watch_lines(spark, folder), interval=None)


@pytest.mark.parametrize("n", [2, 5])
def test_any_number_of_analysed_batches(spark, n):
    lines = lines_of(small())
    whole, split = new_folder(), new_folder()
    want = table(jobs.analyse(texts(spark, lines), dimension(spark), whole))
    for part in parts_of(lines, n):
        got = jobs.analyse(texts(spark, part), dimension(spark), split)
    assert table(got) == want
    one, many = DayTables(whole), DayTables(split)
    for name in ("secondary", "primary", "episodes", "marks"):
        assert table(many.read(spark, name)) == table(one.read(spark, name)), name
    assert table(many.read_status(spark)) == table(one.read(spark, "status"))
    late = jobs.analyse(texts(spark, [line(1, at("00:01"), 0.9)]), dimension(spark), split)
    assert table(late) == want and many.read(spark, "status").where("status = 4").count() == 1
    assert table(jobs.analyse(texts(spark, lines), dimension(spark), split, batch=0)) == table(StateStore(f"{split}/state").before(spark, 1))
    assert many.read(spark, "secondary").count() == len(lines) + 1


def test_lines_of_a_split_file_keep_their_order(spark):
    folder = new_folder()
    want = {}
    for name, n in (("b.txt", 3000), ("a.txt", 1), ("c.txt", 500), ("empty.txt", 0)):
        want[name] = [f"{name} {i} {'é🙂' * (i % 50)}" for i in range(n)]
        with open(f"{folder}/{name}", "w") as f:
            f.write("".join(x + "\n" for x in want[name]))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        lines = files.numbered_lines(spark, folder)
        assert spark.read.text(folder).rdd.getNumPartitions() > 10
        got = [(os.path.basename(r["file"]), r["line"], r["value"]) for r in lines.collect()]
        assert sorted(got) == sorted((f, i + 1, x) for f, some in want.items() for i, x in enumerate(some))
        sent = kafka.records_in_order(lines)
        tasks = sent.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {f: [r["value"] for r in tasks if r["key"].endswith(f)] for f in want} == want
    assert all(len({r["task"] for r in tasks if r["key"].endswith(f)}) <= 1 for f in want)


def test_files_are_admitted_when_they_rest():
    a = Admission()
    assert a.poll({"x": (0, 1), "y": (5, 1)}) == []
    assert a.poll({"x": (0, 1), "y": (5, 1), "z": (1, 1)}) == ["y"]
    assert a.poll({"x": (3, 2), "y": (5, 1), "z": (2, 2)}) == []
    assert a.poll({"x": (3, 2), "y": (6, 3), "z": (2, 2)}) == ["x", "z"]
    assert a.poll({"x": (3, 2), "y": (6, 3)}) == ["y"]  # sent again, as it was changed
    assert a.poll({"x": (3, 2), "y": (6, 3)}) == []
    assert a.poll({"x": (3, 2), "z": (2, 2)}) == []
    assert a.poll({"x": (3, 2), "z": (2, 2)}) == ["z"]  # gone and back


def test_a_folder_feeds_whole_files_only(spark):
    folder, root, sent = new_folder(), new_folder(), []

    def sink(lines, batch):
        sent.append(sorted((os.path.basename(r["file"]), r["line"], r["value"]) for r in lines.collect()))

    def write(name, text):
        with open(f"{folder}/{name}", "a") as f:
            f.write(text)

    def polled(feed):
        names = [os.path.basename(p) for p in feed.admit(spark)]
        feed.start(spark, interval=None).awaitTermination()
        return names

    feed = FolderFeed(folder, root, sink)
    assert polled(feed) == [] and sent == []
    write("a.txt", "1\n2\n")
    write("empty.txt", "")
    assert polled(feed) == []
    write("b.txt", "x\n")
    assert polled(feed) == ["a.txt"]
    assert sent == [[("a.txt", 1, "1"), ("a.txt", 2, "2")]]
    write("b.txt", "y\n")
    assert polled(feed) == [] and len(sent) == 1
    # After a restart the log says what was sent.
    feed = FolderFeed(folder, root, sink)
    assert polled(feed) == []
    assert polled(feed) == ["b.txt"]
    assert sent[1:] == [[("b.txt", 1, "x"), ("b.txt", 2, "y")]]
    write("a.txt", "3\n")
    assert polled(feed) == []
    assert polled(feed) == ["a.txt"] and len(sent[2]) == 3
    assert [json.loads(x)["bytes"] for n in sorted(os.listdir(feed.log)) if n.startswith("poll") for x in open(f"{feed.log}/{n}")] == [4, 4, 6]
    open(f"{root}/stop", "w").close()
    feed.run(spark, f"{root}/stop", poll_seconds=1)
    assert not os.path.exists(f"{root}/stop") and len(sent) == 3
