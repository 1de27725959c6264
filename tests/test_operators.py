"""Parsing, dimension, power, text and table operators on small hand-made inputs."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from feederlens.functions.numbers import format_double, ratio
from feederlens.functions.times import from_ms, parse_time, refresh_due, to_ms
from feederlens.operators import latest as L
from feederlens.operators.dimension import attach_dimension, clean_dimension, typed_dimension
from feederlens.operators.parsing import dedup_readings, parse_lines, recent
from feederlens.operators.power import primary_readings, stored_readings
from feederlens.operators.runs import track
from feederlens.operators.textlines import compact_lines, peek
from feederlens.plans import jobs
from feederlens.schema import MEASURES, SECONDARY_COLUMNS, table_schema
from feederlens.sources import files, jdbc, kafka
from feederlens.sources.storage import shared_folder, staged
from helpers import frame, state_frame, to_dt
from model import run

STAMP = "2019-04-19 10:15:00"
MOMENT = dt.datetime(2019, 4, 19, 10, 15)


def raw(key="586", stamp=STAMP, measures=("1",) * 16, fields=None):
    return "||".join(fields or [key, stamp, *measures])


def parsed(spark, *lines):
    return parse_lines(spark.createDataFrame([(t,) for t in lines], "value string")).collect()


@pytest.mark.parametrize("line", [
    raw(measures=("1",) * 15), raw(measures=("1",) * 17), raw(measures=("a|b", *["1"] * 15)),
    raw(key="none"), raw(key="12x"), raw(stamp="not a time"), raw(stamp="2019-04-19"),
    raw(stamp="2019-02-30 10:00:00"), raw(stamp="2019-04-19 25:00:00"), raw(key="9" * 30),
    "||" * 17, "", raw(key="x", stamp="y", measures=("z",) * 15 + ("1",)),
    raw(key="x", stamp="586", measures=(STAMP, *["1"] * 15)),
])
def test_bad_lines_are_dropped(spark, line):
    assert parsed(spark, line) == []


@pytest.mark.parametrize("line", [
    raw(), raw(key="﻿586"), raw(key="ID: 586"), raw(key=" 586\t"), raw(stamp=f"  {STAMP}.000 "),
    raw(stamp="2019-4-19 10:15:0"), raw(stamp=STAMP + ".0009"),
])
def test_good_lines_are_kept(spark, line):
    (row,) = parsed(spark, line)
    assert (row["mp_id"], row["time"]) == (586, MOMENT)


def test_measures(spark):
    texts = ["", "abc", "1e3", ".5", "5.", "+3.5", "-2", " 7 ", "12000", "-12000", "1.23456",
             "1.23454", "9999.99", "NaN", "1d", "\t0.00004\r"]
    (row,) = parsed(spark, raw(measures=texts))
    bad = 9999.99
    assert [row[c] for c in MEASURES] == [
        bad, bad, bad, bad, bad, 3.5, -2.0, 7.0, bad, bad, 1.2346, 1.2345, bad, bad, bad, 0.0]


def test_window_of_24_hours(spark):
    as_of = dt.datetime(2024, 1, 2, 12)
    ms = dt.timedelta(milliseconds=1)
    day = dt.timedelta(days=1)
    times = [as_of - day - ms, as_of - day, as_of, as_of + ms]
    df = spark.createDataFrame([(t,) for t in times], "time timestamp_ntz")
    assert sorted(r[0] for r in recent(df, as_of).collect()) == times[1:3]
    now = spark.range(1).select(F.localtimestamp().alias("time"))
    assert recent(now).count() in (0, 1)  # the clock may move on between two plans


def test_exact_copies_are_removed(spark):
    rows = [(1, MOMENT, *[1.0] * 16)] * 3 + [(1, MOMENT, *[1.0] * 15, 2.0)]
    df = spark.createDataFrame(rows, table_schema(SECONDARY_COLUMNS))
    assert dedup_readings(df).count() == 2


def test_dimension(spark):
    texts = ["10", " 10 ", "1.5", "-3", "x", None]
    df = spark.createDataFrame([(str(i), t, "5") for i, t in enumerate(texts)], "k string, r string, c string")
    got = {r["mp_id"]: r["ratio"] for r in clean_dimension(typed_dimension(df)).collect()}
    assert [got[i] for i in range(6)] == [10.0, 10.0, 0.0, 0.0, 0.0, 0.0]
    later = spark.createDataFrame(
        [("1", "10", "5", 1), ("1", "20", None, 2), ("x", "3", "4", 3)],
        "k string, r string, c string, line int")
    (row,) = clean_dimension(typed_dimension(later), order=F.col("line")).collect()
    assert tuple(row) == (1, 20.0, 0.0)


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_dimension_join_of_either_form(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    readings = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (1, 4)], "mp_id bigint, n int")
    dim = spark.createDataFrame([(1, 2.0, 5.0), (2, 0.0, 5.0), (4, 1.0, 1.0)],
                                "mp_id bigint, ratio double, capacity double")
    joined = attach_dimension(readings, dim)
    assert sorted(tuple(r) for r in joined.collect()) == [(1, 1, 2.0, 5.0), (1, 4, 2.0, 5.0)]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


BAD = 9999.99


@pytest.mark.parametrize("p,q,capacity,power,rate", [
    ((3, 1, 1, 1), (4, 1, 1, 2), 50.0, 50.0, 1.0),
    ((3, 2, 2, 2), (4, 3, 3, 2), 50.0, 100.0, 2.0),
    ((BAD, 1, 1, 1), (4, 1, 1, 2), 50.0, 50.0, 1.0),
    ((3, BAD, 1, 1), (4, 1, 1, 2), 50.0, 50.0, 1.0),
    ((BAD, BAD, 1, 1), (4, 1, 1, 2), 50.0, BAD, BAD),
    ((3, 1, 1, 1), (4, 1, 1, 2), 0.0, 50.0, BAD),
    ((3, 1, 1, 1), (4, 1, 1, 2), None, 50.0, BAD),
    ((BAD, 1, 1, 1), (-10, 1, 1, 2), 50.0, 10000.489987999232, 200.0098),
])
def test_power_and_load_rate(spark, p, q, capacity, power, rate):
    values = [float(v) for v in (*p, *q)]
    df = spark.createDataFrame(
        [(1, MOMENT, *values, *[0.5] * 8, 10.0, capacity)],
        ", ".join(["mp_id bigint", "time timestamp_ntz", *[f"{c} double" for c in MEASURES],
                   "ratio double", "capacity double"]))
    (row,) = primary_readings(df).collect()
    assert (row["maxpower"], row["loadrate"]) == (pytest.approx(power, rel=1e-12), rate)
    assert row["zglys"] == 0.5 and row["szgl"] == 5.0
    (kept,) = stored_readings(primary_readings(df)).collect()
    assert kept["maxpower"] == min(round(power, 4), BAD)


def test_number_and_time_functions(spark):
    df = spark.createDataFrame([(12000.0,), (-12000.0,), (1.23456,), (-1.5,)], "v double")
    assert [r[0] for r in df.select(format_double(F.col("v"))).collect()] == [BAD, BAD, 1.2346, -1.5]
    one = spark.range(1)
    assert one.select(ratio(F.lit("\t7\n"))).first()[0] == 7.0
    day = dt.datetime(2024, 1, 2)  # a Tuesday
    assert one.select(refresh_due(F.lit(day)), refresh_due(F.lit(day), 0)).first()[:] == (True, False)


def test_times_do_not_depend_on_the_session_zone(spark):
    text = "2024-03-10 02:30:00.123"  # skipped by daylight saving in New York
    results = set()
    try:
        for zone in ("America/New_York", "UTC", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = spark.range(1).select(F.lit(text).cast("timestamp_ntz").alias("t"))
            results.add(row.select(to_ms(F.col("t"))).first()[0])
            later = row.select(F.lit("2024-07-01 12:00:00").alias("x")).select(parse_time(F.col("x")))
            assert later.first()[0] == dt.datetime(2024, 7, 1, 12)
            back = spark.range(1).select(from_ms(F.lit(1_710_037_800_123))).first()[0]
            assert back == dt.datetime(2024, 3, 10, 2, 30, 0, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert 1_710_037_800_123 in results


def test_compact_lines_into_sorted_files(spark):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = [raw(key=str(k), stamp=f"2019-04-19 {h:02}:00:00") for k in (586, 99) for h in (3, 1, 2)]
    found = compact_lines(spark.createDataFrame([(r,) for r in rows], "value string"), "586||")
    files.write_lines(found, f"{out}/t", files=1)
    got = [r["value"] for r in spark.read.text(f"{out}/t").collect()]
    assert got == sorted(rows[:3]) and len(got) == 3
    assert compact_lines(spark.createDataFrame([("5x",)], "value string"), "5").count() == 1


def test_peek_and_ranges(spark):
    df = spark.range(100)
    assert [r[0] for r in peek(df, "id", 90).collect()] == list(range(90, 100))
    assert [r[0] for r in peek(df, "id", 10, 3).collect()] == [10, 11, 12]


def test_range_predicates_and_faults():
    made = jdbc.range_predicates("k", ["03", "04'x"])
    assert made == ["k < '03'", "k >= '03' AND k < '04''x'", "k >= '04''x'", "k IS NULL"]
    with pytest.raises(ValueError):
        jdbc.range_predicates("k", ["b", "a"])
    assert jdbc.range_faults([("a", "c"), ("c", None)]) == []
    assert [f.split(":")[0] for f in jdbc.range_faults([("a", "c"), ("b", "d"), ("e", None)])] == [
        "overlap", "hole"]
    assert len(jdbc.range_faults([("a", None), ("b", "c")])) == 1


class Recorder:
    """Stands for Spark's reader or writer and keeps what it is told; there is no database here."""

    def __init__(self):
        self.options, self.call = {}, None

    def option(self, key, value):
        self.options[key] = value
        return self

    def mode(self, value):
        return self.option("mode", value)

    def jdbc(self, *args, **kwargs):
        self.call = (args, kwargs)
        return self


def test_jdbc_settings():
    class Session:
        read = Recorder()

    class Rows:
        write = Recorder()

    db = jdbc.Database("jdbc:x", {"user": "u", "password": "p"})
    assert "p'" not in repr(db)
    jdbc.read_by_bounds(Session, db, "t", "id", 1000, 10000)
    assert Session.read.options["fetchsize"] == 5000
    assert Session.read.call[1]["numPartitions"] == 5 and Session.read.call[1]["lowerBound"] == 1000
    jdbc.read_by_predicates(Session, db, jdbc.subquery("select a from b"), ["a < 1", "a >= 1"])
    assert Session.read.call[0][1] == "(select a from b) t"
    jdbc.write_table(Rows, db, "t")
    assert Rows.write.options == {"mode": "overwrite", "truncate": "true", "batchsize": 40000}


def test_kafka_settings():
    options = kafka.stream_options("h:9092", "a, b", max_records=7)
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "7"
    with pytest.raises(ValueError):
        kafka.stream_options("h:9092", " , ")
    assert kafka.peek_options("h", "t", 2, 50)["startingOffsets"] == '{"t": {"2": 50}}'


def test_dimension_csv(spark):
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    files.write_csv(spark.createDataFrame([("1", "10", "2.5"), ("x", "a", "b")], "a string, b string, c string"), f"{out}/d")
    got = files.read_dimension_csv(spark, f"{out}/d").collect()
    assert sorted((tuple(r) for r in got), key=str) == [(1, "10", 2.5), (None, "a", None)]


def test_latest_state_and_lookup(spark):
    states = {k: run([(1000 * k, 0.5)])["state"] for k in (1, 2, 3)}
    state = state_frame(spark, states)
    assert L.latest(state, state).count() == 3
    keys = spark.createDataFrame([(2,), (2,), (9,)], "mp_id bigint")
    found = {r["mp_id"]: r for r in L.lookup(keys, state).collect()}
    assert found[2]["loadrate"] == 0.5 and found[9]["loadrate"] == BAD and found[9]["time"] is None
    assert [r[0] for r in L.new_keys(keys, state).collect()] == [9]
    assert sorted(r[0] for r in L.in_range(state, 2, 3).select("mp_id").collect()) == [2, 3]
    assert L.with_sentinel_times(state).first()["ths"] == to_dt(1000)


def test_shared_folder(spark):
    assert shared_folder(spark, "/other") == spark.conf.get("spark.checkpoint.dir")
    with staged(spark.range(5)) as table:
        assert table.count() == 5


def test_detection_shuffles_the_readings_only_twice(spark):
    """Once to merge copies, once into slices; the two passes share that exchange, and the union of
    readings and seeds needs none of its own."""
    df = track(frame(spark, {1: [(k * 900_000, 0.9) for k in range(200)]}))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1
    exchanges = [l for l in plan.splitlines() if "+- Exchange" in l]
    assert len(exchanges) == 4
    assert all("mp_id" in l for l in exchanges)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_late_copies_come_from_the_merge_of_copies(spark, tmp_path):
    rows = [(k, to_dt(900_000 * t), 0.1 * c) for k in range(5) for t in range(40) for c in range(1 + (t + k) % 3)]
    spark.createDataFrame(rows, "mp_id bigint, time timestamp_ntz, loadrate double").write.parquet(f"{tmp_path}/readings")
    df = jobs.status_rows(spark.read.parquet(f"{tmp_path}/readings"))
    plan = final_plan(df)
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 2
    late = [r for r in df.collect() if r["status"] == 4]
    assert len(late) == sum((t + k) % 3 for k in range(5) for t in range(40)) == len(rows) - 200


def test_latest_sorts_no_structs(spark):
    states = state_frame(spark, {k: run([(1000 * k, 0.5)])["state"] for k in range(1, 30)})
    newer = states.where("mp_id < 9").withColumn("time", F.expr("time + INTERVAL 1 MINUTE"))
    late = states.withColumn("time", F.expr("time + INTERVAL 1 HOUR")).withColumn("status", F.lit(4))
    df = L.latest(states.unionByName(late), newer)
    assert "SortAggregate" not in final_plan(df) and final_plan(df).count("WindowGroupLimit") == 2
    want = {k: to_dt(1000 * k + 60_000 * (k < 9)) for k in range(1, 30)}
    assert {r["mp_id"]: r["time"] for r in df.collect()} == want


def test_a_hot_point_meets_the_dimension_in_several_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    readings = spark.range(4000).selectExpr("1L AS mp_id", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) AS time", "1D AS zyggl")
    dim = spark.createDataFrame([(1, 2.0, 5.0)], "mp_id bigint, ratio double, capacity double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    joined = attach_dimension(readings, dim)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 3000
