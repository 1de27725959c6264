"""Conversions between the model's plain rows and the tables."""

from datetime import datetime, timedelta

from feederlens.schema import DURATIONS, STARTS

EPOCH = datetime(1970, 1, 1)


def to_dt(ms):
    return None if ms is None else EPOCH + timedelta(milliseconds=ms)


def at(text, day="2024-03-05"):
    """Milliseconds of a clock time like 00:07:30.000."""
    clock = text if text.count(":") == 2 else text + ":00"
    moment = datetime.fromisoformat(f"{day} {clock}")
    return round((moment - EPOCH).total_seconds() * 1000)


def frame(spark, by_key):
    rows = [(k, to_dt(t), lr) for k, series in by_key.items() for t, lr in series]
    return spark.createDataFrame(rows, "mp_id bigint, time timestamp_ntz, loadrate double")


def state_frame(spark, by_key):
    cols = "mp_id bigint, time timestamp_ntz, " + ", ".join(
        [f"{c} timestamp_ntz" for c in STARTS] + [f"{c} bigint" for c in DURATIONS]
    ) + ", status int, overloadstatus int, loadrate double"
    return spark.createDataFrame([model_row(k, r) for k, r in by_key.items() if r], cols)


def model_row(key, r):
    return (key, to_dt(r["t"]), *[to_dt(s) for s in r["s"]], *r["d"], r["status"], r["klass"], r["lr"])


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def table(df):
    return order(tuple(r) for r in df.collect())


def model_rows(results, name):
    return order(model_row(k, r) for k, res in results.items() for r in res[name])


def model_episodes(results):
    return order(
        (k, s, c, to_dt(a), to_dt(b), d)
        for k, res in results.items() for s, c, a, b, d in res["episodes"]
    )


def model_marks(results):
    return order(
        (k, s, c, to_dt(a), to_dt(t)) for k, res in results.items() for s, c, a, t in res["marks"]
    )
