"""The command line: what its jobs call, and a run over files."""

import os

import pytest

from feederlens import __main__ as cli
from feederlens.sources.daytables import DayTables
from helpers import at
from test_streaming import line, new_folder


@pytest.mark.parametrize("bounds,name", [(["a", "b"], "export_by_ranges"), ([], "export_by_bounds")])
def test_export_takes_either_form(spark, monkeypatch, bounds, name):
    calls = []
    monkeypatch.setattr(cli.jobs, name, lambda *a: calls.append(a))
    cli.main(["export", "jdbc:x", "t", "/out", "--column", "k", *(["--bounds", *bounds] if bounds else [])])
    ((_, db, *rest),) = calls
    assert db.url == "jdbc:x"
    assert rest == ([["*"], "t", "k", bounds, "/out"] if bounds else ["t", "k", 1000, 10000, "/out"])


def test_dimension_comes_from_a_file_or_a_database(spark, monkeypatch):
    made = []
    monkeypatch.setattr(cli.jobs, "dimension_from_database", lambda s, db, table: made.append((db.url, table)))
    args = cli._arguments(["stream", "/root", "--dimension-url", "jdbc:y", "--dimension-table", "d", "--refresh-weekday", "2", "--stop-marker", "m"])
    cli._dimension(args)(spark)
    assert made == [("jdbc:y", "d")] and args.refresh_weekday == 2
    with pytest.raises(SystemExit):
        cli._arguments(["batch", "lines", "root"])
    with pytest.raises(SystemExit):
        cli._arguments(["stream", "r", "--dimension", "d", "--stop-marker", "m", "--refresh-weekday", "7"])


def test_batches_and_merged_days_by_command(spark):
    folder, root = new_folder(), new_folder()
    with open(f"{folder}/dimension.csv", "w") as f:
        f.write("1,1,1\n")
    days = [f"2024-03-0{d}" for d in (4, 5, 6, 7)]
    for n, minute in enumerate((0, 15, 30)):
        with open(f"{folder}/lines{n}.txt", "w") as f:
            f.write("".join(line(1, at("10:00", d) + minute * 60_000, 0.5) + "\n" for d in days[n : n + 2]))
        cli.main(["batch", f"{folder}/lines{n}.txt", root, "--dimension", f"{folder}/dimension.csv"])
    tables = DayTables(root)
    assert tables.read(spark, "status").count() == 6
    cli.main(["merge-days", root, "--open-days", "1", "--clean-hours", "0"])
    view = tables.ledger.view(spark)
    assert [len(view.folders("status", [d.replace("-", "")])) for d in days] == [1, 1, 1, 1]
    assert tables.read(spark, "status").count() == 6
    assert sum(len(f) for _, f, _ in os.walk(f"{root}/status/batch=1") if f) <= 4
