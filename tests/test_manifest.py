"""Delivered files are taken once each, whatever breaks in between."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.sources import files, ledger, manifest

TABLES = {"rows": ledger.table("v int, file_dt timestamp_ntz")}


def deliver(base, entry, **parts):
    (base / entry).mkdir(parents=True, exist_ok=True)
    for name, values in parts.items():
        (base / entry / f"{name}.csv").write_text("v\n" + "\n".join(map(str, values)) + "\n")


def setup(spark, tmp_path):
    opened = []

    def read(entries):
        opened.append(sorted(e.rpartition("/")[2] for e in entries))
        return files.delimited(spark, entries, "v int").select("v", "_metadata")

    store = manifest.file_ledger(spark, str(tmp_path / "store"), TABLES)

    def run():
        manifest.take(store, str(tmp_path / "in dir"), read, lambda rows: {"rows": rows})
        return sorted((r["v"], str(r["file_dt"])[:10]) for r in store.read("rows").collect())

    return store, opened, run


def test_files_are_taken_once(spark, tmp_path):
    base = tmp_path / "in dir"
    store, opened, run = setup(spark, tmp_path)
    assert run() == [] and store.commits() == []
    deliver(base, "log_31122023.csv", a=[1, 2])
    deliver(base, "log_01012024.csv", a=[3])
    deliver(base, "undated", a=[99])
    first = [(1, "2023-12-31"), (2, "2023-12-31"), (3, "2024-01-01")]
    assert run() == first and run() == first
    # A file that comes late to a day, and a new day.
    deliver(base, "log_31122023.csv", b=[4])
    deliver(base, "log_02012024.csv", a=[5])
    want = sorted(first + [(4, "2023-12-31"), (5, "2024-01-02")])
    assert run() == want
    assert store.read("files").count() == 4
    assert sorted(str(r["file_dt"])[:10] for r in store.read("files").collect()) == [
        "2023-12-31", "2023-12-31", "2024-01-01", "2024-01-02"]
    # Closed days are not opened any more.
    manifest.close(store, "2024-01-01")
    manifest.close(store, "2023-06-01")
    deliver(base, "log_31122023.csv", c=[6])
    deliver(base, "log_03012024.csv", a=[7])
    assert run() == want + [(7, "2024-01-03")]
    assert opened[-1] == ["log_02012024.csv", "log_03012024.csv"]


def test_a_broken_run_takes_nothing(spark, tmp_path, monkeypatch):
    store, _, run = setup(spark, tmp_path)
    deliver(tmp_path / "in dir", "log_01012024.csv", a=[1])

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ledger.paths, "create_text", lost)
        with pytest.raises(OSError):
            run()
    assert store.read("rows").count() == 0 and store.read("files").count() == 0
    assert run() == [(1, "2024-01-01")] and store.read("files").select(F.sum("bytes")).first()[0] == 4
