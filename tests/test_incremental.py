"""Runs that take a workbook once, by content: again, late files, copies, changes, roll-back, streams, merged metrics."""

import shutil

import pytest
from pyspark.sql import functions as F

from brindle.operators import validate
from brindle.plans import runs
from brindle.sources import xlsx
from brindle.streaming.landing import workbook_stream
from tests.test_engine import HEAD, workbook


def book(*numbers, name="Bracket"):
    rows = [[n, "AB1234568", name, 2, "단품", "Change", "내열 보강", "필드 불량", 1, "WSED7667M.ABMQEUR", *["x"] * 49] for n in numbers]
    return workbook({"변경점List": [["Common", "FMEA", "HSMS"], HEAD, *rows], "History": [["h"]]})


def names(state):
    return sorted(f["file_path"].rsplit("/", 1)[-1] for f in state["files"])


def test_a_workbook_is_taken_once(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.xlsx").write_bytes(book("AB1111111"))
    (raw / "b.xlsx").write_bytes(book("AB2222222", "AB3333333"))
    r = runs.Runs(spark, str(tmp_path / "runs"))
    assert names(r.run_new(str(raw), run_id="one")) == ["a.xlsx", "b.xlsx"]
    opened = []
    monkeypatch.setattr(xlsx, "read_cells", lambda *a, real=xlsx.read_cells: opened.append(a) or real(*a))
    assert r.run_new(str(raw)) is None and not opened  # nothing new: no workbook is read
    (raw / "late.xlsx").write_bytes(book("AB4444444"))
    shutil.copy(raw / "a.xlsx", raw / "copy.xlsx")  # the same content under another name
    assert names(r.run_new(str(raw), run_id="two")) == ["late.xlsx"] and len(opened) == 1
    assert r.run_new(str(raw)) is None
    (raw / "b.xlsx").write_bytes(book("AB5555555"))
    assert names(r.run_new(str(raw), run_id="three")) == ["b.xlsx"]
    assert {x.base_part_no for x in r.rows("three").collect()} == {"AB5555555"}
    # of a run that is rolled back the files are free again
    r.commit("two")
    r.rollback("two")
    assert names(r.run_new(str(raw), run_id="four")) == ["late.xlsx"]
    # metrics of several runs from their states, against those of all their rows
    rows = [spark.read.parquet(f"{r.find(x)[1]}/rows") for x in ("one", "three")]
    read = [spark.read.parquet(f"{r.find(x)[1]}/raw") for x in ("one", "three")]
    want = validate.gate(validate.report(rows[0].unionByName(rows[1]), raw=read[0].unionAll(read[1]))).first().asDict()
    got = r.metrics(["one", "three"]).first().asDict()
    rounded = lambda d: {k: round(v, 9) if isinstance(v, float) else v or None for k, v in d.items()}
    assert rounded(got) == rounded(want) and got["rows_in"] == 4 and r.metrics(["one", "three"], ["source_file"]).count() == 2


def test_a_run_that_broke_off(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.xlsx").write_bytes(book("AB1111111", "bad"))
    r = runs.Runs(spark, str(tmp_path / "runs"))
    with monkeypatch.context() as m:
        m.setattr(runs.report, "markdown", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            r.run_new(str(raw), run_id="one")
    state = r.run_new(str(raw), run_id="one")
    assert state["metrics"]["rows_in"] == 2 and r.taken().count() == 1
    assert spark.read.parquet(f"{tmp_path}/runs/quarantine").where("run_id = 'one'").count() == 1


def test_workbooks_that_land(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    r = runs.Runs(spark, str(tmp_path / "runs"))
    land = lambda: workbook_stream(spark, str(raw), r, str(tmp_path / "cp"), commit=True).awaitTermination(300)
    (raw / "a.xlsx").write_bytes(book("AB1111111"))
    land()
    land()
    (raw / "b.xlsx").write_bytes(book("AB2222222"))
    (raw / "c.xlsx").write_bytes(book("none at all"))  # held back by the gate with its batch
    land()
    got = r.taken().groupBy("run_id").agg(F.sort_array(F.collect_list(F.element_at(F.split("file_path", "/"), -1))).alias("f")).collect()
    assert sorted(x.f for x in got) == [["a.xlsx"], ["b.xlsx", "c.xlsx"]]
    states = {r.state(x.run_id)["status"] for x in got}
    assert states == {"committed", "dry_run"}
