"""The store: loads at once, old readers, vacuum, constraints, lookups, buckets that a load rewrites."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from brindle.plans import warehouse

SCHEMA = "source_file string, row_index int, base_part_no string, new_part_no string, part_name string, bom_level int, part_type string, change_type string, change_point string, change_reason string, form_version string, model_code string, _quarantine_reason string"


def rows(spark, names, part_name="n", file="f"):
    return spark.createDataFrame([(file, i, n, None, part_name, 1, "t", "New", "p", None, "96col", f"WSED{7000 + i % 3}M.ABMQEUR", None) for i, n in enumerate(names)], SCHEMA)


def parts_of(w):
    return {r.part_no: r.part_name for r in w.table("parts").collect()}


def test_two_loads_at_once(spark, tmp_path):
    """The second load comes between the first one's reading and its commit: neither loses a row, and an old reader keeps his."""
    w, other = warehouse.Warehouse(spark, str(tmp_path)), warehouse.Warehouse(spark, str(tmp_path))
    w.load(rows(spark, [f"AB{1000000 + i}" for i in range(40)], "old"), "r0")
    reader, events = w.table("parts"), w.table("change_events")
    commit, calls = w._commit, []

    def late(*a):
        if not calls:
            calls.append(1)
            other.load(rows(spark, [f"AB{1000000 + i}" for i in range(20, 60)], "other"), "r1")
        return commit(*a)

    w._commit = late
    w.load(rows(spark, [f"AB{1000000 + i}" for i in range(0, 30)], "mine"), "r2")
    want = {f"AB{1000000 + i}": "mine" if i < 30 else "other" for i in range(60)}
    assert parts_of(w) == want and w.table("change_events").count() == 40 + 40 + 30
    assert {r.part_name for r in reader.collect()} == {"old"} and reader.count() == 40 and events.count() == 40
    assert w.verify("r2") == {"parts": 30, "models": 3, "bom_edges": 0, "change_events": 30, "event_details": 0}
    # versions that nobody has go, but not while they are young
    assert w.vacuum() == 0
    gone = w.vacuum(-1)
    assert gone and parts_of(w) == want and w.table("change_events").count() == 110
    assert w.vacuum(-1) == 0


def test_the_same_run_twice_at_once(spark, tmp_path):
    w, other = warehouse.Warehouse(spark, str(tmp_path)), warehouse.Warehouse(spark, str(tmp_path))
    commit = w._commit
    w._commit = lambda *a: (other.load(rows(spark, ["AB1234567"]), "r"), commit(*a))[1]
    with pytest.raises(warehouse.Refused):
        w.load(rows(spark, ["AB1234568"]), "r")
    assert list(parts_of(w)) == ["AB1234567"] and w.runs().count() == 1
    with pytest.raises(warehouse.Refused):
        other.load(rows(spark, []), "empty")


def test_one_of_many_gets_the_number(spark, tmp_path):
    w = warehouse.Warehouse(spark, str(tmp_path))
    got, state = [], {"n": 0, "tables": {}}
    threads = [threading.Thread(target=lambda k=k: got.append(w._commit(state, f"r{k}", "loaded", {}, {}, {}))) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [False] * 7 + [True] and [f for f in os.listdir(tmp_path / "ledger") if not f.startswith(".")] == ["000000000001.json"]


def test_a_load_rewrites_its_buckets_only(spark, tmp_path):
    w = warehouse.Warehouse(spark, str(tmp_path))
    w.load(rows(spark, [f"AB{1000000 + i}" for i in range(500)]), "r0")
    before = w._state()["tables"]["parts"]
    w.load(rows(spark, ["AB1000007", "AB1000008"], "new"), "r1")
    after = w._state()["tables"]["parts"]
    moved = {b for b in after if after[b] != before.get(b)}
    assert len(before) == warehouse.BUCKETS and 1 <= len(moved) <= 2
    written = [d for d in os.listdir(tmp_path / "parts") if d.startswith("r1-")]
    assert len(written) == 1 and {d.removeprefix("bucket=") for d in os.listdir(tmp_path / "parts" / written[0]) if d.startswith("bucket=")} == moved
    assert w.table("parts").count() == 500 and w.table("parts", "r1").count() == 2


def test_lookup_reads_one_file(spark, tmp_path):
    w = warehouse.Warehouse(spark, str(tmp_path))
    w.load(rows(spark, [f"AB{1000000 + i}" for i in range(300)]), "r0")
    found = w.lookup("parts", "AB1000123")
    assert [r.part_no for r in found.collect()] == ["AB1000123"] and len(found.inputFiles()) == 1
    assert found.collect() and "PushedFilters: [IsNotNull(part_no), EqualTo(part_no,AB1000123)]" in found._jdf.queryExecution().executedPlan().toString()
    metrics = {}

    def walk(node):
        for k, v in [(m._1(), m._2().value()) for m in (lambda it: [it.next() for _ in iter(it.hasNext, False)])(node.metrics().iterator())]:
            metrics[k] = metrics.get(k, 0) + v
        children = node.children()
        [walk(children.apply(i)) for i in range(children.size())]

    found = w.lookup("parts", "AB1000123")
    found._jdf.collectToPython()
    walk(found._jdf.queryExecution().executedPlan())
    assert metrics.get("numFiles", 1) == 1
    event = w.table("change_events").first().event_id
    assert w.lookup("change_events", event).count() == 1 == w.lookup("change_events", event, "r0").count() and w.lookup("change_events", event, "r9").count() == 0
    assert w.lookup("parts", "none").count() == 0 and warehouse.Warehouse(spark, f"{tmp_path}/none").lookup("models", "x").count() == 0


def test_constraints(spark, tmp_path):
    w = warehouse.Warehouse(spark, str(tmp_path))
    assert w.init() and not w.init()
    assert json.loads((tmp_path / "catalogue.json").read_text())["references"]["change_events"]["model_code"] == "models"
    good = rows(spark, ["AB1234567", "AB1234568"])
    twice = good.where("row_index = 0").withColumn("part_name", F.lit("z"))  # the same file and row once more
    orphan = good.where("row_index = 1").withColumns({"row_index": F.lit(9), "new_part_no": F.lit(" ")})
    counts = w.load(good.unionAll(twice).unionAll(orphan), "r0")
    assert counts == {"parts": 2, "models": 2, "change_events": 2, "rejected": 2}
    bad = {r.constraint: r for r in w.rejected("r0").collect()}
    assert set(bad) == {"unique", "new_part_no"} and bad["new_part_no"].value == " " and json.loads(bad["unique"].raw_data)["part_name"] == "z"
    assert w.table("change_events").select("event_id").distinct().count() == 2 and parts_of(w) == {"AB1234567": "n", "AB1234568": "n"}
    # an id that another run has
    made = warehouse.change_events(good, "r0").withColumn("_n", F.lit(1))
    new = {"parts": w.table("parts"), "models": w.table("models")}
    assert {r.constraint for r in warehouse.broken(made, new, w.table("change_events").select("event_id")).collect()} == {"known"}
    assert warehouse.broken(made, new, w.table("change_events").select("event_id").where("false")).count() == 0


def test_parts_by_hashing(spark):
    a = [("b", 1, "X", "Y", "b1"), ("a", 5, "Y", None, "a5"), ("a", 2, "Z", "X", "a2"), ("a", 2, "Z", "X", "a1"), ("a", None, " ", "W", "none"), (None, 3, "W", "V", "no file")]
    df = spark.createDataFrame([(f, r, b, n, p, 1, "t", "New", None, None, "v", "m", None) for f, r, b, n, p in a], SCHEMA)
    got = warehouse.parts(df, "r")
    assert {r.part_no: r.part_name for r in got.collect()} == {"X": "a1", "Y": "a5", "Z": "a1", "W": "no file", "V": "no file"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    with pytest.raises(Exception, match="too large"):
        warehouse.parts(df.withColumn("row_index", F.lit(1 << 50)), "r").collect()


def test_store_query_loads_each_time(spark, tmp_path):
    """Twice in a row, with tables that changed under the same path."""
    import __spark_entry__ as e

    def tables(n):
        part = spark.range(1, n).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "'MFGR#1' AS p_mfgr", "'Brand#1' AS p_brand", "'TYPE' AS p_type", "cast(id % 50 AS int) AS p_size", "'JAR' AS p_container", "cast(900 + id AS double) AS p_retailprice", "'c' AS p_comment")
        part.write.mode("overwrite").parquet(f"{tmp_path}/part.parquet")

    counts = []
    for n in (200, 320):
        tables(n)
        began = time.time()
        counts.append(e.queries()["store_parts"](spark, str(tmp_path)).count())
        assert time.time() - began > 0
    assert counts[0] < counts[1]
