"""What larger tables asked for: rows dealt to all cores and computed once, one header a sheet, exact graph results."""

import threading

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle import config, operator_queries, queries
from brindle.functions import shared
from brindle.functions import text as t
from brindle.operators import extract, graph, normalize
from brindle.plans import warehouse

SF = "/root/testdata/sf0.001"


def test_rows_of_one_row_group_are_dealt_to_all_cores(spark):
    assert queries.read(spark, SF, "part").rdd.getNumPartitions() < 2 * spark.sparkContext.defaultParallelism
    assert queries.canonical(spark, SF).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name, times", [("store_counts", 2), ("reasons_by_group", 1), ("merged_metrics", 1), ("quarantine_listed", 1), ("reprocessed", 1), ("gate_thresholds", 1)])
def test_rows_are_computed_once(spark, monkeypatch, name, times):
    """A load of the store takes its rows once; two loads are two passes."""
    seen, real = spark.sparkContext.accumulator(0), operator_queries.processed

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    monkeypatch.setattr(operator_queries, "processed", lambda *a: normalize.bound(real(*a).withColumn("_quarantine_reason", counted("_quarantine_reason"))))
    queries.QUERIES[name](spark, SF).collect()
    n = queries.read(spark, SF, "part").count()
    assert 0 < seen.value <= times * n


def test_white_space_is_that_of_the_regular_expression(spark):
    df = spark.createDataFrame([(chr(i),) for i in range(0x3100)], "c string")
    odd = F.concat("c", F.lit("a b"), "c", F.lit("\n"))
    same = (t.ustrip(odd) == F.regexp_replace(odd, r"(?U)^\s+|\s+$", "")) & (t.ustrip("c") == F.regexp_replace("c", r"(?U)^\s+|\s+$", ""))
    assert df.where(~same).count() == 0


def test_a_second_row_at_the_headers_place_doubles_nothing(spark):
    rows = [("f", 0, "Better-1", 7, ["Base P/No", "Qty"]), ("f", 0, "Better-1", 7, [None, None]), ("f", 0, "Better-1", 8, ["AB1", "2"])]
    cells = spark.createDataFrame(rows, "file_path string, sheet_idx int, sheet_name string, row_idx int, cells array<string>")
    assert [r["values"] for r in extract.rows(cells, config.rule("56col")).collect()] == [{"Base P/No": "AB1", "Qty": "2"}]


def test_checked_results_are_the_nearest_of_all(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(600, 16))
    vectors[500:] = vectors[:100]  # copies are tied
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>")
    graph.write_graph_index(df, "v", "id", f"{tmp_path}/g", shard_rows=150)
    asked = vectors[::100]
    # results that are far from the nearest bound little; those of the graphs nearly all
    poor = spark.createDataFrame([(q, i, -1.0) for q in range(len(asked)) for i in range(5)], "question int, id long, semantic double")
    for found in (poor, graph.semantic_graph(spark, f"{tmp_path}/g", asked.tolist(), "id", 5)):
        got = {}
        for r in graph.checked(spark, f"{tmp_path}/g", asked.tolist(), found, "id", 5).orderBy("question", F.desc("semantic"), "id").collect():
            got.setdefault(r["question"], []).append(r["id"])
        for q, a in enumerate(asked):
            score = np.round((vectors * a).sum(1) / np.sqrt((vectors * vectors).sum(1)) / np.sqrt((a * a).sum()), 12)
            assert got[q] == sorted(range(600), key=lambda i: (-score[i], i))[:5]


@pytest.mark.parametrize("name", ["store_counts", "store_events", "store_models", "store_ledger"])
def test_two_loads_take_one_pass(spark, monkeypatch, name):
    """Both runs' rows are computed in one pass, and a run is counted once."""
    seen, real, verify, asked = spark.sparkContext.accumulator(0), operator_queries.processed, warehouse.Warehouse.verify, []

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    monkeypatch.setattr(operator_queries, "processed", lambda *a: normalize.bound(real(*a).withColumn("_quarantine_reason", counted("_quarantine_reason"))))
    monkeypatch.setattr(warehouse.Warehouse, "verify", lambda self, run: (asked.append(run), verify(self, run))[1])
    queries.QUERIES[name](spark, SF).collect()
    assert seen.value == queries.read(spark, SF, "part").count()
    assert asked == (["run_a", "run_b"] if name == "store_counts" else [])


def test_rows_without_working_columns_are_the_same(spark):
    whole, lean = queries.processed(spark, SF), queries.processed(spark, SF, False)
    assert lean.columns == normalize.drop_working(whole).columns
    assert lean.exceptAll(normalize.drop_working(whole)).count() == 0 == normalize.drop_working(whole).exceptAll(lean).count()
    assert "_before_base_part_no" not in lean._jdf.queryExecution().optimizedPlan().toString()


def test_a_load_makes_its_tables_at_once(spark, monkeypatch, tmp_path):
    """Each of the three waits for the others, so one after the other none would come to an end."""
    met, real = threading.Barrier(3, timeout=60), {name: getattr(warehouse, name) for name in ("parts", "models", "change_events")}
    for name in real:
        monkeypatch.setattr(warehouse, name, lambda *a, name=name: (met.wait(), real[name](*a))[1])
    rows = queries.processed(spark, SF, False).withColumns({"source_file": F.lit("part"), "form_version": F.lit("96col")})
    w = warehouse.Warehouse(spark, str(tmp_path))
    counts = w.load(rows, "r")
    assert counts == {k: n for k, n in w.verify("r").items() if n} and set(counts) == set(real)
    assert w.rollback("r") == {"bom_edges": 0, "change_events": counts["change_events"], "event_details": 0}


def test_staged_rows_come_from_methods_that_are_compiled(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(name), []
    with shared.compiled(spark):
        seen.append(int(spark.conf.get(name)))
    with pytest.raises(ZeroDivisionError), shared.compiled(spark):
        1 / 0
    assert seen[0] <= 8000 and spark.conf.get(name) == before


def test_text_tests_name_their_argument_once(spark):
    times = {fn.__name__: str(fn(F.col("zz"))).count("zz") for fn in (t.ustrip, t.blank, t.nullish, t.number)}
    assert times == {"ustrip": 1, "blank": 1, "nullish": 1, "number": 2}
    odd = {"": (True, True, None), "\u3000\n": (True, True, None), "NaN": (True, True, None), " NaN": (False, False, None), "nan": (False, False, None), " N/a\u2003": (False, True, None), "—": (False, True, None), "none x": (False, False, None), "\x1c": (False, False, None), " 1.\n": (False, False, 1.0), "1e999": (False, False, None), "1 2": (False, False, None), "1d": (False, False, None), "\u0661": (False, False, None)}
    df = spark.createDataFrame([(k,) for k in odd] + [(None,)], "c string")
    got = {r[0]: tuple(r[1:]) for r in df.select("c", t.blank(F.col("c")), t.nullish(F.col("c")), t.number(F.col("c"))).collect()}
    assert got == odd | {None: (True, True, None)}


def test_what_is_not_there_takes_no_job(spark, tmp_path):
    w = warehouse.Warehouse(spark, str(tmp_path))
    for name, schema in warehouse.SCHEMAS.items():
        none = w.table(name)
        assert none._jdf.queryExecution().optimizedPlan().toString().startswith("LocalRelation <empty>")
        assert none.count() == 0 and none.dtypes == spark.createDataFrame([], schema).dtypes


def test_truncated_texts_are_those_of_sql(spark, tmp_path):
    """Also without a text, of blanks or a word for nothing alone, with other white space or forms that NFKC would change."""
    signs = [chr(i) for i in range(0x3100)] + ["\ufb03", "\uff21", "\U0001f600"]
    texts = [None, "", " \n\t ", "N/A", " none ", "NaN", "-", "—", "e\u0301" * 1500, "\ufb03" * 1000, "x" * 2000 + "\n", "x" * 2001, "x" * 1999 + " y", " " * 3000 + "a\r\n b", *(f"{c}a{c}b{c}{c}" for c in signs)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(queries.ORACLE_SQL["normalize_text_truncate"]).fetchall()
    got = queries.QUERIES["normalize_text_truncate"](spark, str(tmp_path)).collect()
    assert len(got) == len(texts) and sorted(map(tuple, got)) == sorted(want)
