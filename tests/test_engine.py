"""The engine: values, forms, extraction, runs, comparison, search, store."""

import io
import random
import re
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import text as t
from brindle.operators import axioms, classify, diff, extract, mapping, normalize, quarantine, resolve, search, validate
from brindle.plans import runs, warehouse
from brindle.sources import xls, xlsx


def letters(i):
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook(sheets):
    """A minimal workbook of {name: rows}, with inline strings and numbers."""
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        ns, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, rows in enumerate(sheets.values()):
            body = ""
            for n, row in enumerate(rows, 1):
                cells = ""
                for k, v in enumerate(row):
                    ref = f"{letters(k)}{n}"
                    if isinstance(v, (int, float)):
                        cells += f'<c r="{ref}"><v>{v}</v></c>'
                    elif v is not None:
                        cells += f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
                body += f'<row r="{n}">{cells}</row>'
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{ns}"><sheetData>{body}</sheetData></worksheet>')
    return f.getvalue()


HEAD = ["Base P/No", "New P/No", "Class Desc.", "BOM Level", "Part Type", "구분", "변경점", "변경사유", "Qty", "Base Model", *(f"col{i}" for i in range(10, 59))]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    v12 = {"변경점List": [["Common", "FMEA", "HSMS"], HEAD, ["AB1234567", "AB1234568", "Bracket", 2, "단품", "Change", "내열 보강", "필드 불량", 1, "WSED7667M.ABMQEUR", *["x"] * 49]], "History": [["h"]]}
    (d / "v12.xlsx").write_bytes(workbook(v12))
    (d / "96.xlsx").write_bytes(workbook({"공통": [["g"] * 96, *[[]] * 5, ["aaaa"], ["CP", "PP", "DV", "PV", "PQ"], [f"col{i}" for i in range(96)]]}))
    (d / "56.xlsx").write_bytes(workbook({"Better-1": [["Base Model", "Suffix", *(f"c{i}" for i in range(54))], []]}))
    (d / "20.xlsx").write_bytes(workbook({"작업": [[], ["Base P/No", "New P/No", "Part Name", *(f"c{i}" for i in range(17))], ["AB1234567"]]}))
    (d / "weird.xlsx").write_bytes(workbook({"s": [["x"] * 40]}))
    (d / "broken.xls").write_bytes(b"no workbook")
    return str(d)


def test_values(spark):
    cases = [("part_no", "AB01234567", "AB01234567"), ("part_no", "ＡＢ1234567", "AB1234567"), ("part_no", "AB１２３４５６７", "AB1234567"), ("part_no", " ab-123 4567 ", "AB1234567"), ("change_point", "내열".encode().decode() + " 보강", "내열 보강"), ("change_point", "", None), ("change_point", "   ", None), ("change_point", "N/A", None), ("grade", "Best1", "Best-1"), ("grade", "B1", "Best-1"), ("change_point", "내열\r\n보강", "내열 보강"), ("change_point", "내열 보강", "내열 보강"), ("change_point", "x" * 3000, "x" * 2000)]
    for rule, raw, want in cases:
        row = normalize.normalize_field(spark.createDataFrame([(raw,)], "v string"), "v", config.NORMALIZATION[rule]).first()
        assert (row["v"], row["_reason_v"]) == (want, None), (rule, raw)
    bad = [("part_no", "123", "post_validate: part_no"), ("qty", "45412", "range_check: not in 0..9999"), ("bom_level", "x", "cast: not a int"), ("change_type", "what", "map_alias: unknown value"), ("qty", "inf", "cast: not a float")]
    for rule, raw, reason in bad:
        row = normalize.normalize_field(spark.createDataFrame([(raw,)], "v string"), "v", config.NORMALIZATION[rule]).first()
        assert row["_reason_v"] == reason
    with pytest.raises(ValueError):
        normalize.normalize_field(spark.createDataFrame([("a",)], "v string"), "v", {"steps": ["no such step"]})


def test_axioms(spark):
    df = spark.createDataFrame([("ab 123-4567", "WS7D7610B", "신규", "Good2", "cp", 11)], "p string, m string, c string, g string, s string, b int")
    row = df.select(axioms.part_no(F.col("p")), axioms.model_code(F.col("m")), axioms.normalize_change_type(F.col("c")), axioms.normalize_grade(F.col("g")), axioms.event_stage(F.col("s")), axioms.bom_level(F.col("b"))).first()
    assert list(row) == [True, True, "New", "Good-2", True, False]


def test_models(spark):
    df = spark.createDataFrame([(x,) for x in ("WSED7667M.ABMQEUR", "WSED7667M", "WSED7667M.XYZ", "garbage!", "WS7D7610B", None)], "model_code string")
    got = [(r.model_name, r.model_grade_suffix, r.model_region) for r in resolve.resolve_models(df).collect()]
    assert got == [("WSED7667M", "ABMQ", "EUR"), ("WSED7667M", None, None), ("WSED7667M", "XYZ", None), (None, None, None), (None, None, None), (None, None, None)]


def plain_clusters(names, threshold):
    """Sorted names join the group whose first member is most alike, the first of such groups; written out."""

    def alike(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return 2 * best[-1][-1] / (len(a) + len(b)) if a or b else 1.0

    groups = []
    for name in sorted(set(names)):
        low = " ".join(name.lower().split())
        scores = [alike(low, " ".join(g[0].lower().split())) for g in groups]
        if scores and max(scores) >= threshold:
            groups[scores.index(max(scores))].append(name)
        else:
            groups.append([name])
    return {n: next(m for m in g if len(m) == max(map(len, g))) for g in groups for n in g}


def test_clusters(spark):
    names = ["ACME Corp", "ACME Corp.", "Beta Ltd", "beta  ltd"]
    got = {r.value: r.canonical for r in resolve.resolve_suppliers(spark.createDataFrame([(n,) for n in names], "s string"), "s", 0.85).collect()}
    assert got == plain_clusters(names, 0.85) and len(set(got.values())) == 2


def test_clusters_across_letters(spark):
    rng = random.Random(3)
    names = ["old anvil", "cold anvil", "Cold  Anvil", "bold anvil", "a", "b", "A", "ab", *("".join(rng.choice("abc ") for _ in range(rng.randint(1, 9))) + "x" for _ in range(120))]
    df = spark.createDataFrame([(n,) for n in names], "s string").repartition(3)
    for threshold in (0.85, 0.7):
        got = {r.value: r.canonical for r in resolve.resolve_suppliers(df, "s", threshold).collect()}
        assert got == plain_clusters(names, threshold) == resolve.cluster(names, threshold)
    assert resolve.resolve_suppliers(spark.createDataFrame([("old anvil",), ("cold anvil",)], "s string"), "s", 0.85).select("canonical").distinct().count() == 1


def test_indel():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
        return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(2))
        assert t.indel(a, b) == plain(a, b)


def test_mapping(spark):
    df = spark.createDataFrame([(" ab1 ", "P2", "Bracket", "신규")], "`Base P/No` string, `P/no.` string, `Part Name` string, `구분` string")
    row = mapping.apply_mapping(df, config.rule("20col")).first()
    assert (row.base_part_no, row.change_type, row._quarantine_reason) == ("AB1", "New", None)
    row = mapping.apply_mapping(spark.createDataFrame([("x",)], "`Class Desc.` string"), config.rule("96col")).first()
    assert "base_part_no: no source column" in row._quarantine_reason and "model_code: no source column" in row._quarantine_reason


def test_reading(spark, folder):
    cells = xlsx.read_cells(spark, folder)
    assert cells.where("error is not null").count() == 1
    forms = {r.file_path.rsplit("/", 1)[-1]: r for r in classify.classify(cells.where("sheet_name is not null")).collect()}
    assert {k: r.form_version for k, r in forms.items()} == {"v12.xlsx": "v1_2", "96.xlsx": "96col", "56.xlsx": "56col", "20.xlsx": "20col", "weird.xlsx": "unknown"}
    assert forms["weird.xlsx"].confidence == 0 and all(not r.needs_review for r in forms.values()) and forms["v12.xlsx"].confidence >= 0.85
    inventory = xlsx.inventory(spark, folder)
    assert inventory.select("file_path").distinct().count() == 5 and inventory.where("sheet_name = 'History'").first().guess == "v1.2"


def old_workbook(sheets, cut=60):
    """A workbook of {name: {(row, col): value}} in the old format: shared strings cut into parts, and all kinds of cells."""
    import struct

    rec = lambda k, b: struct.pack("<HH", k, len(b)) + b
    strings = sorted({v for s in sheets.values() for v in s.values() if isinstance(v, str)})
    flat, parts = struct.pack("<II", len(strings), len(strings)), []
    for x in strings:
        wide = any(ord(c) > 255 for c in x)
        head, signs = struct.pack("<HB", len(x), wide), x
        if len(flat) + 3 > cut:
            parts, flat = [*parts, flat], b""
        flat += head
        while signs:
            n = max(0, (cut - len(flat)) // (1 + wide))
            flat += signs[:n].encode("utf-16-le" if wide else "latin-1")
            signs = signs[n:]
            if signs:
                parts, flat = [*parts, flat], bytes([wide])
    table = b"".join(rec(0xFC if i == 0 else 0x3C, p) for i, p in enumerate([*parts, flat]))
    bodies = []
    for s in sheets.values():
        out = rec(0x809, bytes(16))
        for (r, c), v in sorted(s.items()):
            at = struct.pack("<HHH", r, c, 0)
            if isinstance(v, bool):
                out += rec(0x205, at + bytes([v, 0]))
            elif isinstance(v, str):
                out += rec(0xFD, at + struct.pack("<I", strings.index(v)))
            elif isinstance(v, bytes):  # a formula with a text
                out += rec(0x06, at + b"\0" * 6 + b"\xff\xff" + bytes(8)) + rec(0x207, struct.pack("<HB", len(v), 0) + v)
            elif isinstance(v, list):
                out += rec(0xBD, at[:4] + b"".join(struct.pack("<HI", 0, (x & 0x3FFFFFFF) << 2 | 2) for x in v) + struct.pack("<H", c + len(v) - 1))
            elif isinstance(v, int):
                out += rec(0x27E, at + struct.pack("<I", (v * 100 & 0x3FFFFFFF) << 2 | 3))
            else:
                out += rec(0x203, at + struct.pack("<d", v))
        bodies.append(out + rec(0x0A, b""))
    names = [n.encode("utf-16-le") for n in sheets]
    size = lambda n: 4 + 8 + len(n)
    start = 20 + sum(map(size, names)) + len(table) + 4
    places = [start + sum(map(len, bodies[:i])) for i in range(len(bodies))]
    book = rec(0x809, bytes(16)) + b"".join(rec(0x85, struct.pack("<IHBB", at, 0, len(n) // 2, 1) + n) for at, n in zip(places, names)) + table + rec(0x0A, b"") + b"".join(bodies)
    book = book.ljust(4096, b"\0")
    n = -(-len(book) // 512)
    entry = lambda name, kind, first, size: name.encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HBB", 2 * len(name) + 2, kind, 1) + b"\xff" * 12 + bytes(36) + struct.pack("<IQ", first, size)
    folder = (entry("Root Entry", 5, 0xFFFFFFFE, 0) + entry("Workbook", 2, 2, len(book))).ljust(512, b"\0")
    fat = [0xFFFFFFFD, 0xFFFFFFFE, *range(3, n + 2), 0xFFFFFFFE]
    head = xls.SIGNATURE + bytes(16) + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<9I", 0, 1, 1, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)
    return head + struct.pack("<128I", *fat, *[0xFFFFFFFF] * (128 - len(fat))) + folder + book.ljust(512 * n, b"\0")


def test_old_workbook(spark, tmp_path):
    book = old_workbook({"Better-1": {(2, 0): "Base P/No", (2, 1): "부품명", (2, 2): "Qty", (3, 0): "AB1234567", (3, 1): "x" * 150, (3, 2): 2.5, (4, 0): b"cached", (4, 1): True, (4, 2): -7, (5, 0): [1, -2, 3]}, "둘": {(0, 0): "é", (0, 3): 1e20}})
    got = xlsx.read_any(book)
    assert got == [(0, "Better-1", 1, ["Base P/No", "부품명", "Qty"]), (0, "Better-1", 2, ["AB1234567", "x" * 150, "2.5"]), (0, "Better-1", 3, ["cached", "True", "-7"]), (0, "Better-1", 4, ["1", "-2", "3"]), (1, "둘", 1, ["é", None, None, "1e+20"])]
    (tmp_path / "a.xls").write_bytes(book)
    (tmp_path / "b.xls").write_bytes(book[:600])
    rows = xlsx.read_cells(spark, str(tmp_path)).collect()
    assert sum(r.error is not None for r in rows) == 1 and sum(r.sheet_name == "Better-1" for r in rows) == 4


def test_merged_and_meta(spark):
    rows = [["Base P/No", "Part Name", "Qty"], ["AB1234567", "Bracket", 2], ["AB1234568", "Other", 1], ["AB1234569", None, 1]]
    got = list(xlsx.read_workbook(workbook({"Better-1": rows})))
    assert [r[2] for r in got] == [1, 2, 3, 4] and got[3][3] == ["AB1234569", None, "1"] and got[1][3][2] == "2"
    cells = spark.createDataFrame([("f", 0, "s", 1, ["Base model", None, "모델명(등급)", "ws7d7610b / Cc\n(호주)"]), ("f", 0, "s", 2, ["Buyer명", "LGEAP", "Brand", "LG"]), ("f", 0, "s", 3, ["", "Set P/No.", "TAP35707209"])], "file_path string, sheet_idx int, sheet_name string, row_idx int, cells array<string>")
    meta = {r.key: r.value for r in extract.meta(cells).collect()}
    assert meta["buyer"] == "LGEAP" and meta["brand"] == "LG" and meta["set_part_no"] == "TAP35707209"
    assert spark.createDataFrame([(meta["model_code"],)], "v string").select(extract.clean_model_code(F.col("v"))).first()[0] == "WS7D7610B"


def test_run(spark, folder, tmp_path):
    r = runs.Runs(spark, str(tmp_path))
    state = r.run(folder)
    status = {f["file_path"].rsplit("/", 1)[-1]: f["status"] for f in state["files"]}
    assert status == {"v12.xlsx": "ok", "96.xlsx": "empty", "56.xlsx": "empty", "20.xlsx": "empty", "weird.xlsx": "needs_human_classification", "broken.xls": "error"}
    assert state["metrics"]["rows_in"] == 1 and state["acceptable"]
    assert f"# Run {state['run_id']}" in spark.read.text(f"{tmp_path}/dry_run/{state['run_id']}/report", wholetext=True).first()[0]
    with pytest.raises(FileNotFoundError):
        r.rollback(state["run_id"])
    assert r.commit(state["run_id"])["status"] == "committed"
    w = warehouse.Warehouse(spark, f"{tmp_path}/db")
    rows = r.rows(state["run_id"]).withColumn("row_index", F.col("row_idx"))
    assert w.load(rows, state["run_id"]) == {"parts": 2, "models": 1, "change_events": 1}
    with pytest.raises(ValueError):
        w.load(rows, state["run_id"])
    assert w.table("models").first().region == "EUR" and w.verify(state["run_id"])["change_events"] == 1
    w.rollback(state["run_id"])
    assert w.verify(state["run_id"])["change_events"] == 0 and w.table("parts").count() == 2
    assert w.runs().first().status == "rolled_back"
    assert r.rollback(state["run_id"])["status"] == "rolled_back"


def test_run_with_ground_truth(spark, folder, tmp_path):
    golden = tmp_path / "golden"
    golden.mkdir()
    (golden / "v12.xlsx").write_bytes(workbook({"g": [["base_part_no", " part_name ", "qty", "note"], ["AB1234567", "other", "1", "x"], ["ZZ1234567", "b", "2", "y"]]}))
    (golden / "none.parquet").write_bytes(b"never read")
    r = runs.Runs(spark, str(tmp_path / "runs"), str(golden))
    state = r.run(folder)
    (path, found), = state["golden"].items()
    assert path.endswith("v12.xlsx") and (found["rows_match"], found["rows_mismatch"], found["rows_only_in_auto"], found["rows_only_in_golden"]) == (0, 1, 0, 1) and found["columns"]["part_name"] == 1
    text = "\n".join(x.value for x in spark.read.text(f"{tmp_path}/runs/dry_run/{state['run_id']}/report").collect())
    assert "match_rate=0.000" in text and "| part_name | 1 |" in text and "| row_preservation | 1.0000 |" in text


def test_thousand_golden_files(spark, tmp_path):
    """One scan for all: Parquet of several schemas, a table that is a folder, workbooks; Parquet goes first."""
    import pyarrow as pa
    from pyarrow import parquet

    for i in range(1000):
        columns = {"base_part_no": [f"AB{i:07d}", None], "qty": [i, 2]} if i % 2 else {"base_part_no": [f"AB{i:07d}"], "qty": [i + 0.5], "note": ["n"]}
        parquet.write_table(pa.table(columns), tmp_path / f"f{i}.parquet")
    spark.createDataFrame([("AB1", "p")], "base_part_no string, part_name string").write.parquet(f"{tmp_path}/folder.parquet")
    (tmp_path / "book.xlsx").write_bytes(workbook({"g": [["base_part_no", " part \n name", None, "qty", "qty"], ["AB2", "b", "x", 7, 8]], "second": [["no"]]}))
    (tmp_path / "f3.xlsx").write_bytes(workbook({"g": [["base_part_no"], ["not read"]]}))
    got = diff.load_golden(spark, str(tmp_path), [*(f"f{i}" for i in range(1000)), "folder", "book", "none"])
    rows = {(r.stem, r.base_part_no): r for r in got.collect()}
    assert len(rows) == 1500 + 2 and rows["f3", "AB0000003"].qty == "3" and rows["f4", "AB0000004"].qty == "4.5" and rows["f3", None].note is None
    assert rows["folder", "AB1"].part_name == "p" and rows["book", "AB2"]["part name"] == "b" and rows["book", "AB2"].qty == "7" and rows["book", "AB2"]["Unnamed: 2"] == "x"
    assert got._jdf.queryExecution().optimizedPlan().toString().count("binaryFile") <= 1 and diff.load_golden(spark, str(tmp_path), ["none"]) is None


def test_report():
    from brindle.plans import report

    total = {k: (1.0 if op == ">=" else 0.0) for k, (op, _) in config.THRESHOLDS.items()} | {"acceptable": True}
    row = {"source_file": "raw/a.xlsx", "rows_in": 10, "rows_out": 9, "rows_quarantined": 1, "rows_dropped": 0, "drop_reasons": {"qty": 1, "part_name": 3}}
    diffs = {"raw/a.xlsx": {"match_rate": 0.9, "rows_match": 9, "rows_mismatch": 1, "rows_only_in_auto": 0, "rows_only_in_golden": 0, "columns": {f"c{i}": i for i in range(1, 8)}}}
    text = report.markdown("run_x", [{"file_path": "raw/a.xlsx", "form_version": "96col", "status": "ok"}], total, [row], diffs)
    assert "match_rate=0.900" in text and text.index("part_name") < text.index("| qty | 1 |") and "| c7 | 7 |" in text and "c2 " not in text and "passes the gate" in text


def test_lost_rows_fail_the_gate(spark):
    schema = "source_file string, base_part_no string, _quarantine_reason string"
    rows = spark.createDataFrame([("a", "AB1234567", None)] * 9 + [("b", "AB1234567", "x: y")], schema)
    raw = spark.createDataFrame([("a", 10), ("b", 1), ("c", 5)], "source_file string, rows_in long")
    by = {r.source_file: r for r in validate.gate(validate.report(rows, ["source_file"], raw)).collect()}
    assert (by["a"].row_preservation, by["a"].rows_dropped, by["b"].rows_dropped, by["b"].axiom_violation_rate) == (0.9, 1, 0, 1.0)
    assert (by["c"].rows_in, by["c"].rows_out, by["c"].rows_dropped, by["c"].row_preservation) == (5, 0, 5, 0.0) and "row_preservation" in by["c"].critical_failures
    total = validate.gate(validate.report(rows, raw=raw)).first()
    assert (total.rows_in, total.rows_dropped, total.row_preservation) == (16, 6, 0.625) and "row_preservation" in total.critical_failures
    assert {tuple(r) for r in validate.top_reasons(rows, ["source_file"]).collect()} == {("b", "x", 1)}


def test_reprocess(spark, tmp_path):
    schema = "base_part_no string, part_name string, qty double"
    rows = spark.createDataFrame([("ab-1234567", "ok now", 1.0, "part_name: x"), ("123", "still", 2.0, "base_part_no: post_validate: part_no")], schema + ", _quarantine_reason string")
    quarantine.save(quarantine.extract(rows, "run_1", F.lit("f.xlsx"), F.lit(1)), f"{tmp_path}/quarantine")
    r = runs.Runs(spark, str(tmp_path))
    got = r.reprocess("run_1", schema)
    assert (got["now_pass"], got["still_fail"]) == (1, 1) and r.state(got["run_id"])["mode"] == "reprocess"
    with pytest.raises(ValueError):
        r.commit(got["run_id"])
    assert r.rows(got["run_id"]).first().base_part_no == "AB1234567"


def test_warehouse_pointer_and_embeddings(spark, tmp_path):
    rows = spark.createDataFrame([("f", 1, "AB1234567", None, "n", 1, "t", "New", "heat shield", None, "96col", "WSED7667M.ABMQEUR", None), ("f", 2, "AB1234568", None, "n", 1, "t", "New", None, None, "96col", "WSED7667M.ABMQEUR", None)], "source_file string, row_index int, base_part_no string, new_part_no string, part_name string, bom_level int, part_type string, change_type string, change_point string, change_reason string, form_version string, model_code string, _quarantine_reason string")
    w = warehouse.Warehouse(spark, str(tmp_path))
    w.load(rows, "r1", search.hashed_vectors)
    assert {len(r.change_point_embedding) for r in w.table("change_events").collect()} == {search.DIM}
    # a load that breaks before its ledger row is not seen
    (commit, w._commit) = (w._commit, lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        w.load(rows.withColumn("part_name", F.lit("half")), "r2")
    w._commit = commit
    assert w.table("change_events").count() == 2 and {r.part_name for r in w.table("parts").collect()} == {"n"} and w.runs().count() == 1
    w.load(rows.withColumn("part_name", F.lit("new")), "r2")
    assert {r.part_name for r in w.table("parts").collect()} == {"new"} and w.table("change_events").count() == 4
    assert w.table("change_events").where("run_id = 'r2' and change_point_embedding is null").count() == 2
    assert w.update_embeddings("r2") == 2 and w.table("change_events").where("change_point_embedding is null").count() == 0
    assert [r.k for r in w.not_loaded(spark.createDataFrame([("r1", 1), ("r9", 2)], "run_id string, k int")).collect()] == [2]
    w.rollback("r1")
    assert w.table("change_events").count() == 2


def test_loaders(tmp_path):
    import json

    from brindle.plans import schema

    (tmp_path / "s.yaml").write_text("versions:\n  a: {threshold: 0.5, signals: [{type: sheet_exists, name: H, weight: 0.4}, {type: col_count_range, range: [1, 2], weight: 0.6}]}\n  b: {signals: [{type: stage_row, markers: [CP, PP], weight: 1}]}\n", encoding="utf-8")
    signals, bounds = config.load_signatures(str(tmp_path / "s.yaml"))
    assert signals == {"a": [("sheet_exists", "H", 0.4), ("col_count_range", (1, 2), 0.6)], "b": [("stage_row", ["CP", "PP"], 1.0)]} and bounds == {"a": 0.5, "b": 0.7}
    (tmp_path / "n.yaml").write_text("fields:\n  qty:\n    steps: [strip, {type: cast, to: float}]\n    on_fail: set_null\n", encoding="utf-8")
    assert config.load_normalization(str(tmp_path / "n.yaml")) == {"qty": {"steps": [{"type": "strip"}, {"type": "cast", "to": "float"}], "on_fail": "set_null"}}
    (tmp_path / "a.yaml").write_text("grade: {allowed: [A, B], aliases: {a: A}, description: x}\nbom_level: {min: 0, max: 10}\n", encoding="utf-8")
    assert config.load_axioms(str(tmp_path / "a.yaml")) == {"grade": {"allowed": ("A", "B"), "aliases": {"a": "A"}}, "bom_level": {"min": 0, "max": 10}}
    schema.export(str(tmp_path / "x.json"))
    found = json.loads((tmp_path / "x.json").read_text(encoding="utf-8"))
    assert set(config.REQUIRED) <= set(found["required"]) and found["properties"]["bom_level"] == {"type": "integer", "minimum": 0, "maximum": 10} and found["properties"]["qty"] == {"anyOf": [{"type": "number"}, {"type": "null"}]}
    assert found["properties"]["mold"]["properties"]["cavity"]["anyOf"][0] == {"type": "integer"}


def test_diff_of_repeated_and_null_keys(spark):
    rng = random.Random(5)
    row = lambda: (rng.choice([None, "a", "b", "c"]), rng.choice(["1", "1.0", " x", "x", None]), rng.choice(["p", "q "]))
    sides = [[row() for _ in range(30)] + [(k, "1", "p")] for k in ("left", "right")]
    auto, golden = (spark.createDataFrame(s, "k string, v string, w string") for s in sides)
    form = lambda v: None if v is None else float(v) if v.strip().replace(".", "").isdigit() else v.strip()
    pairs = [(x, y) for x in sides[0] for y in sides[1] if x[0] == y[0]]
    wrong = [[c for c, i in (("v", 1), ("w", 2)) if form(x[i]) != form(y[i])] for x, y in pairs]
    got = diff.counts(auto, golden, "k").first()
    assert (got.rows_match, got.rows_mismatch, got.rows_only_in_auto, got.rows_only_in_golden) == (sum(not w for w in wrong), sum(map(bool, wrong)), 1, 1)
    assert {r["column"]: r.n for r in diff.column_mismatches(auto, golden, "k").collect()} == {c: n for c in "vw" if (n := sum(c in w for w in wrong))}
    some = diff.samples(auto, golden, "k", 5).collect()
    assert len(some) == 5 and all(r.k is None and r.wrong for r in some)


def test_upsert(spark):
    s = "k string, v string, run_id string"
    got = warehouse.upserted(spark.createDataFrame([("a", "1", "r1"), ("b", "2", "r1")], s), spark.createDataFrame([("a", None, "r2"), ("c", "3", "r2")], s), ["k"])
    assert sorted(map(tuple, got.collect())) == [("a", None, "r2"), ("b", "2", "r1"), ("c", "3", "r2")]


def test_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1, "A", None, "s"), (2, None, "part_name: too long;x: y", "s"), (3, None, "base_part_no: required empty", "s")], "row_index int, base_part_no string, _quarantine_reason string, _source_sheet string")
    records = quarantine.extract(df, "r1", F.lit("f"), F.col("row_index"))
    assert [(r.stage_failed, r.severity) for r in records.orderBy("row_index").collect()] == [("part_name", "warning"), ("base_part_no", "error")]
    quarantine.save(records, f"{tmp_path}/q")
    assert quarantine.listed(spark, f"{tmp_path}/q", "r1").count() == 2 and quarantine.listed(spark, f"{tmp_path}/none", "r1").count() == 0
    assert validate.drop_reasons(df).where("reason = 'x'").first().n == 1


def test_diff(spark):
    s = "base_part_no string, part_name string, qty double"
    auto = spark.createDataFrame([("a", "x ", 1.0), ("b", "y", 2.0), (None, "n", None), ("only", "z", 1.0)], s)
    golden = spark.createDataFrame([("a", "x", "1"), ("b", "Y", "2"), (None, "n", None), ("other", "z", "1")], "base_part_no string, part_name string, qty string")
    assert tuple(diff.counts(auto, golden, "base_part_no").first())[:4] == (2, 1, 1, 1)
    assert [tuple(r) for r in diff.column_mismatches(auto, golden, "base_part_no").collect()] == [("part_name", 1)]
    assert diff.samples(auto, golden, "base_part_no").first().wrong == ["part_name"]
    with pytest.raises(KeyError):
        diff.counts(auto, golden.drop("base_part_no"), "base_part_no")


def test_search(spark):
    row = spark.createDataFrame([("word", "two words")], "a string, b string").select(t.trigram_similarity(t.trigrams(F.col("a")), t.trigrams(F.col("b")))).first()
    assert round(row[0], 4) == 0.3636
    events = search.embed(spark.createDataFrame([(1, "heat shield added", "v"), (2, "bolt changed", "v"), (3, None, "w")], "event_id long, change_point string, form_version string"), "change_point", "vector")
    got = search.hybrid(events, "heat shield", search.hashed_vector("heat shield"), "event_id", "change_point", "vector", 2, F.col("form_version") == "v").collect()
    assert [r.event_id for r in got] == [1, 2] and got[0].score > got[1].score


def test_search_whole_texts(spark, tmp_path):
    from brindle import queries

    def grams(text):
        return {f"  {w} "[i : i + 3] for w in re.findall(r"[^\W_]+", text.lower()) for i in range(len(w) + 1)}

    def alike(text, query):
        a, b = grams(text), grams(query)
        return len(a & b) / len(a | b)

    lexical, hybrid = "the thing and other words of that", "the thing and other words of that in the"
    texts = ["z " * 150 + lexical, "the thing " + "z " * 150, lexical + " " + "z " * 100 + "many more that come behind", "q " * 120 + "other words of that in the thing and", "none", "the " * 90 + "words"]
    vectors = [[1.0, 0.0], [0.9, 0.1], [0.5, 0.5], [0.1, 0.9], [1.0, 1.0], [0.3, 0.4]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.doc_id: r.lexical for r in queries.lexical_top50(spark, str(tmp_path)).collect()}
    assert got == {i: round(v, 6) for i, t in enumerate(texts) if (v := alike(t, lexical)) >= 0.1} and got[0] > 0.9
    got = {r.doc_id: r.score for r in queries.hybrid_search(spark, str(tmp_path)).collect()}
    cosine = lambda v: v[0] / (v[0] ** 2 + v[1] ** 2) ** 0.5
    want = {i: 0.7 * cosine(v) + 0.3 * (s if (s := alike(t, hybrid)) >= 0.3 else 0) for i, (t, v) in enumerate(zip(texts, vectors))}
    assert got == {i: pytest.approx(v, abs=2e-6) for i, v in want.items()} and got[0] > 0.9


def test_indexes(spark, tmp_path):
    rng = random.Random(4)
    words = ["heat", "shield", "bolt", "changed", "added", "cover", "é"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) if i % 9 else None, [rng.gauss(0, 1) for _ in range(6)] if i % 7 else None) for i in range(200)] + [(300, "heat", [0.0] * 6)]
    df = spark.createDataFrame(rows, "id long, text string, v array<double>")
    search.write_lexical_index(df, "text", "id", f"{tmp_path}/g")
    search.write_vector_index(df, "v", "id", f"{tmp_path}/v", cells=9)
    for query, v in (("heat shield", [1.0, 0, 0, 0, 0, 0]), ("bolt", [rng.gauss(0, 1) for _ in range(6)]), ("none of them", rows[1][2])):
        for n in (5, 50, 500):
            assert search.lexical_indexed(spark, f"{tmp_path}/g", query, "id", n).collect() == search.lexical(df, "text", query, "id", n).collect()
            assert [r.id for r in search.semantic_indexed(spark, f"{tmp_path}/v", v, "id", n).collect()] == [r.id for r in search.semantic(df, "v", v, "id", n).collect()]
    search.write_vector_index(df.limit(0), "v", "id", f"{tmp_path}/e")
    assert search.semantic_indexed(spark, f"{tmp_path}/e", [1.0] * 6, "id").count() == 0


def test_gate(spark):
    row = ("AB1234567", "AB1234568", "Bracket", 2, "단품", "Change", "p", None, 1.0, "WSED7667M.ABMQEUR", None)
    schema = "base_part_no string, new_part_no string, part_name string, bom_level int, part_type string, change_type string, change_point string, change_reason string, qty double, model_code string, _quarantine_reason string"
    ok = validate.gate(validate.report(spark.createDataFrame([row], schema))).first()
    assert ok.acceptable and ok.duplicate_rate == 0 and not ok.drop_reasons
    bad = validate.gate(validate.report(spark.createDataFrame([row[:3] + (99,) + row[4:9] + ("?", "model_code: post_validate: model_code"), row], schema))).first()
    assert not bad.acceptable and "referential_integrity" in bad.critical_failures and bad.outlier_rate == 0.25 and bad.drop_reasons == {"model_code": 1}
    none = validate.gate(validate.report(spark.createDataFrame([], schema))).first()
    assert none.rows_in == 0


def test_stream(spark, tmp_path):
    from brindle.streaming.landing import standardise_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"Base P/No": "ab-1234567", "Qty": "2"}\n', encoding="utf-8")
    standardise_stream(spark, str(tmp_path / "in"), "`Base P/No` string, Qty string", "20col", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert (row.base_part_no, row.qty) == ("AB1234567", 2.0)
