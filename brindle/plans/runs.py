"""A run from workbooks to a promoted dataset: dry run, gate, commit, roll back, reprocess."""

from __future__ import annotations

import json
import secrets
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle import config
from brindle.operators import classify, diff, extract, mapping, normalize, quarantine, resolve, states, validate
from brindle.plans import report
from brindle.sources import xlsx

STATES = ("dry_run", "committed", "rolled_back")


def new_run_id() -> str:
    return f"run_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{secrets.token_hex(3)}"


def standardised(cells: DataFrame, forms: DataFrame, run_id: str) -> DataFrame | None:
    """All rows of all files, one plan a form: extracted, mapped, normalised, resolved, with their origin. None if no
    file has rows."""
    out = []
    for form in config.FORMS:
        rule = config.rule(form)
        mine = cells.join(forms.where(F.col("form_version") == form).select("file_path"), "file_path", "left_semi")
        rows = extract.rows(mine, rule)
        names = extract.present(rows)
        if not names:
            continue
        keys = ("file_path", "sheet_idx", "row_idx", "_source_sheet")
        mapped = mapping.apply_mapping(extract.table(rows, rule, names), rule, keep=keys)
        done = resolve.resolve_models(resolve.resolve_parts(normalize.normalize(mapped)))
        out.append(done.withColumns({"source_file": F.col("file_path"), "form_version": F.lit(form), "run_id": F.lit(run_id), "extracted_at": F.current_timestamp()}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out) if out else None


def raw_counts(cells: DataFrame, forms: DataFrame) -> DataFrame:
    """(source_file, rows_in): the data rows that files of known forms have, before anything is done to them."""
    out = []
    for form in config.FORMS:
        mine = cells.join(forms.where(F.col("form_version") == form).select("file_path"), "file_path", "left_semi")
        out.append(extract.rows(mine, config.rule(form)).groupBy(F.col("file_path").alias("source_file")).agg(F.count("*").alias("rows_in")))
    return reduce(DataFrame.unionAll, out)


@dataclass
class Runs:
    """Folders ``dry_run``, ``committed``, ``rolled_back`` (a run lives in one), ``quarantine``, below ``root``."""

    spark: SparkSession
    root: str
    golden: str | None = None  # a folder of ground truth by file stem

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def find(self, run_id: str) -> tuple[str, str]:
        """(state, folder): the first of the states that has the run."""
        for state in STATES:  # a run is looked for in this order
            fs, p = self._fs(f"{self.root}/{state}/{run_id}")
            if fs.exists(p):
                return state, f"{self.root}/{state}/{run_id}"
        raise FileNotFoundError(run_id)

    def state(self, run_id: str) -> dict:
        where = f"{self.find(run_id)[1]}/state"
        return json.loads(self.spark.read.text(where).first()["value"])

    def _write_state(self, folder: str, state: dict) -> None:
        self.spark.createDataFrame([(json.dumps(state, default=str, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/state")

    def statuses(self, cells: DataFrame, forms: DataFrame, rows: DataFrame | None) -> DataFrame:
        """A row a file: ok, empty, needs_human_classification, bom_tree_deferred or error."""
        failed = cells.groupBy("file_path").agg(F.max("error").alias("error"))
        counts = rows.groupBy("file_path").agg(F.count("*").alias("n")) if rows is not None else self.spark.createDataFrame([], "file_path string, n long")
        out = failed.join(forms.select("file_path", "form_version", "confidence"), "file_path", "left").join(counts, "file_path", "left")
        status = F.when(F.col("error").isNotNull(), "error").when(F.coalesce("form_version", F.lit("unknown")) == "unknown", "needs_human_classification").when(F.col("form_version") == "bom_tree", "bom_tree_deferred").when(F.coalesce("n", F.lit(0)) == 0, "empty").otherwise("ok")
        return out.select("file_path", "form_version", "confidence", status.alias("status"), F.coalesce("n", F.lit(0)).alias("rows_in"), "error")

    def _read(self, path: str, run_id: str, only: list[str] | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
        self._release()
        self._cells = cells = xlsx.read_cells(self.spark, path, only).cache()
        forms = classify.classify(cells.where("sheet_name is not null"))
        rows = standardised(cells, forms, run_id)
        return self.statuses(cells, forms, rows), rows, raw_counts(cells, forms)

    def _release(self) -> None:
        """Lets go of the cells that the last reading holds."""
        cells, self._cells = getattr(self, "_cells", None), None
        if cells is not None:
            cells.unpersist()

    def preview(self, path: str, run_id: str = "preview") -> tuple[DataFrame, DataFrame | None]:
        """Statuses and rows, nothing written."""
        return self._read(path, run_id)[:2]

    def diffs(self, rows: DataFrame, key: str = "base_part_no") -> dict[str, dict]:
        """By source file with ground truth: its row of ``diff.counts``, and the differing pairs by column."""
        paths = [r[0] for r in rows.select("source_file").distinct().collect()]  # a row a file
        golden = diff.load_golden(self.spark, self.golden, [diff.stem(p) for p in paths]) if self.golden else None
        if golden is None or key not in golden.columns:
            return {}
        of = self.spark.createDataFrame([(p, diff.stem(p)) for p in paths], "source_file string, stem string")
        auto = normalize.drop_working(rows).join(F.broadcast(of), "source_file")  # a row a file
        golden = golden.join(F.broadcast(of), "stem").drop("stem")
        auto = auto.drop("stem").join(golden.select("source_file").distinct(), "source_file", "left_semi")
        columns = [c for c in golden.columns if c in ("source_file", *config.FIELDS)]
        auto, golden = auto.select(*columns), golden.select(*columns)
        out = {r["source_file"]: r.asDict() | {"columns": {}} for r in diff.counts(auto, golden, key, ["source_file"]).collect()}
        for r in diff.column_mismatches(auto, golden, key, ["source_file"]).collect():
            out[r["source_file"]]["columns"][r["column"]] = r["n"]
        return out

    def taken(self) -> DataFrame:
        """(file_path, size_bytes, modified_at, digest, run_id): files that runs have, but for runs that are rolled back."""
        schema = "file_path string, size_bytes long, modified_at timestamp, digest string, run_id string"
        fs, p = self._fs(f"{self.root}/taken")
        if not fs.exists(p):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(f"{self.root}/taken")
        gone = []
        fs, p = self._fs(f"{self.root}/rolled_back")
        if fs.exists(p):
            gone = [(f.getPath().getName(),) for f in fs.listStatus(p)]
        return found.join(F.broadcast(self.spark.createDataFrame(gone, "run_id string")), "run_id", "left_anti")  # a row a run

    def fresh(self, path: str) -> tuple[list[str], DataFrame]:
        """Files below ``path`` whose content no run has, and all that are new or have changed with their digests. A file
        with the path, size and time of one that is known is not opened; of equal new ones the first by path is taken."""
        known = self.taken()
        changed = xlsx.listed(self.spark, path).join(known.select("file_path", "size_bytes", "modified_at"), ["file_path", "size_bytes", "modified_at"], "left_anti")
        seen = xlsx.digests(self.spark, path, changed).cache()
        new = seen.join(known.select("digest").distinct(), "digest", "left_anti").groupBy("digest").agg(F.min("file_path").alias("file_path"))
        return sorted(r["file_path"] for r in new.select("file_path").collect()), seen  # a row a new file

    def run_new(self, path: str, commit: bool = False, run_id: str | None = None) -> dict | None:
        """A run over the files that no run has, by content; None, and no workbook read, where there are none. A run of the
        same name that broke off before its state was written is done again."""
        only, seen = self.fresh(path)
        try:
            if not only:
                return None
            run_id = run_id or new_run_id()
            for part in (f"dry_run/{run_id}", f"quarantine/run_id={run_id}", f"taken/of={run_id}"):
                fs, p = self._fs(f"{self.root}/{part}")
                fs.delete(p, True)
            out = self.run(path, False, run_id, only)
            seen.withColumn("run_id", F.lit(run_id)).coalesce(1).write.parquet(f"{self.root}/taken/of={run_id}")
            return self.commit(run_id) if commit else out
        finally:
            seen.unpersist()

    def run(self, path: str, commit: bool = False, run_id: str | None = None, only: list[str] | None = None) -> dict:
        """A dry run over all workbooks below ``path``, or over the files ``only``; with ``commit`` promoted if it may be."""
        try:
            return self._run(path, commit, run_id or new_run_id(), only)
        finally:
            self._release()

    def _run(self, path: str, commit: bool, run_id: str, only: list[str] | None) -> dict:
        folder = f"{self.root}/dry_run/{run_id}"
        statuses, rows, raw = self._read(path, run_id, only)
        files = [r.asDict() for r in statuses.orderBy("file_path").collect()]  # a row a file
        total, per_file, diffs, verdict = {}, [], {}, {"acceptable": False, "critical_failures": []}
        if rows is not None:
            rows.write.parquet(f"{folder}/rows")
            rows = self.spark.read.parquet(f"{folder}/rows")
            quarantine.save(quarantine.extract(normalize.drop_working(rows), run_id, F.col("source_file"), F.col("row_idx")), f"{self.root}/quarantine")
            normalize.audit(rows, ["source_file", "row_idx"], run_id).write.parquet(f"{folder}/audit")
            raw.write.parquet(f"{folder}/raw")
            raw = self.spark.read.parquet(f"{folder}/raw")
            states.state(rows, ["source_file"], raw).write.parquet(f"{folder}/metric_states")
            states.key_counts(rows, ["source_file"]).write.parquet(f"{folder}/key_counts")
            total = validate.gate(validate.report(rows, raw=raw)).first().asDict()
            per_file = [r.asDict() for r in validate.report(rows, ["source_file"], raw).orderBy("source_file").collect()]
            diffs = self.diffs(rows)
            verdict = {k: total[k] for k in ("acceptable", "critical_failures")}
        text = report.markdown(run_id, files, total, per_file, diffs)
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/report")
        state = {"run_id": run_id, "status": "dry_run", "at": datetime.now(timezone.utc).isoformat(), "files": files, "metrics": total, "golden": diffs, **verdict}
        self._write_state(folder, state)
        return self.commit(run_id) if commit else state

    def _move(self, run_id: str, to: str) -> dict:
        state, (_, folder) = self.state(run_id), self.find(run_id)
        target = f"{self.root}/{to}/{run_id}"
        fs, p = self._fs(target)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._fs(folder)[1], p):
            raise OSError(f"{folder} could not be moved to {target}")
        state["status"] = to
        self._write_state(target, state)
        return state

    def commit(self, run_id: str) -> dict:
        if self.find(run_id)[0] != "dry_run":
            raise FileNotFoundError(f"{run_id} is no dry run")
        state = self.state(run_id)
        if not state.get("acceptable"):
            raise ValueError(f"{run_id} does not pass the gate: {state.get('critical_failures')}")
        return self._move(run_id, "committed")

    def rollback(self, run_id: str) -> dict:
        if self.find(run_id)[0] != "committed":
            raise FileNotFoundError(f"{run_id} is not committed")
        return self._move(run_id, "rolled_back")

    def rows(self, run_id: str) -> DataFrame:
        """The run's rows without a reason."""
        return self.spark.read.parquet(f"{self.find(run_id)[1]}/rows").where("_quarantine_reason is null")

    def metrics(self, run_ids: list[str], by: list[str] | None = None) -> DataFrame:
        """The gate's row over several runs together (or by ``source_file``), from what each left behind: no row is read."""
        folders = [self.find(r)[1] for r in run_ids]
        read = lambda name: self.spark.read.parquet(*(f"{f}/{name}" for f in folders))
        return validate.gate(states.report(read("metric_states"), read("key_counts"), by))

    def reprocess(self, run_id: str, schema: str) -> dict:
        """Quarantined rows once more, as a run of their own that the gate never passes."""
        records = quarantine.listed(self.spark, f"{self.root}/quarantine", run_id)
        passing, failing = quarantine.reprocess(records, schema)
        new = new_run_id()
        folder = f"{self.root}/dry_run/{new}"
        again = passing.unionAll(failing)
        again.write.parquet(f"{folder}/all")  # normalised once; both sides are read from here
        again = self.spark.read.schema(again.schema).parquet(f"{folder}/all")
        again.where("_quarantine_reason is null").write.parquet(f"{folder}/rows")
        n = again.agg(F.count_if(F.col("_quarantine_reason").isNull()).alias("ok"), F.count("*").alias("all")).first()
        counts = {"now_pass": n["ok"], "still_fail": n["all"] - n["ok"]}
        self._write_state(folder, {"run_id": new, "status": "dry_run", "mode": "reprocess", "of": run_id, "acceptable": False, "critical_failures": ["reprocess"], **counts})
        return {"run_id": new, **counts}
