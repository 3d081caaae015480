"""Command line over the same calls: ``python -m brindle.plans.cli COMMAND``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from brindle.operators import classify, quarantine, search
from brindle.plans import runs, schema, warehouse
from brindle.sources import xlsx

ROW = ", ".join(f"{c} {t}" for c, t in (("base_part_no", "string"), ("new_part_no", "string"), ("part_name", "string"), ("bom_level", "int"), ("part_type", "string"), ("change_type", "string"), ("change_point", "string"), ("change_reason", "string"), ("qty", "double"), ("model_code", "string")))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="brindle")
    p.add_argument("--root", default="warehouse")
    p.add_argument("--golden", help="folder of ground truth by file stem")
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in {"inventory": ["path"], "classify": ["path"], "preprocess": ["path"], "run": ["path"], "review": ["run_id"], "commit": ["run_id"], "rollback": ["run_id"], "quarantine-list": ["run_id"], "quarantine-reprocess": ["run_id"], "schema-export": ["path"], "embed": ["run_id"], "db-init": [], "db-vacuum": [], "db-rejected": ["run_id"], "db-load": ["run_id"], "db-rollback": ["run_id"], "db-status": [], "db-verify": ["run_id"], "search": ["query"]}.items():
        c = sub.add_parser(name)
        for a in args:
            c.add_argument(a)
        if name == "inventory":
            c.add_argument("--out", help="also write the inventory as parquet")
        if name == "run":
            c.add_argument("--commit", action="store_true")
        if name == "db-vacuum":
            c.add_argument("--grace", type=float, default=86_400.0, help="seconds that an unused version is kept")
        if name == "search":
            c.add_argument("--top-k", type=int, default=search.TOP_K)
            c.add_argument("--form-version")
    a = p.parse_args(argv)
    if a.command == "schema-export":
        return schema.export(a.path)
    spark = SparkSession.builder.getOrCreate()
    r, w = runs.Runs(spark, a.root, a.golden), warehouse.Warehouse(spark, f"{a.root}/db")
    shown = lambda x: print(json.dumps(x, default=str, ensure_ascii=False, indent=1))
    if a.command == "inventory":
        cells = xlsx.read_cells(spark, a.path).cache()
        found, failed = xlsx.inventory(spark, a.path, cells).cache(), xlsx.unreadable(cells)
        if a.out:
            found.write.parquet(a.out)
            failed.write.parquet(f"{a.out.rstrip('/')}_unreadable")
        failed.show(50, truncate=False)
        found.select("file_path", "guess").dropDuplicates(["file_path"]).groupBy("guess").count().orderBy("guess").show()
        found.show(20, truncate=False)
    elif a.command == "classify":
        forms = classify.classify(xlsx.read_cells(spark, a.path).where("sheet_name is not null")).cache()
        forms.show(truncate=False)
        forms.groupBy("form_version").count().orderBy("form_version").show()
    elif a.command == "preprocess":
        r.preview(a.path)[0].show(truncate=False)
    elif a.command == "run":
        shown(r.run(a.path, a.commit))
    elif a.command == "review":
        shown(r.state(a.run_id))
    elif a.command in ("commit", "rollback"):
        shown(getattr(r, a.command)(a.run_id))
    elif a.command == "quarantine-list":
        found = quarantine.listed(spark, f"{a.root}/quarantine", a.run_id)
        found.orderBy("source_file", "row_index").show(50, truncate=False)
        print(f"{max(0, found.count() - 50)} more")
    elif a.command == "quarantine-reprocess":
        shown(r.reprocess(a.run_id, ROW))
    elif a.command == "db-load":
        shown(w.load(r.rows(a.run_id).withColumn("row_index", F.col("row_idx")), a.run_id))
    elif a.command == "db-init":
        shown({"written": w.init()})
    elif a.command == "db-vacuum":
        shown({"deleted": w.vacuum(a.grace)})
    elif a.command == "db-rejected":
        w.rejected(a.run_id).show(50, truncate=False)
    elif a.command == "embed":
        shown({"embedded": w.update_embeddings(a.run_id)})
    elif a.command == "db-rollback":
        shown(w.rollback(a.run_id))
    elif a.command == "db-status":
        w.runs().show(truncate=False)
    elif a.command == "db-verify":
        shown(w.verify(a.run_id))
    elif a.command == "search":
        events = w.table("change_events")
        where = F.col("form_version") == a.form_version if a.form_version else None
        search.hybrid(events, a.query, search.hashed_vector(a.query), "event_id", "change_point", "change_point_embedding", a.top_k, where).show(truncate=False)


if __name__ == "__main__":
    main()
