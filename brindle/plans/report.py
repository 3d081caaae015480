"""A run's report as Markdown, from rows that are already aggregated: the verdict, then files, metrics and reasons."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from brindle import config


def table(head: Iterable[str], rows: Iterable[Iterable]) -> list[str]:
    line = lambda cells: "|" + "|".join(f" {c} " for c in cells) + "|"
    head = list(head)
    return [line(head), line("---" for _ in head), *map(line, rows), ""]


def gate_rows(row: dict) -> list[tuple[str, str, str, str]]:
    """(metric, value, bound, verdict) for each threshold of the gate."""
    held = {">=": lambda v, x: v >= x, "<=": lambda v, x: v <= x}
    return [(k, f"{row[k]:.4f}", f"{op} {x:g}", "ok" if held[op](row[k], x) else "missed") for k, (op, x) in config.THRESHOLDS.items()]


def by_count(counts: dict[str, int] | None, n: int | None = None) -> list[tuple[str, int]]:
    return sorted((counts or {}).items(), key=lambda x: (-x[1], x[0]))[:n]


def diff_line(diff: dict) -> str:
    return f"match_rate={diff['match_rate']:.3f} of ground truth: {diff['rows_match']} equal, {diff['rows_mismatch']} differ, {diff['rows_only_in_auto']} only here, {diff['rows_only_in_golden']} only there"


def markdown(run_id: str, files: list[dict], total: dict, per_file: list[dict], diffs: dict[str, dict] | None = None) -> str:
    """``diffs``: by source file, a row of ``diff.counts`` with ``columns``, the differing pairs by column."""
    missed = total.get("critical_failures") or []
    verdict = "passes the gate" if total.get("acceptable") else "does not pass the gate" + (f" ({', '.join(missed)})" if missed else "")
    out = [f"# Run {run_id}", "", f"The run {verdict}. Written {datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S} UTC.", ""]
    measured = {r["source_file"]: r for r in per_file}
    count = lambda f, k: measured.get(f["file_path"], {}).get(k, 0)
    out += ["## Files", "", *table(("file", "form", "status", "read", "clean", "set aside", "lost"), ((f["file_path"].rsplit("/", 1)[-1], f["form_version"], f["status"], *(count(f, k) for k in ("rows_in", "rows_out", "rows_quarantined", "rows_dropped"))) for f in files))]
    if total:
        out += ["## Gate", "", *table(("metric", "value", "bound", "verdict"), gate_rows(total))]
    for path, row in measured.items():
        diff, reasons = (diffs or {}).get(path), by_count(row.get("drop_reasons"))
        if not reasons and not diff:
            continue
        out += [f"## {path.rsplit('/', 1)[-1]}", ""]
        if reasons:
            out += table(("set aside for", "rows"), reasons)
        if diff:
            out += [diff_line(diff), ""]
            if diff.get("columns"):
                out += table(("column", "pairs that differ"), by_count(diff["columns"], 5))
    return "\n".join(out)
