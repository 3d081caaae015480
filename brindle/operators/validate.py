"""Fifteen metrics in one aggregation, and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import shared
from brindle.functions import text as t
from brindle.operators import axioms

FORMATS = {"base_part_no": axioms.part_no, "new_part_no": axioms.part_no, "model_code": axioms.model_code, "change_type": axioms.change_type}


def ratio(a: Column, b: Column, empty: float) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty))


def null_rate(columns: list[str]) -> Column:
    nulls = sum((F.count_if(t.blank(F.col(c))) for c in columns), F.lit(0))
    return ratio(nulls, F.count("*") * len(columns), 0.0) if columns else F.lit(0.0)


#: What a group has of which no row is left.
NOTHING = {"column_match": 0.0, "type_match": 1.0, "value_format_match": 1.0, "referential_integrity": 1.0, "null_rate_required": 0.0, "null_rate_optional": 0.0, "outlier_rate": 0.0, "rows_out": 0, "rows_quarantined": 0, "_kept": 0}


def metrics(df: DataFrame, by: list[str] | None = None, total: bool = False, raw: DataFrame | None = None) -> DataFrame:
    """One row a group: the metrics and counts; with ``total`` also the grand total, in the same pass by rollup.

    ``raw`` holds the rows read, as ``rows_in`` by group (several rows a group add up); without it the rows of ``df``
    count. Groups of ``raw`` that have lost all their rows have a row, too. ``rows_out`` are the rows without a reason,
    ``rows_dropped`` those read that ``df`` lacks. Ratios of nothing are 1 (0 for rates of faults).
    """
    by, have = by or [], set(df.columns)
    fields = [c for c in config.FIELDS if c in have]
    nonnull = {c: F.count_if(~t.blank(F.col(c))) for c in fields}
    formats = [c for c in FORMATS if c in have]
    valid = {c: F.count_if(~t.blank(F.col(c)) & FORMATS[c](F.col(c))) for c in formats}
    reason = F.col("_quarantine_reason") if "_quarantine_reason" in have else F.lit(None).cast("string")
    quarantined = F.count_if(reason.isNotNull())
    typed = [(t.integer, "bom_level"), (t.number, "qty")]
    kinds = [F.when(F.count_if(~t.blank(F.col(c)) & fn(F.col(c)).isNull()) == 0, 1).otherwise(0) for fn, c in typed if c in have]
    ranges = [(c, r) for c, r in (("qty", config.QTY), ("bom_level", config.BOM_LEVEL)) if c in have]
    out = sum((F.count_if(~t.number(F.col(c)).between(*r)) for c, r in ranges), F.lit(0))
    n_values = sum((F.count_if(t.number(F.col(c)).isNotNull()) for c, _ in ranges), F.lit(0))
    grouped = df.rollup(*by) if total and by else df.groupBy(*by)
    found = grouped.agg(
        F.lit(len(fields) / len(config.FIELDS)).alias("column_match"),
        (ratio(sum(kinds, F.lit(0)), F.lit(len(kinds)), 1.0) if kinds else F.lit(1.0)).alias("type_match"),
        ratio(sum(valid.values(), F.lit(0)), sum((nonnull[c] for c in formats), F.lit(0)), 1.0).alias("value_format_match"),
        (ratio(valid["model_code"], nonnull["model_code"], 1.0) if "model_code" in have else F.lit(1.0)).alias("referential_integrity"),
        null_rate([c for c in config.REQUIRED if c in have]).alias("null_rate_required"),
        null_rate([c for c in config.OPTIONAL if c in have]).alias("null_rate_optional"),
        ratio(out, n_values, 0.0).alias("outlier_rate"),
        F.count("*").alias("_kept"),
        (F.count("*") - quarantined).alias("rows_out"),
        quarantined.alias("rows_quarantined"),
    )
    if raw is None:
        found = found.withColumn("rows_in", F.col("_kept"))
    else:
        read = (raw.rollup(*by) if total and by else raw.groupBy(*by)).agg(F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"))
        if by:
            read = read.select(*(F.col(c).alias(f"_{c}") for c in by), "rows_in")
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
            found = found.join(read, same, "full_outer").withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in by}).drop(*(f"_{c}" for c in by))
            found = found.fillna(NOTHING | {"rows_in": 0})
        else:
            found = found.join(read)  # one row each
    found = found.withColumns({"row_preservation": ratio(F.col("_kept"), F.col("rows_in"), 1.0), "axiom_violation_rate": ratio(F.col("rows_quarantined"), F.col("rows_in"), 0.0), "rows_dropped": F.greatest(F.lit(0).cast("long"), F.col("rows_in") - F.col("_kept"))})
    names = ("column_match", "type_match", "value_format_match", "referential_integrity", "row_preservation", "null_rate_required", "null_rate_optional", "axiom_violation_rate", "outlier_rate", "rows_in", "rows_out", "rows_quarantined", "rows_dropped")
    return found.select(*by, *names)


def duplicate_rate(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows that repeat a key seen before, over all rows; null keys are equal. Counted by key, without a window."""
    by = by or []
    counts = df.groupBy(*by, *(k for k in keys if k not in by)).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(ratio(F.sum(F.col("n") - 1), F.sum("n"), 0.0).alias("duplicate_rate"))


def drop_reasons(df: DataFrame, by: list[str] | None = None, reason: str = "_quarantine_reason") -> DataFrame:
    """Rows (reason, n): of each part of the reasons, what stands before the first colon."""
    by = by or []
    parts = df.where(F.col(reason).isNotNull()).select(*by, F.explode(F.split(reason, ";")).alias("part"))
    named = parts.select(*by, t.ustrip(F.substring_index("part", ":", 1)).alias("reason")).where("reason != ''")
    return named.groupBy(*by, "reason").agg(F.count("*").alias("n"))


def top_reasons(df: DataFrame, by: list[str], n: int = 8) -> DataFrame:
    """Reasons by group, of the ``n`` reasons that are most frequent over all groups: rows (by, reason, n)."""
    counts = shared.staged(drop_reasons(df, by), "reasons")  # read twice, the rows once
    most = counts.groupBy("reason").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "reason").limit(n)
    return counts.join(F.broadcast(most.select("reason")), "reason", "left_semi").select(*by, "reason", "n")


def report(df: DataFrame, by: list[str] | None = None, raw: DataFrame | None = None) -> DataFrame:
    """``metrics`` with duplicate_rate and drop_reasons (a map)."""
    by = by or []
    out = metrics(df, by, raw=raw)
    keys = [k for k in ("base_part_no", "model_code") if k in df.columns]
    dup = duplicate_rate(df, keys, by) if keys else None
    reasons = drop_reasons(df, by).groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("drop_reasons"))
    for part in (dup, reasons):
        if part is not None:
            out = out.join(part, by, "left") if by else out.join(part, how="left")  # without groups each side is one row
    return out


def gate(df: DataFrame) -> DataFrame:
    """Adds critical_failures (names, in order) and acceptable."""
    fails = [F.when((F.col(k) < v) if op == ">=" else (F.col(k) > v), F.lit(k)) for k, (op, v) in config.THRESHOLDS.items()]
    return df.withColumn("critical_failures", F.array_compact(F.array(*fails))).withColumn("acceptable", F.size("critical_failures") == 0)


def coverage(df: DataFrame, by: list[str]) -> DataFrame:
    """Share of present values of each canonical field, by group."""
    return df.groupBy(*by).agg(*(F.avg((~t.blank(F.col(c))).cast("int")).alias(c) for c in config.FIELDS if c in df.columns and c not in by))


def orphans(df: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key has no parent: integrity in earnest, beside the format metric."""
    return df.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
