"""Metrics over many runs from what each run left behind: states that add up, so that no row is read again.

A state is a row a group: counts, whether a column was there, reasons with their numbers, and a sketch of the keys. The
exact share of duplicates needs the runs' key counts (a row a distinct key of a run), which are summed by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import text as t
from brindle.operators import validate

#: Columns that make up a key; bits of the sketch's number of registers (its error is about 1.04 over their root).
KEY, SKETCH_BITS = ("base_part_no", "model_code"), 14
TYPED = {"bom_level": t.integer, "qty": t.number}
RANGES = {"qty": config.QTY, "bom_level": config.BOM_LEVEL}


def _names() -> dict[str, list[str]]:
    return {"present": list(config.FIELDS), "filled": list(config.FIELDS), "valid": list(validate.FORMATS), "untyped": list(TYPED), "outside": list(RANGES), "numbers": list(RANGES)}


def state(df: DataFrame, by: list[str] | None = None, raw: DataFrame | None = None) -> DataFrame:
    """A row a group. ``raw`` as in ``validate.metrics``: groups that lost all rows have a state, too."""
    by, have = by or [], set(df.columns)
    reason = F.col("_quarantine_reason") if "_quarantine_reason" in have else F.lit(None).cast("string")
    zero = F.lit(0).cast("long")

    def cell(kind: str, c: str) -> Column:
        if c not in have:
            return zero
        filled, number = ~t.blank(F.col(c)), t.number(F.col(c))
        return {
            "present": lambda: F.max(F.lit(1).cast("long")),
            "filled": lambda: F.count_if(filled),
            "valid": lambda: F.count_if(filled & validate.FORMATS[c](F.col(c))),
            "untyped": lambda: F.count_if(filled & TYPED[c](F.col(c)).isNull()),
            "outside": lambda: F.count_if(~number.between(*RANGES[c])),
            "numbers": lambda: F.count_if(number.isNotNull()),
        }[kind]()

    cells = [F.coalesce(cell(kind, c), zero).alias(f"{kind}_{c}") for kind, columns in _names().items() for c in columns]
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) if c in have else F.lit("\0") for c in KEY]
    found = df.groupBy(*by).agg(F.count("*").alias("kept"), F.count_if(reason.isNotNull()).alias("quarantined"), *cells, F.hll_sketch_agg(F.concat_ws("\1", *keys), F.lit(SKETCH_BITS)).alias("keys"))
    reasons = validate.drop_reasons(df, by).groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("reasons")) if "_quarantine_reason" in have else None
    if reasons is None:
        found = found.withColumn("reasons", F.lit(None).cast("map<string,long>"))
    elif by:
        left = reasons.select(*(F.col(c).alias(f"_{c}") for c in by), "reasons")
        found = found.join(left, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left").drop(*(f"_{c}" for c in by))
    else:
        found = found.join(reasons)  # one row each
    if raw is None:
        return found.withColumn("rows_in", F.col("kept"))
    read = raw.groupBy(*by).agg(F.coalesce(F.sum("rows_in"), zero).alias("rows_in"))
    if not by:
        return found.join(read)  # one row each
    return found.withColumn("rows_in", zero).unionByName(read, allowMissingColumns=True)  # states add up


def key_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, key columns, n): rows of each key, nulls being equal; columns that are not there are null."""
    have = df.select(*(by or []), *(F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in KEY if c not in (by or [])))
    return have.groupBy(*have.columns).agg(F.count("*").alias("n"))


def added(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The state of all: sums, and the union of the sketches."""
    by = by or []
    longs = [f.name for f in states.schema if f.dataType.simpleString() == "bigint" and f.name not in by]
    sums = [(F.max(c) if c.startswith("present_") else F.sum(c)).alias(c) for c in longs]
    keys = F.hll_union_agg("keys", F.lit(False)).alias("keys")
    out = states.groupBy(*by).agg(*sums, keys)
    each = states.where("reasons is not null").select(*by, F.explode("reasons").alias("reason", "n")).groupBy(*by, "reason").agg(F.sum("n").alias("n"))
    reasons = each.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("reasons"))
    if not by:
        return out.fillna(0, longs).join(reasons)  # one row each
    reasons = reasons.select(*(F.col(c).alias(f"_{c}") for c in by), "reasons")
    return out.fillna(0, longs).join(reasons, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left").drop(*(f"_{c}" for c in by))


def report(states: DataFrame, keys: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """What ``validate.report`` says of all rows together, from their states; ``duplicate_rate`` from the runs' key counts,
    or estimated from the sketches where these are not given."""
    by, s = by or [], added(states, by)
    total = lambda names: sum((F.col(n) for n in names), F.lit(0))
    there = lambda c: F.col(f"present_{c}") > 0

    def nulls(columns) -> Column:
        cells = sum((F.when(there(c), F.col("kept")).otherwise(0) for c in columns), F.lit(0))
        return validate.ratio(cells - total(f"filled_{c}" for c in columns), cells, 0.0)

    kinds = sum((F.when(there(c), 1).otherwise(0) for c in TYPED), F.lit(0))
    typed = sum((F.when(there(c) & (F.col(f"untyped_{c}") == 0), 1).otherwise(0) for c in TYPED), F.lit(0))
    formats = list(validate.FORMATS)
    out = s.select(
        *by,
        (sum((F.when(there(c), 1).otherwise(0) for c in config.FIELDS), F.lit(0)) / len(config.FIELDS)).alias("column_match"),
        validate.ratio(typed, kinds, 1.0).alias("type_match"),
        validate.ratio(total(f"valid_{c}" for c in formats), total(f"filled_{c}" for c in formats), 1.0).alias("value_format_match"),
        validate.ratio(F.col("valid_model_code"), F.col("filled_model_code"), 1.0).alias("referential_integrity"),
        validate.ratio(F.col("kept"), F.col("rows_in"), 1.0).alias("row_preservation"),
        nulls(config.REQUIRED).alias("null_rate_required"),
        nulls(config.OPTIONAL).alias("null_rate_optional"),
        validate.ratio(F.col("quarantined"), F.col("rows_in"), 0.0).alias("axiom_violation_rate"),
        validate.ratio(total(f"outside_{c}" for c in RANGES), total(f"numbers_{c}" for c in RANGES), 0.0).alias("outlier_rate"),
        "rows_in",
        (F.col("kept") - F.col("quarantined")).alias("rows_out"),
        F.col("quarantined").alias("rows_quarantined"),
        F.greatest(F.lit(0).cast("long"), F.col("rows_in") - F.col("kept")).alias("rows_dropped"),
        F.greatest(F.lit(0.0), validate.ratio(F.col("kept") - F.hll_sketch_estimate("keys"), F.col("kept"), 0.0)).alias("duplicate_rate"),
        F.col("reasons").alias("drop_reasons"),
    )
    if keys is None:
        return out
    names = [*by, *(c for c in KEY if c not in by)]
    once = keys.groupBy(*names).agg(F.sum("n").alias("n"))
    exact = once.groupBy(*(F.col(c).alias(f"_{c}") for c in by)).agg(validate.ratio(F.sum(F.col("n") - 1), F.sum("n"), 0.0).alias("_exact"))
    both = out.join(exact, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left") if by else out.join(exact)  # one row each
    return both.withColumn("duplicate_rate", F.coalesce("_exact", F.lit(0.0))).select(*out.columns)
