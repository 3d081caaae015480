"""Value rules as column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import text as t


def normalize_part_no(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"(?U)[\s\-_]", ""))


def in_vocabulary(field: str, c: Column) -> Column:
    """An allowed value as it is, an alias as what it stands for, else null. Case counts."""
    allowed, aliases = config.VOCABULARIES[field]
    c = t.ustrip(c)
    return F.when(c.isin(*allowed), c).otherwise(t.lookup(aliases, c))


def normalize_change_type(c: Column) -> Column:
    return in_vocabulary("change_type", c)


def normalize_grade(c: Column) -> Column:
    return in_vocabulary("grade", c)


def part_no(c: Column) -> Column:
    return F.coalesce(normalize_part_no(c.cast("string")).rlike(config.PART_NO), F.lit(False))


def model_code(c: Column) -> Column:
    return F.coalesce(F.upper(t.ustrip(c.cast("string"))).rlike(config.MODEL_CODE), F.lit(False))


def change_type(c: Column) -> Column:
    return normalize_change_type(c).isNotNull()


def grade(c: Column) -> Column:
    return normalize_grade(c).isNotNull()


def event_stage(c: Column) -> Column:
    return F.coalesce(F.upper(t.ustrip(c)).isin(*config.STAGES), F.lit(False))


def bom_level(c: Column) -> Column:
    return F.coalesce(t.number(c).between(*config.BOM_LEVEL), F.lit(False))


VALIDATORS = {"part_no": part_no, "model_code": model_code, "change_type": change_type, "grade": grade, "event_stage": event_stage, "bom_level": bom_level}


def validate_rows(df: DataFrame) -> DataFrame:
    """Adds ``_schema_errors``: the answer schema's own rules. Part numbers are normalised, never rejected."""
    checks = [
        F.when(F.col("change_type").isNull() | ~change_type(F.col("change_type")), F.lit("change_type: unknown")),
        F.when(F.col("bom_level").isNull() | ~bom_level(F.col("bom_level")), F.lit("bom_level: out of range")),
    ]
    parts = {c: normalize_part_no(F.col(c)) for c in ("base_part_no", "new_part_no") if c in df.columns}
    return df.withColumns(parts).withColumn("_schema_errors", F.array_compact(F.array(*checks)))
