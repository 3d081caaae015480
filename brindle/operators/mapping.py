"""Mapping rules compiled to one projection: the canonical fields and the reasons against a row."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import text as t

TYPES = {"bom_level": "int", "qty": "double"}


def pick_source(columns: list[str], sources: tuple[str, ...]) -> str | None:
    """The first source that is a column, trimmed white space aside. By column, not by row."""
    named: dict[str, str] = {}
    for c in columns:
        named.setdefault(" ".join(c.split()), c)
    return next((named[s] for s in sources if s in named), None)


def transform(c: Column, spec: dict[str, Any]) -> Column:
    kind = spec["type"]
    if kind == "strip":
        return t.ustrip(c.cast("string"))
    if kind == "upper":
        return F.upper(c.cast("string"))
    if kind == "lower":
        return F.lower(c.cast("string"))
    if kind == "regex_remove":
        return F.regexp_replace(c.cast("string"), spec["pattern"], "")
    if kind == "cast":
        return {"int": t.integer, "float": t.number, "str": lambda x: x.cast("string")}[spec["to"]](c)
    if kind == "map_alias":
        aliases = config.VOCABULARIES[spec["field"]][1]
        return F.coalesce(t.lookup(aliases, t.ustrip(c)), c)
    raise ValueError(f"unknown transformation {kind!r}")


def apply_mapping(df: DataFrame, rule: config.MappingRule, keep: tuple[str, ...] = ("_source_sheet",)) -> DataFrame:
    """All fields of the rule, ``_quarantine_reason`` (null if clean), and of ``keep`` what is there.

    A required field without a source, or blank, gives a reason; so does a value that is not allowed. Reasons are a
    projection after the values, whose expressions they would hold several times.
    """
    values, reasons = [], []
    for name, f in rule.fields.items():
        source = pick_source(df.columns, f.sources)
        if source is None:
            value = F.lit(None).cast(TYPES.get(name, "string"))
            if f.required:
                reasons.append(F.lit(f"{name}: no source column"))
        else:
            raw = df[f"`{source}`"]
            value = F.when(~t.blank(raw), raw)
            for spec in f.transformations:
                value = transform(value, spec)
                if spec["type"] in ("strip", "regex_remove"):
                    value = F.when(value != "", value)
            done = F.col(name)
            if f.required:
                reasons.append(F.when(t.blank(done), F.lit(f"{name}: required empty")))
            if f.allowed:
                shown = F.concat(F.lit(f"{name}: '"), done.cast("string"), F.lit("' not in allowed"))
                reasons.append(F.when(~t.blank(done) & ~done.isin(*f.allowed), shown))
        values.append(value.alias(name))
    joined = F.concat_ws(";", *reasons) if reasons else F.lit("")
    kept = [c for c in keep if c in df.columns]
    mapped = df.select(*values, *(df[f"`{c}`"].alias(f"_kept_{i}") for i, c in enumerate(kept)))
    return mapped.select(*rule.fields, F.nullif(joined, F.lit("")).alias("_quarantine_reason"), *(F.col(f"_kept_{i}").alias(c) for i, c in enumerate(kept)))
