"""Step pipelines compiled to columns: value, reason, steps applied.

All columns take their steps side by side: a round is one projection that has the next value of each column, whether it
has failed, and the step's name. So expressions stay small however many steps a rule has, and what needs Python goes there
in one batch. A failed step under ``quarantine`` keeps the value as it was; ``truncate`` shortens or clamps; ``set_null``
ends with null. Failing validation after the steps is always a reason.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import text as t
from brindle.operators import axioms

#: step name -> (value, spec) -> (new value, whether it fails, error text, repaired value or None)
STEPS: dict[str, Any] = {}


def step(name: str):
    def add(fn):
        STEPS[name] = fn
        return fn

    return add


@step("strip")
def _(c: Column, spec: dict) -> tuple:
    return t.ustrip(c.cast("string"), spec.get("space", r"\s")), None, None, None


@step("upper")
def _(c: Column, _spec: dict) -> tuple:
    return F.upper(c.cast("string")), None, None, None


@step("lower")
def _(c: Column, _spec: dict) -> tuple:
    return F.lower(c.cast("string")), None, None, None


@step("unicode_normalize")
def _(c: Column, spec: dict) -> tuple:
    return t.unicode_normalize(c.cast("string"), spec.get("form", "NFKC")), None, None, None


@step("collapse_whitespace")
def _(c: Column, spec: dict) -> tuple:
    return t.collapse(c.cast("string"), spec.get("space", r"\s")), None, None, None


@step("regex_remove")
def _(c: Column, spec: dict) -> tuple:
    return F.regexp_replace(c.cast("string"), f"(?U){spec['pattern']}", ""), None, None, None


@step("max_length")
def _(c: Column, spec: dict) -> tuple:
    n = int(spec["value"])
    return c, F.length(c) > n, F.lit(f"longer than {n}"), F.substring(c, 1, n)


@step("cast")
def _(c: Column, spec: dict) -> tuple:
    value = {"int": t.integer, "float": t.number, "str": lambda x: x.cast("string")}[spec["to"]](c)
    return value, value.isNull() & c.isNotNull(), F.lit(f"not a {spec['to']}"), None


@step("range_check")
def _(c: Column, spec: dict) -> tuple:
    lo, hi = spec["min"], spec["max"]
    return c, ~c.cast("double").between(lo, hi), F.lit(f"not in {lo}..{hi}"), F.greatest(F.lit(lo), F.least(F.lit(hi), c))


@step("map_alias")
def _(c: Column, spec: dict) -> tuple:
    value = axioms.in_vocabulary(spec["field"], c.cast("string"))
    return value, value.isNull(), F.lit("unknown value"), None


def _round(column: str, spec: dict[str, Any], on_fail: str, stated: bool, label: str) -> dict[str, Column]:
    """The columns of a column's next state, and whether it has a failed state then. ``stated``: it has one now."""
    name, now = spec["type"], F.col(f"_v_{column}")
    failed = F.col(f"_failed_{column}") if stated else F.lit(False)
    value, bad, error, repaired = STEPS[name](now, spec)
    if bad is None:
        return {label: F.when(~failed & now.isNotNull(), F.lit(name)), f"_v_{column}": value}
    bad = F.coalesce(bad, F.lit(False)) & now.isNotNull()
    if on_fail == "set_null" or on_fail == "truncate" and repaired is not None:
        taken = F.when(now.isNotNull(), F.when(bad, F.lit(f"{name}({on_fail})")).otherwise(F.lit(name)))
        return {label: taken, f"_v_{column}": F.when(~bad, value) if on_fail == "set_null" else F.when(bad, repaired).otherwise(value)}
    fresh, told = bad & ~failed, F.concat(F.lit(f"{name}: "), error)
    return {
        label: F.when(~failed & ~bad & now.isNotNull(), F.lit(name)),
        f"_reason_{column}": F.coalesce(F.col(f"_reason_{column}"), F.when(fresh, told)) if stated else F.when(fresh, told),
        f"_kept_{column}": F.when(fresh, now.cast("string")).otherwise(F.col(f"_kept_{column}")) if stated else F.when(fresh, now.cast("string")),
        f"_failed_{column}": failed | bad,
        f"_v_{column}": F.when(~(failed | bad), value) if name in ("cast", "map_alias") else value,
    }


def normalize_fields(df: DataFrame, rules: dict[str, dict[str, Any]]) -> DataFrame:
    """``df`` with the columns of ``rules`` normalised, and ``_reason_``, ``_steps_`` and ``_before_<column>`` added. Words for
    nothing and blank values are null, but where a rule has ``nullish`` false."""
    steps = {c: list(map(config.step, rule["steps"])) for c, rule in rules.items()}
    if unknown := [s["type"] for some in steps.values() for s in some if s["type"] not in STEPS]:
        raise ValueError(f"unknown step {unknown[0]!r}")
    names = df.columns
    first = {c: F.when(~t.nullish(F.col(f"`{c}`")), F.col(f"`{c}`")) if rule.get("nullish", True) else F.col(f"`{c}`") for c, rule in rules.items()}
    df = df.withColumns({f"_v_{c}": v for c, v in first.items()} | {f"_before_{c}": v.cast("string") for c, v in first.items()})
    labels: dict[str, list[str]] = {c: [] for c in rules}
    stated: set[str] = set()
    for r in range(max(map(len, steps.values()), default=0)):
        new: dict[str, Column] = {}
        for c, rule in rules.items():
            if r < len(steps[c]):
                labels[c].append(f"_step{r}_{c}")
                new |= _round(c, steps[c][r], rule.get("on_fail", "quarantine"), c in stated, labels[c][-1])
        df = df.withColumns(new)
        stated |= {c for c in rules if f"_failed_{c}" in new}
    out: dict[str, Column] = {}
    extra: dict[str, Column] = {}
    for c, rule in rules.items():
        now = F.col(f"_v_{c}")
        reason = F.col(f"_reason_{c}") if c in stated else F.lit(None).cast("string")
        if rule.get("post_validate"):
            valid = axioms.VALIDATORS[rule["post_validate"]](now)
            reason = F.coalesce(reason, F.when(now.isNotNull() & ~valid, F.lit(f"post_validate: {rule['post_validate']}")))
        # a string column keeps the value at the failing step; a number that is none becomes null
        numeric = any(s.get("to") in ("int", "float") for s in steps[c])
        text = now.cast("string")
        out[c] = now if numeric else F.when(F.col(f"_failed_{c}"), F.col(f"_kept_{c}")).otherwise(text) if c in stated else text
        extra |= {f"_reason_{c}": reason, f"_steps_{c}": F.array_compact(F.array(*map(F.col, labels[c]))) if labels[c] else F.array().cast("array<string>"), f"_before_{c}": F.col(f"_before_{c}")}
    return df.select(*((out[c] if c in out else F.col(f"`{c}`")).alias(c) for c in names), *(v.alias(c) for c, v in extra.items()))


def normalize_field(df: DataFrame, column: str, rule: dict[str, Any]) -> DataFrame:
    """``normalize_fields`` of one column."""
    return normalize_fields(df, {column: rule})


def normalize(df: DataFrame, rules: dict[str, dict[str, Any]] | None = None, working: bool = True) -> DataFrame:
    """All columns that have a rule; ``_quarantine_reason`` gets "column: reason" for each failure, after what it had.
    Keeps ``_reason_*``, ``_steps_*`` and ``_before_*`` for ``audit``; ``drop_working`` removes them. Without ``working`` they are
    not even computed: what is dropped behind ``bound`` is."""
    rules = rules or config.NORMALIZATION
    done = [c for c in df.columns if config.ROUTES.get(c) in rules]
    df = normalize_fields(df, {c: rules[config.ROUTES[c]] for c in done})
    found = [F.concat(F.lit(f"{c}: "), F.col(f"_reason_{c}")) for c in done]
    before = [F.col("_quarantine_reason")] if "_quarantine_reason" in df.columns else []
    df = df.withColumn("_quarantine_reason", F.nullif(F.concat_ws(";", *before, *found), F.lit("")))
    return bound(df if working else drop_working(df))


def bound(df: DataFrame) -> DataFrame:
    """The same rows, computed once: a generator of one row, through which the optimizer pushes no filter. Without it a
    filter on the reason is copied, with all steps of all fields in it, into every projection below."""
    return df.select(F.inline(F.array(F.struct(*(F.col(f"`{c}`") for c in df.columns)))))


def drop_working(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(("_reason_", "_steps_", "_before_"))))


def failures(df: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each failed field: keys, field, reason."""
    done = [c[len("_reason_") :] for c in df.columns if c.startswith("_reason_")]
    items = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"_reason_{c}").alias("reason")) for c in done))
    return df.select(*keys, F.explode(F.filter(items, lambda x: x["reason"].isNotNull())).alias("x")).select(*keys, "x.*")


def audit(df: DataFrame, keys: list[str], run_id: str) -> DataFrame:
    """A row for each value that at least one step took: keys, run_id, stage, field, before, after, note."""
    done = [c[len("_steps_") :] for c in df.columns if c.startswith("_steps_")]
    items = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"_before_{c}").alias("before"), F.col(c).cast("string").alias("after"), F.array_join(F.col(f"_steps_{c}"), ",").alias("note")) for c in done))
    rows = df.select(*keys, F.explode(F.filter(items, lambda x: x["before"].isNotNull() & (x["note"] != ""))).alias("x"))
    return rows.select(*keys, F.lit(run_id).alias("run_id"), F.lit("normalize").alias("stage"), "x.*")
