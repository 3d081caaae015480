"""Merged metric states against the report on all rows together."""

import random

import pytest
from pyspark.sql import functions as F

from brindle.operators import states, validate

SCHEMA = "base_part_no string, new_part_no string, part_name string, bom_level string, part_type string, change_type string, change_point string, change_reason string, qty string, model_code string, _quarantine_reason string, grp string"


def made(n, seed):
    rng = random.Random(seed)
    some = lambda *v: rng.choice(v)
    return [(some(None, " ", "AB1234567", "AB1234568", "bad"), some(None, "CD1234567"), some("n", None), some("1", "11", "x", None), some("t", ""), some("New", "odd", None), "p", None, some("1", "99999", "-1", None, "nan"), some("WSED7667M.ABMQEUR", "W", None), some(None, "a: b;c: d", "c: e", ";"), some("g1", "g2", None)) for _ in range(n)]


def comparable(df, by):
    out = {}
    for r in df.collect():
        d = r.asDict()
        out[tuple(d.pop(c) for c in by)] = {k: (round(v, 9) if isinstance(v, float) else (v or None) if k == "drop_reasons" else v) for k, v in d.items()}
    return out


@pytest.mark.parametrize("by", [[], ["grp"]])
def test_merged_equals_union(spark, by):
    runs = [spark.createDataFrame(made(n, n), SCHEMA) for n in (40, 1, 25)]
    runs[2] = runs[2].drop("qty", "part_type")  # a run that lacks columns
    raws = [r.groupBy("grp").agg((F.count("*") + 3).alias("rows_in")) for r in runs]
    union, raw = runs[0], raws[0]
    for r, x in zip(runs[1:], raws[1:]):
        union, raw = union.unionByName(r, allowMissingColumns=True), raw.unionAll(x)
    left, keys = None, None
    for r, x in zip(runs, raws):
        s, k = states.state(r, by, x), states.key_counts(r, by)
        left, keys = (s, k) if left is None else (left.unionByName(s), keys.unionByName(k))
    want = comparable(validate.report(union, by, raw), by)
    got = comparable(states.report(left, keys, by), by)
    if by:  # the report joins its parts by equal names, so its null group has no duplicates and reasons
        for d in (want, got):
            d[(None,)].pop("duplicate_rate"), d[(None,)].pop("drop_reasons")
    assert got == want
    rough = comparable(states.report(left, None, by), by)
    exact = comparable(states.report(left, keys, by), by)
    assert all(abs(rough[g]["duplicate_rate"] - exact[g]["duplicate_rate"]) < 0.05 for g in exact)


def test_merge_in_parts(spark):
    """Adding up in two steps is adding up in one; an empty run changes nothing."""
    runs = [spark.createDataFrame(made(n, n), SCHEMA) for n in (20, 30, 10)]
    one, two, three = (states.state(r) for r in runs)
    empty = states.state(runs[0].limit(0))
    steps = states.added(one.unionByName(two)).unionByName(three.select(*one.columns), allowMissingColumns=True).unionByName(empty)
    assert comparable(states.report(steps), []) == comparable(states.report(one.unionByName(two).unionByName(three)), [])
