"""From cell rows to tables: sheet filter, header, facts above the header, data rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import text as t

#: Labels of facts, cells that are labels too, rows and cells that are searched.
LABELS = {"base model": "model_code", "base model/suffix": "model_code", "base model / suffix": "model_code", "buyer명": "buyer", "brand": "brand", "set p/no.": "set_part_no", "set p/no": "set_part_no", "양산 일자": "production_date"}
ALSO_LABELS = ("모델명(등급)", "model name(grade)", "개발 모델", "new model", "event")
META_ROWS, META_CELLS = 8, 10


def sheet_passes(name: Column, rule: config.MappingRule) -> Column:
    """An exclude pattern found in the name wins; without include patterns all others pass."""
    found = lambda patterns: reduce(lambda a, b: a | b, (name.rlike(p) for p in patterns), F.lit(False))
    return ~found(rule.exclude) & (found(rule.include) if rule.include else F.lit(True))


def clean_model_code(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.regexp_extract(c, r"^[^/(\n]*", 0), r"(?U)\s+", ""))


def headers(cells: Column) -> Column:
    """White space collapsed; an empty header is named by its place; of equal ones only the first counts."""
    return F.transform(cells, lambda c, i: F.coalesce(F.nullif(t.ustrip(t.collapse(c)), F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))))


def meta(cells: DataFrame) -> DataFrame:
    """(file_path, sheet_idx, key, value): for each label in the first rows the next cell to its right that is neither
    blank nor a label. The first hit of a key wins."""
    folded = lambda c: F.lower(t.ustrip(t.collapse(c)))
    labels = [*LABELS, *ALSO_LABELS]
    rows = cells.where(F.col("row_idx") <= META_ROWS).select("file_path", "sheet_idx", "row_idx", "cells", F.posexplode("cells").alias("pos", "cell"))
    key = t.lookup(LABELS, folded(F.col("cell")))
    rows = rows.withColumn("key", key).where("key is not null")
    right = F.slice("cells", F.col("pos") + 2, F.lit(META_CELLS))
    value = F.get(F.filter(right, lambda c: ~t.blank(c) & ~folded(c).isin(*labels)), F.lit(0))
    hits = rows.withColumn("value", t.ustrip(value)).where("value is not null")
    return hits.groupBy("file_path", "sheet_idx", "key").agg(F.min_by("value", F.struct("row_idx", "pos")).alias("value"))


def rows(cells: DataFrame, rule: config.MappingRule) -> DataFrame:
    """(file_path, sheet_idx, row_idx, _source_sheet, values): data rows as maps from header to cell, facts as ``_meta_*``.

    A sheet shorter than its header row gives none; rows without any value are dropped; cells beyond the header too. Of
    several rows at the header's place that with the most cells filled is the header, so no data row comes twice.
    """
    some = cells.where(F.col("sheet_name").isNotNull() & sheet_passes(F.col("sheet_name"), rule))
    filled = F.size(F.filter("cells", lambda c: ~t.blank(c)))
    head = some.where(F.col("row_idx") == rule.header_row).groupBy("file_path", "sheet_idx").agg(F.max_by("cells", F.struct(filled, "cells")).alias("cells"))
    head = head.select("file_path", "sheet_idx", headers(F.col("cells")).alias("header"))
    facts = meta(some).withColumn("value", F.when(F.col("key") == "model_code", clean_model_code(F.col("value"))).otherwise(F.col("value")))
    facts = facts.groupBy("file_path", "sheet_idx").agg(F.collect_list(F.struct(F.concat(F.lit("_meta_"), "key").alias("key"), "value")).alias("facts"))
    data = some.where((F.col("row_idx") > rule.header_row) & F.exists("cells", lambda c: c.isNotNull()))
    data = data.join(head, ["file_path", "sheet_idx"]).join(facts, ["file_path", "sheet_idx"], "left")
    pairs = F.filter(F.transform("header", lambda h, i: F.struct(h.alias("key"), F.get(F.col("cells"), i).alias("value"), i.alias("i"))), lambda p: F.array_position(F.col("header"), p["key"]) == p["i"] + 1)
    plain = F.transform(pairs, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value")))
    none = F.array().cast("array<struct<key:string,value:string>>")
    return data.select("file_path", "sheet_idx", "row_idx", F.col("sheet_name").alias("_source_sheet"), F.map_from_entries(F.concat(plain, F.coalesce("facts", none))).alias("values"))


def table(extracted: DataFrame, rule: config.MappingRule, present: list[str]) -> DataFrame:
    """Columns of the rule's sources, as far as any sheet has them (``present``), beside the row's keys."""
    wanted = list(dict.fromkeys(s for f in rule.fields.values() for s in f.sources if s in present))
    return extracted.select("file_path", "sheet_idx", "row_idx", "_source_sheet", *(F.col("values")[s].alias(s) for s in wanted))


def present(extracted: DataFrame) -> list[str]:
    """Distinct headers: few, whatever the number of rows."""
    return [r["h"] for r in extracted.select(F.explode(F.map_keys("values")).alias("h")).distinct().collect()]
