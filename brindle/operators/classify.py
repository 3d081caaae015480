"""Forms by weighted signals, in one plan over all files and sheets."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle import config
from brindle.functions import text as t

#: The window at a sheet's top left, markers that a stage row needs, what a review costs.
ROWS, COLUMNS, MARKERS, REVIEW = 12, 14, 4, 0.7


def sheet_features(cells: DataFrame) -> DataFrame:
    """Of cell rows (file_path, sheet_idx, sheet_name, row_idx, cells): a row a sheet with sheets, max_row, max_col and
    the texts of its top-left window."""
    window = F.when(F.col("row_idx") <= ROWS, F.filter(F.transform(F.slice("cells", 1, COLUMNS), t.ustrip), lambda c: c.isNotNull() & (c != "")))
    return cells.groupBy("file_path", "sheet_idx", "sheet_name").agg(F.array(F.lower(F.col("sheet_name"))).alias("sheets"), F.max("row_idx").alias("max_row"), F.max(F.size("cells")).alias("max_col"), F.flatten(F.collect_list(window)).alias("cells"))


def file_features(sheets: DataFrame) -> DataFrame:
    return sheets.groupBy("file_path").agg(F.collect_set(F.lower("sheet_name")).alias("sheets"), F.max("max_col").alias("max_col"), F.flatten(F.collect_list("cells")).alias("cells"))


def matches(kind: str, what: Any, whole_file: bool = True) -> Column:
    """A signal on columns sheets (lower case), max_col and cells."""
    lower = F.transform("cells", F.lower)
    if kind == "sheet_exists":
        return F.array_contains("sheets", what.lower()) if whole_file else F.lit(False)
    if kind == "sheet_name_contains":
        return F.exists("sheets", lambda s: _any(s, what))
    if kind == "col_count_range":
        return F.col("max_col").between(*what)
    if kind == "header_text_contains":
        return F.exists(lower, lambda c: _any(c, what))
    if kind == "marker_cell":
        return F.array_contains(lower, what.lower())
    if kind == "stage_row":
        return F.size(F.array_intersect("cells", F.array(*map(F.lit, what)))) >= MARKERS
    raise ValueError(f"unknown signal {kind!r}")


def _any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w.lower()))
    return out


def decide(features: DataFrame, signals: dict[str, list] | None = None, threshold: float | dict[str, float] = config.FORM_THRESHOLD, whole_file: bool = True) -> DataFrame:
    """Adds evidence (form -> score), form_version, confidence, needs_review. The best of the forms over the threshold,
    the first listed among equals; with more than one over it the confidence shrinks and a review is due."""
    signals = signals or config.SIGNALS
    scores = [F.round(sum((F.when(F.coalesce(matches(k, w, whole_file), F.lit(False)), x).otherwise(0.0) for k, w, x in s), F.lit(0.0)), 4) for s in signals.values()]
    bound = lambda name: F.lit(float(threshold.get(name, config.FORM_THRESHOLD) if isinstance(threshold, dict) else threshold))
    entries = F.array(*(F.struct(s.alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name"), (s >= bound(name)).alias("passes")) for i, (name, s) in enumerate(zip(signals, scores))))
    df = features.withColumn("_scores", entries)
    df = df.withColumn("_passed", F.filter("_scores", lambda x: x["passes"])).withColumn("_best", F.array_max("_passed"))
    review = F.size("_passed") >= 2
    return df.withColumns(
        {
            "evidence": F.map_from_entries(F.transform("_scores", lambda x: F.struct(x["name"], x["score"]))),
            "form_version": F.coalesce("_best.name", F.lit("unknown")),
            "confidence": F.round(F.coalesce(F.when(review, F.col("_best.score") * REVIEW).otherwise(F.col("_best.score")), F.lit(0.0)), 4),
            "needs_review": review,
        }
    ).drop("_scores", "_passed", "_best")


def classify(cells: DataFrame, signals: dict[str, list] | None = None, threshold: float | dict[str, float] = config.FORM_THRESHOLD) -> DataFrame:
    """A row a file. ``signals`` and ``threshold`` (by form, or one) as ``config.load_signatures`` gives them. Where the
    file as a whole is unknown, its known sheets vote; the first sheet decides among equals, and the confidence is the
    best of all sheets."""
    sheets = sheet_features(cells)
    by_sheet = decide(sheets.select("file_path", "sheet_idx", "sheet_name", "sheets", "max_col", "cells"), signals, threshold, whole_file=False)
    by_file = decide(file_features(sheets), signals, threshold)
    votes = by_sheet.where("form_version != 'unknown'").groupBy("file_path", "form_version").agg(F.count("*").alias("n"), F.min("sheet_idx").alias("first"))
    votes = votes.groupBy("file_path").agg(F.max_by("form_version", F.struct("n", -F.col("first"))).alias("vote"))
    best = by_sheet.groupBy("file_path").agg(F.max("confidence").alias("best"), F.map_from_entries(F.collect_list(F.struct("sheet_name", "form_version"))).alias("per_sheet"))
    out = by_file.join(best, "file_path").join(votes, "file_path", "left")
    voted = (F.col("form_version") == "unknown") & F.col("vote").isNotNull()
    return out.select("file_path", F.when(voted, F.col("vote")).otherwise(F.col("form_version")).alias("form_version"), F.when(voted, F.col("best")).otherwise(F.col("confidence")).alias("confidence"), "needs_review", "evidence", "per_sheet")


def guess(sheets: Column, max_col: Column) -> Column:
    """The form by shape alone."""
    # fixed values: bounds of the columns
    return F.when(F.exists(sheets, lambda s: F.lower(s) == "history") & max_col.between(45, 75), "v1.2").when(max_col >= 80, "96col").when(max_col >= 45, "56col").when(max_col >= 1, "20col").otherwise("unknown")


def name_hints(c: Column) -> Column:
    """Struct of model, grade, region and date found in a file's or sheet's name; nulls where there is none."""
    # fixed values: the patterns of the four hints
    found = lambda p, g=0: F.nullif(F.regexp_extract(c, p, g), F.lit(""))
    date = r"(20\d{2})[._\-]?(\d{1,2})[._\-]?(\d{1,2})?"
    two = lambda g: F.lpad(found(date, g), 2, "0")
    return F.struct(found(r"[A-Z]{2,5}\d{4,5}[A-Z]?").alias("model"), found(r"(?i)(Best|Better|Good)[\-\s]?\d").alias("grade"), found(r"\b(" + "|".join(config.HINT_REGIONS) + r")\b").alias("region"), F.when(found(date).isNotNull(), F.concat_ws("-", found(date, 1), two(2), two(3))).alias("date"))
