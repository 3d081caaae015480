"""The answer schema: a canonical row with its groups, as a Spark type and as JSON Schema."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from brindle import config

#: Columns of the groups beside the canonical fields.
GROUPS = {
    "common": {"base_model": "string", "new_model": "string", "grade": "string", "buyer": "string", "production_date": "string"},
    "drbfm": {"concern": "string", "countermeasure": "string"},
    "part_cert": {"grade_decision": "string", "dev_status": "string"},
    "hsms": {"hazard_status": "string"},
    "mold": {"mold_no": "string", "cavity": "int"},
}
ORIGIN = {"source_file": "string", "form_version": "string", "extracted_at": "timestamp", "run_id": "string"}
_KINDS = {"string": ("string", T.StringType()), "int": ("integer", T.IntegerType()), "double": ("number", T.DoubleType()), "timestamp": ("string", T.TimestampType())}
_FIELD_KINDS = {"bom_level": "int", "qty": "double"}


def row_type() -> T.StructType:
    """The Spark type of a canonical row; fields that it may lack are nullable."""
    fields = [T.StructField(f, _KINDS[_FIELD_KINDS.get(f, "string")][1], f in config.OPTIONAL) for f in config.FIELDS]
    groups = [T.StructField(g, T.StructType([T.StructField(c, _KINDS[k][1]) for c, k in columns.items()])) for g, columns in GROUPS.items()]
    return T.StructType([*fields, *groups, *(T.StructField(c, _KINDS[k][1], k == "timestamp") for c, k in ORIGIN.items())])


def _of(kind: T.DataType, nullable: bool) -> dict[str, Any]:
    if isinstance(kind, T.StructType):
        plain: dict[str, Any] = json_object(kind)
    else:
        name = next(n for n, k in _KINDS.values() if k == kind)
        plain = {"type": name} | ({"format": "date-time"} if isinstance(kind, T.TimestampType) else {})
    return {"anyOf": [plain, {"type": "null"}]} if nullable and not isinstance(kind, T.StructType) else plain


def json_object(kind: T.StructType) -> dict[str, Any]:
    required = [f.name for f in kind.fields if not f.nullable]
    return {"type": "object", "properties": {f.name: _of(f.dataType, f.nullable) for f in kind.fields}} | ({"required": required} if required else {})


def json_schema() -> dict[str, Any]:
    out = {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": "canonical row"} | json_object(row_type())
    low, high = config.BOM_LEVEL
    out["properties"]["bom_level"] |= {"minimum": low, "maximum": high}
    return out


def export(path: str) -> None:
    Path(path).write_text(json.dumps(json_schema(), ensure_ascii=False, indent=1), encoding="utf-8")
