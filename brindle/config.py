"""Forms, mapping rules, normalisation steps and value rules, as plain data. Loaders take the same shapes from YAML."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

#: The canonical fields.
FIELDS = ("base_part_no", "new_part_no", "part_name", "bom_level", "part_type", "change_type", "change_point", "change_reason", "qty", "model_code")
#: The three null vocabularies' tokens, vocabularies with aliases, ranges and value patterns.
NULL_TOKENS = ("", "n/a", "na", "null", "none", "-", "—")
CHANGE_TYPES = ("New", "Change", "Carry-over")
CHANGE_ALIASES = {"신규": "New", "N": "New", "변경": "Change", "C": "Change", "유지": "Carry-over", "K": "Carry-over", "Keep": "Carry-over", "carryover": "Carry-over"}
GRADES = ("Best-1", "Best-2", "Better-1", "Better-2", "Good-1", "Good-2", "Good-1 BK", "Good-2 BK")
GRADE_ALIASES = {"Best1": "Best-1", "B1": "Best-1", "Best2": "Best-2", "B2": "Best-2", "Better1": "Better-1", "Better2": "Better-2", "Good1": "Good-1", "Good2": "Good-2"}
REGIONS = ("EUR", "EUE", "EAP", "SJ", "SA", "AU")
HINT_REGIONS = ("EUR", "EUE", "EAP", "SJ", "SA")
STAGES = ("CP", "PP", "DV", "PV", "PQ")
PART_NO = r"^[A-Z]{2,3}[0-9]{7,8}\z"
MODEL_CODE = r"^[A-Z][A-Z0-9]{3,14}(\.[A-Z0-9.]+)?\z"
MODEL_PARTS = r"^([A-Z]{2,5}[0-9]{3,5}[A-Z]?)(?:\.([A-Z0-9]+))?\z"
BOM_LEVEL, QTY = (0, 10), (0, 9999)
VOCABULARIES = {"change_type": (CHANGE_TYPES, CHANGE_ALIASES), "grade": (GRADES, GRADE_ALIASES)}

#: Fields that a row must have, those it may have, and the gate's bounds.
REQUIRED = ("base_part_no", "part_name", "bom_level", "part_type", "change_type", "change_point", "model_code")
OPTIONAL = ("new_part_no", "change_reason", "qty")
THRESHOLDS = {
    "column_match": (">=", 1.0),
    "type_match": (">=", 1.0),
    "value_format_match": (">=", 0.98),
    "referential_integrity": (">=", 0.95),
    "row_preservation": (">=", 0.95),
    "null_rate_required": ("<=", 0.01),
    "axiom_violation_rate": ("<=", 0.02),
}


@dataclass(frozen=True)
class FieldRule:
    """Sources in order of priority, transformations, and constraints."""

    sources: tuple[str, ...]
    transformations: tuple[dict[str, Any], ...] = ()
    required: bool = False
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class MappingRule:
    form_version: str
    header_row: int
    include: tuple[str, ...]
    exclude: tuple[str, ...]
    fields: dict[str, FieldRule] = field(default_factory=dict)


def step(spec: str | dict[str, Any]) -> dict[str, Any]:
    return {"type": spec} if isinstance(spec, str) else dict(spec)


def rule_from(data: dict[str, Any]) -> MappingRule:
    """From the mapping form: fields with ``sources`` (names, or {column_name, priority}), ``transformations`` and so on."""
    fields = {}
    for name, spec in data["mappings"].items():
        named = [(s, i) if isinstance(s, str) else (s["column_name"], s.get("priority", i)) for i, s in enumerate(spec["sources"])]
        fields[name] = FieldRule(tuple(s for s, _ in sorted(named, key=lambda x: x[1])), tuple(map(step, spec.get("transformations", ()))), bool(spec.get("required")), tuple(spec.get("allowed", ())))
    some = data.get("sheet_filter", {})
    return MappingRule(str(data["form_version"]), int(data["header_row"]), tuple(some.get("include_patterns", ())), tuple(some.get("exclude_patterns", ())), fields)


def load_rule(path: str) -> MappingRule:
    import yaml

    with open(path, encoding="utf-8") as f:
        return rule_from(yaml.safe_load(f))


def load_normalization(path: str) -> dict[str, dict[str, Any]]:
    """Rules by name from ``fields``: steps, post_validate, on_fail."""
    import yaml

    with open(path, encoding="utf-8") as f:
        fields = yaml.safe_load(f)["fields"]
    return {name: {k: v for k, v in {"steps": [step(s) for s in rule.get("steps", ())], "post_validate": rule.get("post_validate"), "on_fail": rule.get("on_fail", "quarantine")}.items() if v is not None} for name, rule in fields.items()}


def load_signatures(path: str) -> tuple[dict[str, list[tuple[str, Any, float]]], dict[str, float]]:
    """(signals by form, thresholds by form) from ``versions``, in the file's order, which decides ties."""
    import yaml

    with open(path, encoding="utf-8") as f:
        versions = yaml.safe_load(f)["versions"]
    what = {"sheet_exists": lambda s: s["name"], "sheet_name_contains": lambda s: list(s["keywords"]), "col_count_range": lambda s: tuple(s["range"]), "header_text_contains": lambda s: list(s["keywords"]), "marker_cell": lambda s: s["value"], "stage_row": lambda s: list(s["markers"])}
    signals = {name: [(s["type"], what[s["type"]](s), float(s["weight"])) for s in form.get("signals", ())] for name, form in versions.items()}
    return signals, {name: float(form.get("threshold", FORM_THRESHOLD)) for name, form in versions.items()}


def load_axioms(path: str) -> dict[str, Any]:
    """Value rules by key: ``pattern``, or ``allowed`` with ``aliases``, or ``min`` and ``max``."""
    import yaml

    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f)
    return {k: {n: tuple(v) if isinstance(v, list) else v for n, v in rule.items() if n in ("pattern", "allowed", "aliases", "min", "max", "regions")} for k, rule in found.items() if isinstance(rule, dict)}


#: Transformations by field, and the source columns of each form in order of priority.
TRANSFORMATIONS: dict[str, list] = {
    "base_part_no": ["strip", "upper"],
    "new_part_no": ["strip", "upper"],
    "part_name": ["strip"],
    "bom_level": [{"type": "cast", "to": "int"}],
    "part_type": ["strip"],
    "change_type": ["strip", {"type": "map_alias", "field": "change_type"}],
    "change_point": ["strip"],
    "change_reason": ["strip"],
    "qty": [{"type": "cast", "to": "float"}],
    "model_code": ["strip", "upper"],
}
GRADED = ("부품등급", "부품인정")
FORMS: dict[str, dict[str, Any]] = {
    "v1_2": {
        "header_row": 2,
        "include": [".*"],
        "exclude": ["History", "Cover", "Index"],
        "required": ["base_part_no", "part_name", "bom_level", "part_type", "change_type", "change_point", "model_code"],
        "sources": {
            "base_part_no": ["Base P/No"],
            "new_part_no": ["New P/No"],
            "part_name": ["Class Desc.", "Part Name"],
            "bom_level": ["BOM Level"],
            "part_type": ["Part Type"],
            "change_type": ["구분"],
            "change_point": ["변경점"],
            "change_reason": ["변경사유"],
            "qty": ["Qty"],
            "model_code": ["Model Code", "Base Model"],
        },
    },
    "96col": {
        "header_row": 9,
        "include": ["변경 부품", "변경부품", "Change.*Part", "Better.*", "Best.*"],
        "exclude": [*GRADED, "History", "Cover", "Index", "심의회"],
        "required": ["base_part_no", "part_name", "bom_level", "change_type", "change_point", "model_code"],
        "allowed": {"change_type": CHANGE_TYPES},
        "sources": {
            "base_part_no": ["Base P/No", "P/no."],
            "new_part_no": ["New P/No"],
            "part_name": ["Class Desc.(Part Name)", "Class Desc.", "부품명"],
            "bom_level": ["BOM Level", "Lvl", "Level"],
            "part_type": ["Part Type"],
            "change_type": ["구분", "Classification"],
            "change_point": ["변경점", "Changing Point", "Change Point"],
            "change_reason": ["변경사유", "Changing Reason"],
            "qty": ["Qty", "Quantity", "Quanty"],
            "model_code": ["Model Code", "Base Model", "Model", "_meta_model_code"],
        },
    },
    "56col": {
        "header_row": 7,
        "include": ["Better.*", "Best.*", "Good.*"],
        "exclude": ["History", "Cover", "Master", *GRADED],
        "required": ["base_part_no", "part_name", "model_code"],
        "sources": {
            "base_part_no": ["Base P/No", "Part No."],
            "new_part_no": ["New P/No"],
            "part_name": ["Class Desc.(Part Name)", "Class Desc.", "Part Name"],
            "bom_level": ["Level", "BOM Level", "Lvl"],
            "part_type": ["Part Type"],
            "change_type": ["Classification", "구분"],
            "change_point": ["Changing Point", "변경점"],
            "change_reason": ["Changing Reason", "변경사유"],
            "qty": ["Qty", "Quantity"],
            "model_code": ["Base Model", "Model Code", "_meta_model_code"],
        },
    },
    "20col": {
        "header_row": 9,
        "include": [".*"],
        "exclude": [*GRADED, "History", "Cover", "Index", "심의회"],
        "required": ["base_part_no"],
        "sources": {
            "base_part_no": ["Base P/No", "P/no."],
            "new_part_no": ["New P/No"],
            "part_name": ["Class Desc.(Part Name)", "Class Desc.", "Part Name"],
            "bom_level": ["BOM Level", "Lvl", "Level"],
            "part_type": ["Part Type", "Type"],
            "change_type": ["구분", "Classification"],
            "change_point": ["변경점", "Changing Point"],
            "change_reason": ["변경사유", "Changing Reason"],
            "qty": ["Qty", "Quantity", "Quanty"],
            "model_code": ["Model Code", "Base Model", "_meta_model_code"],
        },
    },
}


def rule(form: str) -> MappingRule:
    f = FORMS[form]
    fields = {n: FieldRule(tuple(s), tuple(map(step, TRANSFORMATIONS[n])), n in f["required"], tuple(f.get("allowed", {}).get(n, ()))) for n, s in f["sources"].items()}
    return MappingRule(form, f["header_row"], tuple(f["include"]), tuple(f["exclude"]), fields)


#: Signals by form, in the order that decides ties: kind, what it looks for, weight.
FORM_THRESHOLD = 0.7
SIGNALS: dict[str, list[tuple[str, Any, float]]] = {
    "v1_2": [("sheet_exists", "History", 0.4), ("col_count_range", (45, 75), 0.3), ("header_text_contains", ["Common", "FMEA", "HSMS"], 0.3)],
    "96col": [("col_count_range", (80, 110), 0.4), ("marker_cell", "aaaa", 0.3), ("stage_row", list(STAGES), 0.3)],
    "56col": [("col_count_range", (45, 79), 0.5), ("sheet_name_contains", ["Better", "Best", "Good"], 0.5)],
    "20col": [("col_count_range", (18, 35), 0.6), ("header_text_contains", ["Base P/No", "P/no.", "Part Name", "Set P/No"], 0.4)],
    "bom_tree": [("sheet_name_contains", ["ag-grid"], 0.5), ("header_text_contains", ["Lvl", "Check Out", "I.S", "ModelECO"], 0.5)],
}

_TEXT = ["unicode_normalize", "strip", "collapse_whitespace"]
#: Steps of each normalisation rule, the validator after them, and what a failing step does.
NORMALIZATION: dict[str, dict[str, Any]] = {
    "part_no": {"steps": ["unicode_normalize", "strip", "upper", {"type": "regex_remove", "pattern": r"[\s\-_]"}], "post_validate": "part_no", "on_fail": "quarantine"},
    "model_code": {"steps": ["unicode_normalize", "strip", "upper"], "post_validate": "model_code", "on_fail": "quarantine"},
    "bom_level": {"steps": [{"type": "cast", "to": "int"}, {"type": "range_check", "min": 0, "max": 10}], "on_fail": "quarantine"},
    "change_type": {"steps": ["strip", {"type": "map_alias", "field": "change_type"}], "on_fail": "quarantine"},
    "grade": {"steps": ["strip", {"type": "map_alias", "field": "grade"}], "on_fail": "quarantine"},
    "change_point": {"steps": [*_TEXT, {"type": "max_length", "value": 2000}], "on_fail": "truncate"},
    "change_reason": {"steps": [*_TEXT, {"type": "max_length", "value": 2000}], "on_fail": "truncate"},
    "part_name": {"steps": [*_TEXT, {"type": "max_length", "value": 200}], "on_fail": "truncate"},
    "part_type": {"steps": ["unicode_normalize", "strip"], "on_fail": "set_null"},
    "qty": {"steps": [{"type": "cast", "to": "float"}, {"type": "range_check", "min": 0, "max": 9999}], "on_fail": "quarantine"},
}
#: Which rule a column follows.
ROUTES = {"base_part_no": "part_no", "new_part_no": "part_no"} | {k: k for k in NORMALIZATION if k != "part_no"}
