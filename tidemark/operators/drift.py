"""Schema comparison: drift between a source and raw, and contracts of published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tidemark.specs import LINEAGE_COLUMNS, TableSpec


class SchemaDriftError(RuntimeError):
    """The source no longer fits raw; nothing was written."""


class ContractError(RuntimeError):
    """A model was built with other columns than it publishes."""


@dataclass(frozen=True)
class Drift:
    table_name: str
    kind: str
    column_name: str
    detail: str
    severity: str


def _types(schema: T.StructType) -> dict[str, str]:
    # typeName leaves out precision, so decimal(10,2) -> decimal(12,2) is not drift.
    return {f.name: f.dataType.typeName() for f in schema.fields if f.name not in LINEAGE_COLUMNS}


def detect(spec: TableSpec, source: T.StructType, raw: T.StructType) -> list[Drift]:
    """Added columns warn; missing and retyped columns are errors."""
    src, known = _types(source), _types(raw)
    added = [
        Drift(spec.name, "column_added", c, f"the source has a new {src[c]} column; it is not loaded", "warn")
        for c in sorted(src.keys() - known.keys())
    ]
    missing = [
        Drift(spec.name, "column_missing", c, "raw has this column, the source does not (renamed?)", "error")
        for c in sorted(known.keys() - src.keys())
    ]
    retyped = [
        Drift(spec.name, "type_changed", c, f"{src[c]} in the source, {known[c]} in raw", "error")
        for c in sorted(src.keys() & known.keys())
        if src[c] != known[c]
    ]
    return added + missing + retyped


def raise_on_error(found: list[Drift]) -> None:
    errors = [d for d in found if d.severity == "error"]
    if errors:
        raise SchemaDriftError(
            "; ".join(f"{d.table_name}.{d.column_name} {d.kind}: {d.detail}" for d in errors)
        )


def raw_projection(raw: T.StructType) -> list[str]:
    """The columns a load copies: what raw declares, in its order, without lineage."""
    return [f.name for f in raw.fields if f.name not in LINEAGE_COLUMNS]


def enforce_contract(declared: T.StructType, built: T.StructType, name: str) -> None:
    """Names in order first, then types."""
    if declared.names != built.names:
        raise ContractError(f"{name}: columns {built.names}, contract says {declared.names}")
    wrong = [
        f"{d.name} is {b.dataType.simpleString()}, contract says {d.dataType.simpleString()}"
        for d, b in zip(declared.fields, built.fields)
        if d.dataType != b.dataType
    ]
    if wrong:
        raise ContractError(f"{name}: " + "; ".join(wrong))
