"""Shapes of JSON values: what each part must hold, and the faults of a value that doesn't fit.

A JSON schema given to ``from_json`` turns a number into a string and a bad number into null. Here the value is read as
VARIANT, so each part is judged by the kind it really has. Everything is a column expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

FAULTS = "array<struct<fault:string,field:string>>"
MISSING, WRONG, UNKNOWN = "missing", "wrong_type", "unknown_key"


@dataclass(frozen=True)
class Shape:
    """A kind (string, whole, list, map, record) with what it holds. ``closed`` records have no other keys; of string, ``values`` are all that may be."""

    kind: str
    of: Shape | None = None
    fields: dict[str, Shape] = field(default_factory=dict)
    values: tuple[str, ...] = ()
    required: bool = False
    nullable: bool = False
    closed: bool = False


def string(required: bool = False, nullable: bool = False, values: list[str] | None = None) -> Shape:
    return Shape("string", required=required, nullable=nullable, values=tuple(values or ()))


def whole(required: bool = False, nullable: bool = False) -> Shape:
    """A whole number that an int holds, also written as 7.0, "7" or true."""
    return Shape("whole", required=required, nullable=nullable)


def many(of: Shape, required: bool = False) -> Shape:
    return Shape("list", of, required=required)


def mapping(of: Shape) -> Shape:
    return Shape("map", of)


def record(fields: dict[str, Shape], closed: bool = False, required: bool = False, nullable: bool = False) -> Shape:
    return Shape("record", fields=fields, closed=closed, required=required, nullable=nullable)


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), make), 1)


def faults(v: Column, shape: Shape, path: Column | None = None) -> Column:
    """An array of (fault, field) of a variant that is there; fields are paths such as ``related.0.target``, empty for the value itself."""
    none = F.array().cast(FAULTS)
    one = lambda fault, p: F.array(F.struct(F.lit(fault).alias("fault"), p.alias("field")))
    here = F.lit("") if path is None else path
    below = lambda name: name if path is None else F.concat(path, F.lit("."), name)
    kind = F.schema_of_variant(v)
    if shape.kind == "string":
        good, inner = kind == "STRING", none
        if shape.values:
            good = good & v.cast("string").isin(list(shape.values))
    elif shape.kind == "whole":
        digits = v.try_cast("string").rlike(r"^\s*[+-]?\d+(\.0*)?\s*$") & ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT")
        good, inner = (digits | (kind == "BOOLEAN")) & v.try_cast("int").isNotNull(), none
    elif shape.kind == "list":
        good, inner = kind.startswith("ARRAY"), F.flatten(F.transform(v.try_cast("array<variant>"), lambda x, i: faults(x, shape.of, below(i.cast("string")))))
    elif shape.kind == "map":
        entries = F.map_entries(v.try_cast("map<string,variant>"))
        good, inner = kind.startswith("OBJECT"), F.flatten(F.transform(entries, lambda e: faults(e["value"], shape.of, below(e["key"]))))
    else:
        parts = []
        for name, own in shape.fields.items():
            child, place = F.try_variant_get(v, f"$.{name}", "variant"), below(F.lit(name))
            absent = one(MISSING, place) if own.required else none
            parts.append(bound(child, _unless_absent(absent, own, place)))
        if shape.closed:
            known = F.array(*[F.lit(n) for n in shape.fields])
            parts.append(F.transform(F.array_except(F.map_keys(v.try_cast("map<string,variant>")), known), lambda k: F.struct(F.lit(UNKNOWN).alias("fault"), below(k).alias("field"))))
        good, inner = kind.startswith("OBJECT"), F.concat(*parts)
    found = F.when(F.coalesce(good, F.lit(False)), inner).otherwise(one(WRONG, here))
    return F.when(kind == "VOID", none).otherwise(found) if shape.nullable else found


def _unless_absent(absent: Column, shape: Shape, place: Column) -> Callable[[Column], Column]:
    return lambda x: F.when(x.isNull(), absent).otherwise(faults(x, shape, place))


def of_kind(found: Column, fault: str) -> Column:
    """The fields that have one fault, in order."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda f: f["fault"] == fault), lambda f: f["field"])))
