"""JSON of any shape as VARIANT values: schema inference as one aggregate, and
a schema-directed walk that finds what a schema does not hold."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "array<struct<key:string,value:string>>"


def _settled(t: T.DataType) -> T.DataType:
    """A column type for an inferred one: decimals are doubles; values of
    several types, or null only, are strings."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in t.fields]) if t.fields else T.StringType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType))
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(t, (T.NullType, T.VariantType)) else t


def infer_lines(lines: DataFrame, value_col: str = "value") -> T.StructType:
    """The schema of JSON lines: an aggregate of VARIANT schemas, merged
    partially in every task.  Lines that are no JSON object say nothing."""
    v = lines.select(F.try_parse_json(value_col).alias("v")).filter(F.schema_of_variant("v").startswith("OBJECT<"))
    text = v.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if not text or not text.startswith("OBJECT<"):
        return T.StructType([])
    # field names are quoted where needed, so the keyword is changed outside backticks only
    ddl = "".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in re.split(r"(`(?:[^`]|``)*`)", text))
    return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in T.DataType.fromDDL(ddl).fields])


def _text(v: Column) -> Column:
    """A value as text: strings as they are, objects and arrays as JSON."""
    return F.try_variant_get(v, "$", "string")


def _step(name: Column) -> Column:
    """A path step; names that look like paths are quoted."""
    return F.when(name.rlike(r"[.\[]"), F.concat(F.lit("`"), name, F.lit("`"))).otherwise(name)


def unfit(v: Column, typed: Column, kind: T.DataType, path: Column | None = None) -> Column:
    """``(key, value)`` of every path of the VARIANT ``v`` that the type
    ``kind`` does not know or whose value is lost in ``typed``, the same value
    parsed with that type.  Paths look like ``a.b[2].c``; a container that
    does not fit at all is one path."""
    none = F.array().cast(RESCUED)

    def below(step: Column) -> Column:
        return step if path is None else F.concat(path, F.lit("."), step)

    def one(p: Column, x: Column) -> Column:
        return F.struct(p.alias("key"), _text(x).alias("value"))

    if isinstance(kind, T.StructType):
        fields = F.try_variant_get(v, "$", "map<string,variant>")
        known = F.array(*[F.lit(f.name) for f in kind.fields]).cast("array<string>")
        extra = F.transform(F.filter(F.map_entries(fields), lambda e: ~F.array_contains(known, e["key"])),
                            lambda e: one(below(_step(e["key"])), e["value"]))
        inner = F.concat(extra, *[unfit(F.try_element_at(fields, F.lit(f.name)), typed[f.name], f.dataType,
                                        below(_step(F.lit(f.name)))) for f in kind.fields])
    elif isinstance(kind, T.ArrayType):
        inner = F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: unfit(
            x, F.get(typed, i), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
    elif isinstance(kind, T.MapType):
        inner = F.flatten(F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), lambda e: unfit(
            e["value"], F.try_element_at(typed, e["key"]), kind.valueType, below(_step(e["key"])))))
    else:
        inner = none
    gone = none if path is None else F.array(one(path, v))
    return (F.when(v.isNull() | F.is_variant_null(v), none)
             .when(typed.isNull(), gone).otherwise(F.coalesce(inner, gone)))
