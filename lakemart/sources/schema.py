"""Schema evolution and drift bookkeeping (driver-side metadata only --
schemas and column lists, never data rows)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def evolve_schema(known: T.StructType, incoming: T.StructType, nested: bool = False) -> T.StructType:
    """Known fields (types unchanged) plus incoming fields not yet known,
    appended in arrival order -- new columns are added, never dropped.  With
    ``nested`` the fields of structs, also within arrays, grow the same way."""
    if nested:
        came = {f.name: f.dataType for f in incoming.fields}
        known = T.StructType([T.StructField(f.name, _grown(f.dataType, came[f.name]) if f.name in came else f.dataType,
                                            f.nullable) for f in known.fields])
    names = set(known.fieldNames())
    added = [f for f in incoming.fields if f.name not in names]
    return T.StructType(list(known.fields) + [T.StructField(f.name, f.dataType, True) for f in added])


def _grown(known: T.DataType, incoming: T.DataType) -> T.DataType:
    if isinstance(known, T.StructType) and isinstance(incoming, T.StructType):
        return evolve_schema(known, incoming, nested=True)
    if isinstance(known, T.ArrayType) and isinstance(incoming, T.ArrayType):
        return T.ArrayType(_grown(known.elementType, incoming.elementType), known.containsNull)
    return known


def field_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """The dotted paths of all fields, those below structs and arrays included."""
    out = []
    for f in schema.fields:
        kind = f.dataType
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        out.append(prefix + f.name)
        if isinstance(kind, T.StructType):
            out += field_paths(kind, f"{prefix}{f.name}.")
    return out


def detect_drift(known: Sequence[str] | T.StructType, incoming: Sequence[str] | T.StructType
                 ) -> tuple[list[str], str]:
    """``(new_columns, action)``; action is ``"none"`` or a description of
    the columns added."""
    k = known.fieldNames() if isinstance(known, T.StructType) else list(known)
    i = incoming.fieldNames() if isinstance(incoming, T.StructType) else list(incoming)
    new = [c for c in i if c not in set(k)]
    if not new:
        return [], "none"
    return new, "added column " + ", ".join(f"'{c}'" for c in new)


def schema_to_json(schema: T.StructType) -> str:
    return schema.json()


def schema_from_json(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def drift_state(audit: DataFrame, source_col: str = "source", order: Sequence[str] = ("run_ts", "batch_id"),
                columns_col: str = "active_extra_columns") -> DataFrame:
    """Latest ``active_extra_columns`` per source, as an array of names.

    A per-source top-1 over the audit history (partial window-group limit,
    so the audit table may be long)."""
    w = Window.partitionBy(source_col).orderBy(*[F.col(c).desc() for c in order])
    latest = (audit.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
                   .drop("_rn"))
    cols = F.filter(F.split(F.coalesce(F.col(columns_col), F.lit("")), ","), lambda x: x != "")
    return latest.select(source_col, cols.alias("extra_columns"))


def store_schema(spark, schema: T.StructType, path: str) -> None:
    """Append a schema to the versions below ``path`` (works on any shared
    filesystem the cluster can write; no driver-side file I/O).  Earlier
    versions stay, so a write that stops half-way loses none."""
    latest = _latest(spark, path)
    spark.createDataFrame([(latest[0] + 1 if latest else 0, schema.json())], "version long, schema string").coalesce(1) \
        .write.mode("append").json(path)


def _latest(spark, path: str) -> tuple[int, str] | None:
    from pyspark.errors import AnalysisException
    try:
        versions = spark.read.schema("version long, schema string").json(path)
    except AnalysisException:
        return None
    row = versions.orderBy(F.desc("version")).first()
    return (row[0], row[1]) if row else None


def load_schema(spark, path: str) -> T.StructType | None:
    """The last stored schema, or None when nothing was stored yet."""
    latest = _latest(spark, path)
    return schema_from_json(latest[1]) if latest else None


def infer_json_schema(spark, path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Schema of the JSON files under ``path`` inferred by Spark's reader
    (``samplingRatio`` bounds the inference scan on large landings)."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path).schema


def evolve_stored_schema(spark, landing: str, schema_path: str, base: T.StructType,
                         sampling_ratio: float = 1.0) -> tuple[T.StructType, str]:
    """Schema on arrival, new columns added:
    start from the stored schema (or ``base``), add any field the landing
    files now carry, store the result, and return ``(schema, drift_action)``.
    Known fields keep their types; unknown values of a known field go to
    the rescued-data column at parse time."""
    known = load_schema(spark, schema_path) or base
    inferred = infer_json_schema(spark, landing, sampling_ratio)
    new, action = detect_drift(known, inferred)
    evolved = evolve_schema(known, T.StructType([f for f in inferred.fields if f.name in set(new)]))
    store_schema(spark, evolved, schema_path)
    return evolved, action
