"""Row filters, schema enforcement and range cleansing (narrow, no shuffle)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows whose business key has a NULL part."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def require_non_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is non-NULL and not ``''``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c) != F.lit(""))
    return df.filter(cond)


def live_rows(df: DataFrame, flag: str = "_is_delete") -> DataFrame:
    """Tri-state delete filter: keep ``flag`` false or NULL."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def deleted_rows(df: DataFrame, flag: str = "_is_delete") -> DataFrame:
    return df.filter(F.coalesce(F.col(flag), F.lit(False)))


def stamp(df: DataFrame, col: str = "_insert_update_ts") -> DataFrame:
    """Add or overwrite the run timestamp column."""
    return df.withColumn(col, F.current_timestamp())


def _safe_cast(c: Column, dtype: T.DataType) -> Column:
    # try_cast: with ANSI on a plain cast would fail the whole batch on one
    # bad value; here the value becomes NULL and the row is kept.
    return c.try_cast(dtype)


def enforce_schema(df: DataFrame, schema: T.StructType, extra: str = "drop",
                   extra_col: str = "_extra") -> DataFrame:
    """Cast to ``schema`` (bad values -> NULL) and close the column list.

    Columns missing from ``df`` are added as typed NULLs.  Columns not in
    the schema are dropped (``extra='drop'``) or packed into one JSON string
    column ``extra_col`` (``extra='pack'``).
    """
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in have:
            src = F.col(f.name)
            cur = df.schema[f.name].dataType
            out.append((src if cur == f.dataType else _safe_cast(src, f.dataType)).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    if extra == "pack":
        extras = [c for c in df.columns if c not in set(schema.fieldNames())]
        if extras:
            out.append(F.to_json(F.struct(*[F.col(c) for c in extras])).alias(extra_col))
        else:
            out.append(F.lit(None).cast("string").alias(extra_col))
    elif extra != "drop":
        raise ValueError("extra must be 'drop' or 'pack'")
    return df.select(*out)


def null_out_of_range(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """Set values outside the inclusive ``[lo, hi]`` range to NULL; the row
    is kept.  ``None`` as a bound means unbounded on that side."""
    repl = {}
    for c, (lo, hi) in bounds.items():
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col(c) < F.lit(lo))
        if hi is not None:
            bad = bad | (F.col(c) > F.lit(hi))
        repl[c] = F.when(bad, F.lit(None)).otherwise(F.col(c))
    return df.withColumns(repl)


def add_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Add boolean columns; a NULL predicate result becomes ``False``."""
    return df.withColumns({name: F.coalesce(pred, F.lit(False)) for name, pred in flags.items()})


# --- fixed values: telemetry cleansing rules --------------------------------
# Inclusive valid ranges; values outside become NULL.
TELEMETRY_RANGES = {
    "cargo_temp_c": (-273, 100),
    "engine_temp_c": (0, 200),
    "speed_kmh": (0, 180),
}
# Flag thresholds (strictly greater than).
SPEED_LIMIT_KMH = 120
ENGINE_OVERHEAT_C = 110
# -----------------------------------------------------------------------------

TELEMETRY_SCHEMA = T.StructType([
    T.StructField("cargo_temp_c", T.DoubleType()),
    T.StructField("engine_temp_c", T.DoubleType()),
    T.StructField("fuel_pct", T.DoubleType()),
    T.StructField("odometer_km", T.IntegerType()),
    T.StructField("reading_id", T.StringType()),
    T.StructField("reading_timestamp", T.TimestampType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("vehicle_status", T.StringType()),
])


def normalize_telemetry(df: DataFrame, key: str = "reading_id",
                        schema: T.StructType = TELEMETRY_SCHEMA,
                        ranges: Mapping[str, tuple] = TELEMETRY_RANGES) -> DataFrame:
    """Key filter, typed closed projection, out-of-range sensor values to NULL."""
    return (require_keys(df, [key])
            .transform(enforce_schema, schema)
            .transform(null_out_of_range, ranges))


def enrich_telemetry(df: DataFrame, speed: str = "speed_kmh", engine: str = "engine_temp_c",
                     cargo: str = "cargo_temp_c", ts: str = "reading_timestamp") -> DataFrame:
    """Cold-chain / speeding / overheat flags (NULL -> false) and the date."""
    return (add_flags(df, {
        "is_cold_chain_cargo": F.col(cargo).isNotNull(),
        "speed_limit_exceed": F.col(speed) > F.lit(SPEED_LIMIT_KMH),
        "engine_overheat": F.col(engine) > F.lit(ENGINE_OVERHEAT_C),
    }).withColumn("reading_date", F.to_date(F.col(ts))))
