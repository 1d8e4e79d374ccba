"""Surrogate keys and string normalisation (JVM-side expressions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must match the behaviour being reproduced) --------------
# Key delimiter placed between the rendered key columns before hashing.
KEY_DELIMITER = "|"
# Accent folding map for normalised names: each character of ACCENTED is
# replaced by the character at the same position in UNACCENTED.
ACCENTED = "àâäéèêëïîôöûüçÀÂÄÉÈÊËÏÎÔÖÛÜÇ"
UNACCENTED = "aaaeeeeiioouucAAAEEEEIIOOUUC"
# Characters kept after folding; everything else is removed.
NORMALIZE_DROP_PATTERN = "[^A-Za-z0-9 ]"
# ---------------------------------------------------------------------------


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key_expr(cols: Sequence, null_token: str | None = None) -> Column:
    """``md5(concat_ws('|', cast(c1 as string), ...))``.

    ``concat_ws`` skips NULL inputs, so ``(NULL, 'a')`` and ``('a', NULL)``
    hash alike; pass ``null_token`` to render NULLs as an explicit token
    instead.  Timestamps render in the session time zone (pinned to UTC by
    :mod:`lakemart.session`).
    """
    parts = [_as_col(c).cast("string") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws(KEY_DELIMITER, *parts))


def surrogate_key(df: DataFrame, name: str, cols: Sequence[str],
                  null_token: str | None = None) -> DataFrame:
    """Add ``name`` as the first column, hashed from ``cols`` in that order."""
    rest = [c for c in df.columns if c != name]
    return df.select(surrogate_key_expr(cols, null_token).alias(name), *rest)


def normalize_expr(c) -> Column:
    """Accent-fold, drop non ``[A-Za-z0-9 ]`` characters, lower-case."""
    return F.lower(F.regexp_replace(F.translate(_as_col(c), ACCENTED, UNACCENTED),
                                    NORMALIZE_DROP_PATTERN, ""))


def normalize_str(df: DataFrame, col: str, out: str = "nrm_col") -> DataFrame:
    return df.withColumn(out, normalize_expr(col))
