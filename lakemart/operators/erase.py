"""Right to erasure: remove an entity's rows from a dimension and from
every fact that references it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators.joins import bounded_broadcast


def erased_keys(dim: DataFrame, entities: DataFrame, natural_key: str, sk: str) -> DataFrame:
    """Surrogate keys of every dimension version of the erased entities
    (semi join: an entity with many versions yields each key once)."""
    return dim.join(entities.select(natural_key), natural_key, "left_semi").select(sk)


def erase(entities: DataFrame, dim: DataFrame, facts: Mapping[str, DataFrame],
          natural_key: str, sk: str, fact_natural_key: Mapping[str, str] | None = None,
          key_map: DataFrame | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Return ``(dim_without_entities, {name: fact_without_entities})``.

    A fact row goes when its surrogate key belongs to an erased entity, or
    -- when the fact also carries the natural key (``fact_natural_key``) --
    when that matches, which also catches rows whose surrogate key is NULL.
    ``key_map`` (natural key -> surrogate key, every version ever issued)
    defaults to ``dim``; pass the full history when the dimension no longer
    holds the deleted entity's versions.  Anti joins only; nothing is
    collected.
    """
    # erasure requests are few: keys broadcast under a bound, facts not shuffled
    sks = bounded_broadcast(erased_keys(key_map if key_map is not None else dim, entities,
                                        natural_key, sk).distinct())
    ents = bounded_broadcast(entities.select(natural_key).distinct())
    out = {}
    for name, f in facts.items():
        kept = f.join(sks, sk, "left_anti")
        nk = (fact_natural_key or {}).get(name)
        if nk:
            kept = kept.join(ents.select(F.col(natural_key).alias(nk)), nk, "left_anti")
        out[name] = kept
    dim_kept = dim.join(ents, natural_key, "left_anti")
    return dim_kept, out


def residue(entities: DataFrame, tables: Mapping[str, DataFrame], key_map: Mapping[str, str],
            natural_key: str) -> DataFrame:
    """``(table_name, remaining_rows)`` of erased entities per table -- all
    zero after a correct erasure."""
    parts = []
    for name, df in tables.items():
        k = key_map[name]
        hit = df.join(entities.select(F.col(natural_key).alias(k)), k, "left_semi")
        parts.append(hit.agg(F.count(F.lit(1)).alias("remaining_rows"))
                        .select(F.lit(name).alias("table_name"), "remaining_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
