"""Semi-structured attributes: entity-attribute-value rows as one VARIANT per
entity, read back with types; attributes that no one has declared are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_variants(eav: DataFrame, entity: str = "entity", attr: str = "attr_id", value: str = "value",
                    out: str = "attributes") -> DataFrame:
    """One row per entity with its attributes as a VARIANT object: name ->
    text. Of an attribute's several values the largest counts. They are reduced
    to one first, with partial aggregation, so what is gathered per entity is
    bounded by the number of different attributes. Rows without an attribute
    are left out; an attribute without a value is a JSON null."""
    one = eav.where(F.col(attr).isNotNull()).groupBy(entity, F.col(attr).cast("string").alias("_a")).agg(F.max(value).cast("string").alias("_v"))
    pairs = one.groupBy(entity).agg(F.sort_array(F.collect_list(F.struct("_a", "_v"))).alias("_p"))
    text = F.to_json(F.map_from_entries("_p"), {"ignoreNullFields": "false"})
    return pairs.select(entity, F.parse_json(text).alias(out))


def typed(variant: str, fields: dict[str, tuple[str, str]]) -> list[Column]:
    """Columns (name -> (path, type)) read from a VARIANT; null where the path
    is missing or its value does not fit the type."""
    return [F.try_variant_get(F.col(variant), path, kind).alias(name) for name, (path, kind) in fields.items()]


def undeclared(variant: str, known: list[str]) -> Column:
    """The attributes outside ``known``, as a map of texts."""
    every = F.from_json(F.to_json(F.col(variant)), "map<string,string>")
    return F.map_filter(every, lambda k, _: ~k.isin(*known))


def variant_schema(df: DataFrame, variant: str) -> str:
    """The schema that all values of the column have in common."""
    return df.agg(F.schema_of_variant_agg(F.col(variant))).first()[0]
