"""Entity-attribute-value reshaping.

An EAV table holds one row per (entity, attribute id, text value).  The
client extract reads longitude from attributes 881/901 and latitude from
882/902 of the same entity row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed attribute ids of the reference extract.
LONGITUDE_ATTRS = (881, 901)
LATITUDE_ATTRS = (882, 902)


def eav_pivot(eav: DataFrame, entity: str = "entity", attr: str = "attr_id",
              value: str = "value") -> DataFrame:
    """U02 in one pass: conditional aggregation per entity (one shuffle,
    partial aggregation)."""
    a = F.col(attr)
    return eav.groupBy(entity).agg(
        F.max(F.when(a.isin(*LONGITUDE_ATTRS), F.col(value))).alias("LONGITUD"),
        F.max(F.when(a.isin(*LATITUDE_ATTRS), F.col(value))).alias("LATITUD"))


def eav_self_join(eav: DataFrame, entity: str = "entity", attr: str = "attr_id",
                  value: str = "value") -> DataFrame:
    """The SQL form - the EAV table joined with itself, one side per
    attribute set (inner, so entities lacking either attribute drop out and
    entities with two ids of one set multiply, as in the reference)."""
    lg = eav.where(F.col(attr).isin(*LONGITUDE_ATTRS)).select(
        F.col(entity).alias("_e"), F.col(value).alias("LONGITUD"))
    lt = eav.where(F.col(attr).isin(*LATITUDE_ATTRS)).select(
        F.col(entity).alias("_e2"), F.col(value).alias("LATITUD"))
    return (lg.join(lt, F.col("_e") == F.col("_e2"), "inner")
            .select(F.col("_e").alias(entity), "LONGITUD", "LATITUD"))


def case_key_join(eav: DataFrame, attrs: DataFrame, wanted=LONGITUDE_ATTRS,
                  attr: str = "attr_id", attrs_id: str = "attr_rowid",
                  also=()) -> DataFrame:
    """Join on ``CASE WHEN id IN (wanted) THEN id ELSE 0 END = attr``
    (plus the equi-key pairs ``also``, e.g. the owning entity).

    Still an equi-join on an expression key.  Attribute rows outside
    ``wanted`` carry key 0, so they meet EAV rows whose attribute id is 0
    (the reference's behaviour, kept); with the entity among the keys that
    fan-out stays within one entity's attribute list. No other id of an EAV row
    can equal the key, so the filter on these reaches the scan."""
    eav = eav.where(F.col(attr).isin(0, *wanted))
    key = F.when(F.col(attrs_id).isin(*wanted), F.col(attrs_id)).otherwise(F.lit(0))
    a = attrs.withColumn("_key", key)
    cond = eav[attr] == a["_key"]
    for left, right in also:
        cond = cond & (eav[left] == a[right])
    return eav.join(a, cond, "inner").drop("_key")
