"""Catalogued tables: partitioned, bucketed, published partition by partition.

A table is parquet files in a folder of its own (shared storage) with its
columns, partitions and buckets in the session's catalogue. Two tables bucketed
alike by a join's keys are joined without a shuffle; a key that is hot then
stays in its bucket, so bucket by keys that are known to be even, and leave the
others to plain tables, whose joins adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitwise.operators.ranking import materialize
from visitwise.operators.setops import apply_changes


def save_table(df: DataFrame, name: str, path: str, partition_by: list[str] | None = None,
               bucket_by: list[str] | None = None, buckets: int = 0) -> DataFrame:
    """Write ``df`` as the catalogued table ``name`` with its files under
    ``path``, replacing a table of that name. Rows are dealt to tasks as to
    buckets, so a bucket is one sorted file (a partition and bucket, if there
    are both)."""
    if bool(bucket_by) != bool(buckets):
        raise ValueError("buckets need columns and a number")
    w = (df.repartition(buckets, *bucket_by) if bucket_by else df).write.format("parquet").mode("overwrite").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def partitions_of(spark: SparkSession, name: str) -> list[str]:
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def replace_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions of ``name`` that ``df`` has rows of; the others
    stay. Columns by name."""
    spark = df.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def publish_changes(name: str, changes: DataFrame, partition: str) -> list:
    """Bring the table up to the new extract with the rows of
    ``operators.setops.snapshot_diff``: only partitions in which something
    changed are read and written; those left without rows are dropped. Returns
    the touched partition values (the driver sees one value per partition)."""
    spark = changes.sparkSession
    table = spark.table(name)
    touched = [r[0] for r in changes.select(partition).distinct().collect()]
    if not touched:
        return []
    mine = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        mine = mine | F.col(partition).isNull()
    # written aside first: a partition cannot be read while it is replaced
    after = materialize(apply_changes(table.where(mine), changes.select(*table.columns, "change", "copies")))
    left = {r[0] for r in after.select(partition).distinct().collect()}
    replace_partitions(after, name)
    for value in touched:
        if value not in left:
            text = "null" if value is None else "'" + str(value).replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition} = {text})")
            # an external table keeps the files of a dropped partition: they would come back with a repair
            _remove(spark, spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"],
                    f"{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    return sorted(touched, key=lambda v: (v is None, v))


def _remove(spark: SparkSession, location: str, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{location}/{folder}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
