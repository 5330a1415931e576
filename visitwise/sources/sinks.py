"""Writers (S03, S10-S15).

The export of the unified table (Q10): a total order, an exact balanced
split into ``n`` contiguous parts (``ntile`` semantics without a
single-task window), and a ``;``-separated Latin-1 CSV per part written in
parallel (``partitionBy``).  At month end the same parts also replace the
``period=yyyyMM`` partition of a second folder; other months stay.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitwise.functions.durations import timedelta_text
from visitwise.functions.text import latin1_safe
from visitwise.operators.ranking import balanced_buckets


def publish(write, spark: SparkSession, path: str) -> None:
    """Replace the folder ``path`` by what ``write(folder)`` writes.

    The new output goes to a folder beside it first. Only when that is complete
    are the two swapped by renames, so a failed write leaves the published
    output as it was. If the second rename fails, the old folder is put back.
    """
    path = path.rstrip("/")
    new = f"{path}.new-{uuid.uuid4().hex}"
    fs = _file_system(spark, path)
    try:
        write(new)
    except Exception:
        fs.delete(_path(spark, new), True)
        raise
    _swap(spark, new, path, f"{path}.old-{uuid.uuid4().hex}")


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, new: str, path: str, aside: str) -> None:
    """Rename the folder ``new`` to ``path``; what stood there goes by way of ``aside``."""
    fs = _file_system(spark, path)
    fresh, target, old = (_path(spark, p) for p in (new, path, aside))
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(fresh, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot publish {path}")
    if had:
        fs.delete(old, True)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the target as a whole (see :func:`publish`)."""
    def write(folder: str) -> None:
        df.write.partitionBy(*(partition_by or [])).parquet(folder)

    publish(write, df.sparkSession, path)


def _csv_writer(df: DataFrame, sep: str, partition_by: list[str] | None, encoding: str):
    w = (df.write.option("header", True).option("sep", sep)
         .option("encoding", encoding).option("emptyValue", "").option("nullValue", "")
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
         .option("dateFormat", "yyyy-MM-dd"))
    return w.partitionBy(*partition_by) if partition_by else w


def write_csv(df: DataFrame, path: str, sep: str = ",", partition_by: list[str] | None = None,
              encoding: str = "UTF-8") -> None:
    """CSV with a header (no row index: it is not data); replaces the
    target as a whole."""
    publish(_csv_writer(df, sep, partition_by, encoding).csv, df.sparkSession, path)


def add_partitions_csv(df: DataFrame, path: str, sep: str, partition_by: list[str], encoding: str) -> None:
    """Replace the partitions of the first column of ``partition_by`` that
    ``df`` holds; the others stay.

    All rows are written beside ``path`` first. Then one partition after the
    other is swapped, as a whole, by renames, so a failed write leaves what was
    published, and a partition written anew with fewer parts keeps none of its
    old ones. Between swaps some partitions are new and some old, each complete.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    tag = uuid.uuid4().hex
    staged = f"{path}.new-{tag}"
    fs = _file_system(spark, path)
    try:
        _csv_writer(df, sep, partition_by, encoding).csv(staged)
        fs.mkdirs(_path(spark, path))
        for status in fs.listStatus(_path(spark, staged)):
            name = status.getPath().getName()
            if name.startswith(f"{partition_by[0]}="):
                _swap(spark, f"{staged}/{name}", f"{path}/{name}", f"{path}.old-{tag}")
    finally:
        fs.delete(_path(spark, staged), True)


def latin1_frame(df: DataFrame) -> DataFrame:
    """Drop characters Latin-1 cannot hold from every text column."""
    return df.select(*[latin1_safe(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
                       for c, t in df.dtypes])


def check_latin1(df: DataFrame) -> DataFrame:
    """Strict Latin-1 - the write fails on a character out of range.

    The check sits inside each written text column (a separate check
    column would be pruned by the optimizer and never run)."""
    out = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        if t == "string":
            col = F.when(col.rlike(r"[^\x{00}-\x{FF}]"),
                         F.raise_error(F.lit(f"character outside Latin-1 in {c}"))).otherwise(col)
        out.append(col.alias(c))
    return df.select(*out)


def compat_columns(df: DataFrame) -> DataFrame:
    """Reference text forms at the sink: timedelta text, ranks as ``1.0``,
    the visit latitude under its original header."""
    out = df
    if "TimeDifference" in df.columns:
        out = out.withColumn("TimeDifference", timedelta_text("TimeDifference"))
    for c in ("Flag_Time", "Flag_Distance"):
        if c in df.columns:
            out = out.withColumn(c, F.col(c).cast("double"))
    if "Latitud_Visita" in df.columns:
        out = out.withColumnRenamed("Latitud_Visita", "Latitud")
    return out


def split_parts(df: DataFrame, order, n: int = 3, col: str = "part", row_id: str | None = None) -> DataFrame:
    """Exact balanced contiguous split (first ``rows mod n`` parts
    one row longer). With ``row_id`` only the order's columns are sorted."""
    return balanced_buckets(df, order, n, col, row_id)


def export_unified(result: DataFrame, order, path: str, n_parts: int = 3,
                   as_of: _dt.date | None = None, by_month_path: str | None = None,
                   row_id: str | None = None) -> DataFrame:
    """Q10: split into ``n_parts`` and write ``;`` Latin-1 CSV per part.

    ``as_of`` replaces the reference's clock; when it is the last day of its
    month the parts are also written under ``period=yyyyMM`` (S14).
    ``row_id`` names a unique column that breaks ties and is not written.
    Returns the split frame.
    """
    parts = split_parts(result, order, n_parts, "part", row_id)
    parts = parts.drop(row_id) if row_id else parts
    # rows keep their global order inside each part (sorted by position)
    # (part, row) order satisfies the writer's own sort on the partition column,
    # so no extra sort reorders rows inside a part
    body = compat_columns(latin1_frame(parts.drop("_nrows"))).sortWithinPartitions("part", "_row").drop("_row")
    write_csv(body, path, sep=";", partition_by=["part"], encoding="ISO-8859-1")
    if as_of is not None and by_month_path and (as_of + _dt.timedelta(days=1)).day == 1:
        period = as_of.strftime("%Y%m")
        add_partitions_csv(body.withColumn("period", F.lit(period)), by_month_path, ";", ["period", "part"],
                           "ISO-8859-1")
    return parts
