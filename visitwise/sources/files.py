"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan (column pruning and filter pushdown by Catalyst)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_csv_text(spark: SparkSession, path: str, columns: list[str] | None = None,
                  sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header, every column text (codes keep their zeros).

    With ``columns`` the header is replaced by those names (positions of the
    file), so names with blanks never reach the plan.
    """
    r = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
         .option("mode", "PERMISSIVE"))
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        return r.schema(schema).option("enforceSchema", True).csv(path)
    df = r.option("inferSchema", False).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with type inference (an extra pass over the file; codes
    become numbers - prefer ``read_csv_text`` and cast)."""
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def read_csv_latin1(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV in Latin-1 with an explicit delimiter."""
    return read_csv_text(spark, path, sep=sep, encoding="ISO-8859-1")


def read_csv_lossy(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """UTF-8 CSV whose undecodable bytes are dropped (the decoder puts
    U+FFFD in their place; it is removed from every text column)."""
    df = read_csv_text(spark, path, sep=sep)
    return df.select(*[F.regexp_replace(F.col(f"`{c}`"), "�", "").alias(c) for c in df.columns])


def read_landed_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A spreadsheet is landed once as CSV or parquet (no per-file
    parser in the job); this reads whichever was landed."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return read_csv_text(spark, path)


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small table from literals."""
    return spark.createDataFrame(rows, schema)
