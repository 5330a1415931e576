"""Relational sources.

Connection settings come from arguments or the environment
(``VISITWISE_JDBC_URL``, ``VISITWISE_JDBC_USER``, ``VISITWISE_JDBC_PASSWORD``);
nothing is hard-coded.  A failing read raises: the job stops and the last
published output stays as it was (no silent reuse of stale files).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def _options(url: str | None, user: str | None, password: str | None) -> dict:
    opts = {"url": url or os.environ.get("VISITWISE_JDBC_URL", "")}
    u = user or os.environ.get("VISITWISE_JDBC_USER")
    p = password or os.environ.get("VISITWISE_JDBC_PASSWORD")
    if u:
        opts["user"] = u
    if p:
        opts["password"] = p
    if not opts["url"]:
        raise ValueError("no JDBC url given (argument or VISITWISE_JDBC_URL)")
    return opts


def read_query(spark: SparkSession, sql: str, url: str | None = None, user: str | None = None,
               password: str | None = None, fetchsize: int = 10000) -> DataFrame:
    """Run one query on the server and load the result.

    A ``query`` read is one connection; use :func:`read_table` for large
    tables so that the read is split over ``num_partitions`` connections.
    """
    return (spark.read.format("jdbc").options(**_options(url, user, password))
            .option("query", sql).option("fetchsize", fetchsize).load())


def read_table(spark: SparkSession, table: str, partition_column: str, lower: int, upper: int,
               num_partitions: int, url: str | None = None, user: str | None = None,
               password: str | None = None) -> DataFrame:
    """S01 at scale: a table read in ``num_partitions`` ranges of a numeric
    column, so the extract joins (Q01, Q02) run in Spark on all executors."""
    return (spark.read.format("jdbc").options(**_options(url, user, password))
            .option("dbtable", table).option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", num_partitions).load())


# Payment-method lookup (defined in the reference, never executed there).
PAYMENT_METHODS_COLUMNS = {"F025_ID_CIA": "CIA", "F025_ID": "COD_MED_PAGO",
                           "F025_DESCRIPCION": "DES_MED_PAGO"}


def payment_methods(table_df: DataFrame) -> DataFrame:
    """Rename projection of the payment-method table."""
    return table_df.selectExpr(*[f"{k} AS {v}" for k, v in PAYMENT_METHODS_COLUMNS.items()])
