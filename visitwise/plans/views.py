"""The SQL surface: views and SQL functions over the prepared inputs.

After :func:`create_views` the tables ``clients``, ``visits``, ``calendar`` and
``due_list`` can be queried by SQL, with CTEs, correlated subqueries, ``IN`` and
``EXISTS``; the functions are SQL expressions that Catalyst inlines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitwise.plans.route import due_list

#: name -> (parameters, result type, expression)
SQL_FUNCTIONS = {
    "visit_seconds": ("started TIMESTAMP_NTZ, ended TIMESTAMP_NTZ", "BIGINT",
                      "CAST(floor(timestampdiff(MICROSECOND, started, ended) / 1000000.0) AS BIGINT)"),
    "period_of": ("day DATE", "STRING", "date_format(day, 'yyyyMM')"),
    "month_end": ("day DATE", "BOOLEAN", "last_day(day) = day"),
}


def create_views(clients: DataFrame, calendar: DataFrame, visits: DataFrame) -> SparkSession:
    """Temporary views of prepared inputs, and temporary functions; both belong
    to the session and replace those of the same names."""
    spark = clients.sparkSession
    for name, df in (("clients", clients), ("calendar", calendar), ("visits", visits), ("due_list", due_list(clients, calendar))):
        df.createOrReplaceTempView(name)
    for name, (parameters, kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return spark
