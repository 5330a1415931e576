"""Sales-visit compliance analytics on Spark.

Pure ``DataFrame -> DataFrame`` functions; nothing runs at import time.
Sub-packages:

* ``sources``   - readers and writers (parquet, CSV, JDBC, landed Excel)
* ``functions`` - column expressions (coordinates, durations, dates, text, codes)
* ``operators`` - multi-row operators (null-safe merge, skew-safe ranks and
  full-outer matching, calendar, grouping, EAV pivot)
* ``plans``     - the named pipelines (extract, prepare, route, unified,
  compliance) and the driver-table query registry
* ``streaming`` - incremental (available-now) run of the daily job over
  newly landed visit files
"""

__version__ = "0.1.0"
