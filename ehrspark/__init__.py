"""Clinical-record analytics on Spark.

Every operator takes and returns DataFrames (OMOP-shaped tables) and is built
from Spark SQL / DataFrame / Spark ML primitives. Subpackages:

* ``sources``   – table loads (parquet, CSV, JDBC), fixture views, sinks
* ``functions`` – column-level helpers (dates, code strings, math, joins)
* ``operators`` – code mapping, rankings, cohorts, drugs, statistics, labels,
  features and models
* ``plans``     – the named query catalogue and its DuckDB oracle SQL
* ``streaming`` – incremental (micro-batch) variants of the chunked scans
"""

__version__ = "0.1.0"
