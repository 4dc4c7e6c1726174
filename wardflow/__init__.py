"""wardflow – incremental, keyed, visit-shaped record loading on PySpark.

Sub-packages:

* ``functions`` – Column -> Column cleaning rules, date arithmetic, digests.
* ``operators`` – DataFrame -> DataFrame relational operators (latest
  version, incremental delta, lookup standardisation, as-of outcomes, repair).
* ``sources``   – readers, sinks, schema contracts, load audit.
* ``plans``     – declarative load specs and the one function that runs them.
* ``streaming`` – the same load specs driven by Structured Streaming.
* ``queries``   – query catalogue over the test tables, each with a DuckDB oracle.
"""

__version__ = "0.1.0"
