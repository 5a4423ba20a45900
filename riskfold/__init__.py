"""riskfold — credit-risk analytics as Spark DataFrame operators.

Every operator takes and returns a :class:`pyspark.sql.DataFrame`; the
sub-packages are

* ``sources``   – table scans and sinks (parquet, CSV, file-size probe)
* ``functions`` – column-level building blocks (safe division, sigmoid, ...)
* ``operators`` – the analytic operators (feature blocks, screening, ranks,
  strategy grids, explanations, segments)
* ``plans``     – bindings of the operators to concrete tables and the
  query catalogue used by ``__spark_entry__``
* ``streaming`` – the same drift statistics fed from a Structured Stream
"""

__version__ = "0.1.0"
