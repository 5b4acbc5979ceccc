"""flowlens: cloud network traffic analytics (VPC flow logs + resolver logs)
on PySpark DataFrames.

Subpackages: ``functions`` (Column builders), ``sources`` (readers, fixture
adapters, catalog), ``operators`` (range join, as-of DNS join, look-ups,
top-N), ``plans`` (the queries and the daily job), ``sinks`` (writers) and
``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
