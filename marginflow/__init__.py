"""marginflow: initial-margin input analytics as plain PySpark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
native Spark SQL expressions, so Catalyst and adaptive query execution plan
the whole pipeline (pushdown, pruning, join strategy, partial aggregation).
"""

__version__ = "0.1.0"
