"""eventide: clickstream, login and order-event analytics as Spark DataFrame plans.

Every operator is a function from DataFrame(s) to DataFrame, built from Spark
SQL expressions, windows, aggregations and joins so Catalyst plans it and the
work is partitioned across executors.  Stateful stream operators live in
``eventide.streaming``.
"""

__version__ = "0.1.0"
