"""ledgerlens: token analytics as Spark DataFrame jobs.

Every public operator is a function from DataFrame(s) to a DataFrame built
from Spark's own expressions, joins, aggregates and windows.  Nothing is
collected to the driver inside an operator.
"""

__all__ = ["constants", "functions", "sources", "operators", "plans"]
