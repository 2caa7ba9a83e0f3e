"""Features computed from the totals of the last days.

The inputs are one column ``ago_k`` per day back (0 where there is none) and ``known_days``,
the number of days since the merchant was first seen. Features that reach further back
than the known days are NULL; means and deviations use the days there are. The expressions are
SQL text, which is far quicker to build than as many column objects.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

KNOWN_DAYS = "known_days"


def reach(lags, means, stddevs) -> list[int]:
    """All distances in days that the features need."""
    return sorted(set(lags) | set(range(1, max([0, *means, *stddevs]) + 1)))


def lagged(k: int) -> Column:
    return F.expr(f"if({KNOWN_DAYS} >= {k}, ago_{k}, null)")


def mean_of_last(n: int) -> Column:
    total = " + ".join(f"ago_{k}" for k in range(1, n + 1))
    return F.expr(f"if({KNOWN_DAYS} >= 1, ({total}) / least({KNOWN_DAYS}, {n}), null)")


def running_mean_of_last(n: int) -> Column:
    """``mean_of_last`` from running sums: ``before`` today, less ``before_n``, the one of n days ago."""
    return F.expr(f"if({KNOWN_DAYS} >= 1, (before - before_{n}) / least({KNOWN_DAYS}, {n}), null)")


def stddev_of_last(n: int, mean: str) -> Column:
    """Sample deviation around the column that holds the mean of the same days."""
    squares = " + ".join(
        f"if({KNOWN_DAYS} >= {k}, (ago_{k} - {mean}) * (ago_{k} - {mean}), 0D)" for k in range(1, n + 1))
    return F.expr(f"if({KNOWN_DAYS} >= 2, sqrt(({squares}) / (least({KNOWN_DAYS}, {n}) - 1)), null)")
