"""Lags, moving windows and other looks back over a dense calendar."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from countcast.columns import DAY, GROUP, LAGS, MEAN_WINDOWS, STDDEV_WINDOWS, TOTAL
from countcast.functions.dates import day_literal
from countcast.functions.lookback import KNOWN_DAYS, lagged, mean_of_last, reach, running_mean_of_last, stddev_of_last


def by_day() -> WindowSpec:
    return Window.partitionBy(*GROUP).orderBy(DAY)


def with_history(dense: DataFrame, lags=LAGS, means=MEAN_WINDOWS, stddevs=STDDEV_WINDOWS,
                 ratio: bool = False) -> DataFrame:
    """All history features at once; those that reach before the first day are NULL.

    The windows are a running sum, offsets and a row number over one partitioning and one sort. Moving means
    are differences of the running sum, so a long window costs no more than a short one, and deviations are
    arithmetic on the offsets; sliding frames would visit every day of the window again for every row.
    ``ratio`` adds lag_1 over the weekly mean.
    """
    w = f"(PARTITION BY {', '.join(GROUP)} ORDER BY {DAY})"
    all_means = sorted({*means, *stddevs})
    if all_means:
        so_far = f"(PARTITION BY {', '.join(GROUP)} ORDER BY {DAY} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        dense = dense.withColumn("before", F.expr(f"coalesce(sum({TOTAL}) OVER {so_far}, 0L)"))
    running = {f"before_{n}": F.expr(f"lag(before, {n}, 0L) OVER {w}") for n in all_means}
    offsets = {f"ago_{k}": F.expr(f"lag({TOTAL}, {k}, 0L) OVER {w}") for k in reach(lags, (), stddevs)}
    known = {KNOWN_DAYS: F.expr(f"row_number() OVER {w} - 1")}
    looked_back = dense.withColumns({**offsets, **running, **known})
    return (
        add_history(looked_back, lags, means, stddevs, ratio, running_mean_of_last)
        .drop("before", *offsets, *running, *known)
    )


def add_history(looked_back: DataFrame, lags=LAGS, means=MEAN_WINDOWS, stddevs=STDDEV_WINDOWS,
                ratio: bool = False, mean=mean_of_last) -> DataFrame:
    """The features from ``ago_k`` and ``known_days`` columns.

    In two steps, so that a mean is computed once and not again for each square around it.
    """
    first = {f"lag_{k}": lagged(k) for k in lags}
    first.update({f"ma_{n}": mean(n) for n in sorted({*means, *stddevs})})
    second = {f"std_{n}": stddev_of_last(n, f"ma_{n}") for n in stddevs}
    if 1 in lags and 7 in lags:
        second["diff_week"] = F.col("lag_1") - F.col("lag_7")
    if ratio:
        second["ratio_week"] = F.col("lag_1") / (F.col("ma_7") + 1)
    extra = [f"ma_{n}" for n in stddevs if n not in means]
    rows = looked_back.withColumns(first)
    return (rows.withColumns(second) if second else rows).drop(*extra)


def expanding_mean(dense: DataFrame, name: str = "mean_so_far") -> DataFrame:
    """Mean of all totals up to and including each day."""
    so_far = by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dense.withColumn(name, F.avg(TOTAL).over(so_far))


def expanding_report(dense: DataFrame, day, name: str = "mean_so_far") -> DataFrame:
    """Days before ``day`` with their expanding mean, newest first."""
    return expanding_mean(dense.filter(F.col(DAY) < day_literal(day)), name).orderBy(F.col(DAY).desc(), *GROUP)


def last_rows(dense: DataFrame, n: int) -> DataFrame:
    """The latest ``n`` rows of each (mcc, merchant)."""
    newest_first = Window.partitionBy(*GROUP).orderBy(F.col(DAY).desc())
    return (
        dense
        .withColumn("newest", F.row_number().over(newest_first))
        .filter(F.col("newest") <= n)
        .drop("newest")
    )
