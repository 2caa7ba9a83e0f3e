"""Calendar features and date labels."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public holidays as month-day.
HOLIDAYS = [
    "1-1", "5-1", "7-28", "7-29", "8-30",
    "10-8", "11-1", "12-8", "12-9", "12-25",
]
# Month labels used in alert charts.
MONTH_LABELS = ["ENE", "FEB", "MAR", "ABR", "MAY", "JUN", "JUL", "AGO", "SET", "OCT", "NOV", "DIC"]
# Days of the month behind the flags, and weekend days (Sunday is 1).
PAYDAYS = [15, 30, 31]
MONTH_START_DAYS = [1, 2, 3]
MONTH_END_DAYS = [28, 29, 30, 31]
WEEKEND_DOWS = [1, 7]


def as_date(day: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def day_literal(day: dt.date | str) -> Column:
    return F.lit(as_date(day))


def calendar_columns(day: str, holidays: list[str] = HOLIDAYS) -> dict[str, Column]:
    """The ten calendar features of a date column, as ints.

    Holidays compare as the number month * 100 + day, which avoids building a string per row.
    """
    def flag(value: str, numbers: list[int]) -> Column:
        listed = ", ".join(str(n) for n in numbers) or "NULL"
        return F.expr(f"CASE WHEN {value} IN ({listed}) THEN 1 ELSE 0 END")

    holiday_numbers = [int(m) * 100 + int(d) for m, d in (h.split("-") for h in holidays)]
    day_of_month = f"dayofmonth({day})"
    return {
        "dow": F.dayofweek(day),
        "week": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "is_weekend": flag(f"dayofweek({day})", WEEKEND_DOWS),
        "is_holiday": flag(f"month({day}) * 100 + {day_of_month}", holiday_numbers),
        "is_payday": flag(day_of_month, PAYDAYS),
        "is_month_start": flag(day_of_month, MONTH_START_DAYS),
        "is_month_end": flag(day_of_month, MONTH_END_DAYS),
    }


def chart_label(day: Column) -> Column:
    """Quoted chart label such as 'ENE-31'."""
    label = F.element_at(F.array(*[F.lit(m) for m in MONTH_LABELS]), F.month(day))
    return F.concat(F.lit("'"), label, F.lit("-"), F.dayofmonth(day).cast("string"), F.lit("'"))
