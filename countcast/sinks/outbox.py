"""Delivering alert messages."""

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAY
from countcast.sinks.tables import write_day


def write_outbox(messages: DataFrame, path: str, day: dt.date | str) -> DataFrame:
    """Stores the messages of a day, for a mail service to pick up, and returns them as stored; those of other days stay as they are."""
    write_day(messages, path, day)
    day_only = F.col(DAY) == F.lit(str(day)).cast("date")
    return messages.sparkSession.read.schema(messages.schema).parquet(path).filter(day_only)


def send_outbox(messages: DataFrame, send: Callable[[Iterable[str]], None]) -> None:
    """Hands the encoded messages to ``send``, once per task, where the data is.

    ``send`` opens its own queue connection. A task that is run again sends its messages again.
    """
    messages.select("message").foreachPartition(lambda rows: send(row.message for row in rows))
