"""Daily counts as a stream: each day is written once, when no more events of it are expected."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countcast.columns import DAY, MCC, MERCHANT, TOTAL
from countcast.operators.counts import clean_events


def closed_counts(events: DataFrame, lateness: str, code: str = MERCHANT, mcc: str = MCC, ts: str = "event_ts") -> DataFrame:
    """``daily_counts`` of a stream of events, for the days that are closed: those that lie at least ``lateness`` (say ``"3 days"``)
    before the newest day seen.

    The watermark is on the day, in the session's time zone, so state holds one number per merchant, category and open day, however many
    events there are; it is combined before the shuffle. Events that come after their day was closed are left out and show as
    ``numRowsDroppedByWatermark`` in the query's progress; ``refresh_daily`` finds such days again from the whole data.
    """
    return (
        clean_events(events, code, mcc, ts)
        .withColumn("day_start", F.col(DAY).cast("timestamp"))
        .withWatermark("day_start", lateness)
        .groupBy("day_start", MERCHANT, MCC)
        .agg(F.count(F.lit(1)).alias(TOTAL))
        .select(MERCHANT, F.to_date("day_start").alias(DAY), TOTAL, MCC)
    )


def write_closed_days(events: DataFrame, path: str, checkpoint: str, lateness: str, **names: str) -> StreamingQuery:
    """Starts a run that takes all events there are now, adds the days that they close to the table at ``path``, partitioned by day, and ends.

    ``checkpoint`` is a folder that all executors share; it carries offsets and open days from run to run, and the table's own
    log makes a repeated batch appear once. The table is read with ``read_daily``. Runs without new events, and events without a usable day or
    code, add nothing.
    """
    return (
        closed_counts(events, lateness, **names)
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy(DAY)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
