import datetime as dt
from collections import Counter

RAW_DDL = "merchant_id string, mcc string, event_ts timestamp"
DAILY_DDL = "merchant_id string, day date, total bigint, mcc int"


def d(text):
    return dt.date.fromisoformat(text)


def ts(text, hour=10):
    return dt.datetime.fromisoformat(text) + dt.timedelta(hours=hour)


def daily(spark, *rows):
    """Rows of (merchant, day, total, mcc)."""
    return spark.createDataFrame([(m, d(day), n, mcc) for m, day, n, mcc in rows], DAILY_DDL)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def rounded(df, places=9):
    from pyspark.sql import functions as F
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
