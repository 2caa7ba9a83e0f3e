"""The inputs of the operators, derived from the driver's tables.

Each input exists twice: as a Spark DataFrame and as SQL text for the checking engine.
``FIXTURES.md`` explains which table plays which part. All of them use whole tables.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countcast.columns import TREE_SCHEMA

SHIPPING_DAY = "2001-06-30"
DOUBLED_FROM_YEAR = 1998
WATCHED_DAY = "1996-07-02"
EVENTS_DAY = "2024-01-31"
CLOSED_AFTER = 3
#: Events that a first load lacks: all from a day on, and every seventh user's on days divisible by four.
LATE = "(CAST({ts} AS DATE) >= DATE '2024-01-26' OR ({user} % 7 = 3 AND extract(DAY FROM {ts}) % 4 = 0))"
BACKTEST_DAYS = ("2024-01-20", "2024-01-30")

# Fixed log-link coefficients: mcc, intercept, slope of ma_7, slope of lag_1.
# MCC 9999 has no data; -1 and 0 must be skipped.
MODELS = [
    (6300, 1.5, 0.3, 0.1),
    (4816, 1.4, 0.25, 0.08),
    (5411, 1.55, 0.35, 0.05),
    (9999, 1.0, 0.1, 0.01),
    (-1, 1.0, 0.1, 0.01),
    (0, 1.0, 0.1, 0.01),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier")
    return lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).selectExpr(
        "' ' || CAST(l_suppkey AS STRING) || ' ' AS merchant_id",
        """CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN '  '
                ELSE ' ' || CAST(s_nationkey AS STRING) || ' ' END AS mcc""",
        "l_shipdate AS event_ts", "l_returnflag", "l_orderkey")


def denied_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Denied events over many years: returned shipments, merchant = supplier, category = its nation."""
    return (
        _shipments(spark, sf_dir)
        .filter(F.col("l_returnflag") == "R")
        .select("merchant_id", "mcc", "event_ts")
    )


DENIED_RAW_SQL = """
SELECT ' ' || CAST(l_suppkey AS VARCHAR) || ' ' AS merchant_id,
       CASE WHEN l_linenumber = 7 THEN NULL
            WHEN l_linenumber = 6 THEN '  '
            ELSE ' ' || CAST(s_nationkey AS VARCHAR) || ' ' END AS mcc,
       l_shipdate AS event_ts
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag = 'R'
"""


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shipments; from 1998 on odd orders lie in the second table of their year."""
    second = (F.year("event_ts") >= DOUBLED_FROM_YEAR) & (F.col("l_orderkey") % 2 == 1)
    return _shipments(spark, sf_dir).select(
        "merchant_id", "mcc", "event_ts", F.when(second, 2).otherwise(1).alias("shard"))


TRANSACTIONS_RAW_SQL = """
SELECT ' ' || CAST(l_suppkey AS VARCHAR) || ' ' AS merchant_id,
       CASE WHEN l_linenumber = 7 THEN NULL
            WHEN l_linenumber = 6 THEN '  '
            ELSE ' ' || CAST(s_nationkey AS VARCHAR) || ' ' END AS mcc,
       l_shipdate AS event_ts,
       CASE WHEN year(l_shipdate) >= 1998 AND l_orderkey % 2 = 1 THEN 2 ELSE 1 END AS shard
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Denied events over 30 days: merchant = user, category = event type."""
    return _event_rows(table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream of files."""
    return _event_rows(spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet"))


def _event_rows(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "' ' || CAST(user_id AS STRING) || ' ' AS merchant_id",
        """CASE event_type WHEN 'view' THEN ' 6300 ' WHEN 'click' THEN '4816' WHEN 'purchase' THEN '5411'
                WHEN 'error' THEN '0' ELSE CASE WHEN event_id % 2 = 0 THEN '  ' END END AS mcc""",
        "ts AS event_ts")


EVENTS_RAW_SQL = """
SELECT ' ' || CAST(user_id AS VARCHAR) || ' ' AS merchant_id,
       CASE event_type WHEN 'view' THEN ' 6300 '
                       WHEN 'click' THEN '4816'
                       WHEN 'purchase' THEN '5411'
                       WHEN 'error' THEN '0'
                       ELSE CASE WHEN event_id % 2 = 0 THEN '  ' ELSE NULL END END AS mcc,
       ts AS event_ts
FROM events
"""


def unreadable_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose codes are partly no numbers: each order's first line has a status letter as category,
    its second a code with a letter."""
    line = F.col("l_linenumber")
    code = F.col("l_suppkey").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.when(line == 2, F.concat(F.lit("S"), code)).otherwise(code).alias("merchant_id"),
        F.when(line == 1, F.col("l_linestatus")).otherwise(F.lit("5411")).alias("mcc"),
        F.col("l_shipdate").alias("event_ts"),
    )


def merchant_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two sources with many rows per merchant: orders with a numeric tax id, finished orders without one."""
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    shared = [
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("merchant_id"),
        F.when(key % 7 != 0, (4000 + key % 5).cast("string")).alias("mcc"),
        F.when(key % 4 != 0, F.col("c_name")).alias("trade_name"),
        F.col("o_orderdate").alias("event_ts"),
    ]
    tax_id = F.when(key % 3 != 0, (F.lit(20000000000) + F.col("c_nationkey")).cast("double"))
    transactions = rows.filter(F.col("o_orderstatus") != "F").select(tax_id.alias("tax_id"), *shared)
    denied = rows.filter(F.col("o_orderstatus") == "F").select(*shared)
    return [transactions, denied]


MERCHANT_ATTRIBUTES_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS merchant_id,
       CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 3 <> 0
            THEN CAST(20000000000 + c_nationkey AS VARCHAR) END AS tax_id,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(4000 + o_orderkey % 5 AS INTEGER) END AS mcc,
       CASE WHEN o_orderkey % 4 <> 0 THEN c_name ELSE 'SIN NOMBRE COMERCIAL' END AS trade_name,
       CAST(o_orderdate AS DATE) AS day
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def merchants_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant master without a key: several categories per customer, repeated and malformed codes."""
    name, code = F.col("c_name"), F.col("c_custkey").cast("string")
    tax_id = F.when(F.col("c_acctbal") <= 9000, (F.lit(20000000000) + F.col("c_nationkey")).cast("string"))
    segment = F.col("c_mktsegment")
    mccs = (
        F.when(segment == "BUILDING", F.array(F.lit(4816), F.lit(5411), F.lit(6300)))
        .when(segment == "AUTOMOBILE", F.array(F.lit(5411), F.lit(6300)))
        .when(segment == "MACHINERY", F.array(F.lit(4816)))
        .otherwise(F.array(F.lit(6300)))
    )
    # Which rows a customer has: the plain one, a repeated one without name, one with a malformed code.
    kinds = F.array_compact(F.array(
        F.lit("plain"),
        F.when(F.col("c_acctbal") < 0, F.lit("nameless")),
        F.when(segment == "HOUSEHOLD", F.lit("malformed")),
    ))
    kind = F.col("kind")
    return (
        table(spark, sf_dir, "customer")
        .withColumn("mcc", F.explode(mccs))
        .withColumn("kind", F.explode(kinds))
        .select(
            F.when(kind == "malformed", F.concat(F.lit("X"), code)).otherwise(code).alias("merchant_id"),
            F.when(kind != "nameless", name).alias("trade_name"),
            F.when(kind == "plain", tax_id).alias("tax_id"),
            "mcc",
        )
    )


MERCHANTS_RAW_SQL = """
SELECT v.merchant_id, v.trade_name, v.tax_id, m.mcc
FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS merchant_id, c_name AS trade_name, c_mktsegment,
         CASE WHEN c_acctbal <= 9000 THEN CAST(20000000000 + c_nationkey AS VARCHAR) END AS tax_id
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment, NULL FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT 'X' || CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, NULL FROM customer
  WHERE c_mktsegment = 'HOUSEHOLD'
) v
JOIN (VALUES ('BUILDING', 4816), ('BUILDING', 5411), ('BUILDING', 6300),
             ('AUTOMOBILE', 5411), ('AUTOMOBILE', 6300), ('MACHINERY', 4816),
             ('HOUSEHOLD', 6300), ('FURNITURE', 6300)) AS m(segment, mcc)
  ON m.segment = v.c_mktsegment
"""


def special_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per nation; those of region 0 list no addresses."""
    key = F.col("n_nationkey")
    emails = F.concat(F.lit("kam"), key.cast("string"), F.lit("@example.com| backup@example.com"))
    return table(spark, sf_dir, "nation").select(
        key.alias("id"),
        (F.lit(20000000000) + key).cast("string").alias("tax_id"),
        F.when(F.col("n_regionkey") != 0, emails).alias("notify_emails"),
    )


SPECIAL_ACCOUNTS_SQL = """
SELECT n_nationkey AS id, CAST(20000000000 + n_nationkey AS VARCHAR) AS tax_id,
       CASE WHEN n_regionkey <> 0
            THEN 'kam' || CAST(n_nationkey AS VARCHAR) || '@example.com| backup@example.com' END AS notify_emails
FROM nation
"""


def fixed_models(spark: SparkSession) -> DataFrame:
    """The model table of ``MODELS``, as a local relation whose size Spark knows."""
    return spark.sql(f"""
        SELECT mcc, array('ma_7', 'lag_1') AS feature_names,
               array(CAST(b_ma7 AS DOUBLE), CAST(b_lag1 AS DOUBLE)) AS coefs,
               CAST(b0 AS DOUBLE) AS intercept, 0L AS n_rows
        FROM VALUES {", ".join(str(m) for m in MODELS)} AS t(mcc, b0, b_ma7, b_lag1)""")


MODELS_SQL = """
SELECT mcc, CAST(b0 AS DOUBLE) AS b0, CAST(b_ma7 AS DOUBLE) AS b_ma7, CAST(b_lag1 AS DOUBLE) AS b_lag1
FROM (VALUES {}) AS t(mcc, b0, b_ma7, b_lag1)
""".format(", ".join(str(m) for m in MODELS))


# Trees of two categories, as (mcc, round, node, feature, threshold, left values, value).
TREES = [
    (6300, -1, 0, None, None, None, 0.9), (5411, -1, 0, None, None, None, 0.2), (0, -1, 0, None, None, None, 1.0),
    (6300, 0, 0, "lag_1", 1.0, None, None), (6300, 0, 1, None, None, None, -0.35), (6300, 0, 2, "ma_7", 0.5, None, None),
    (6300, 0, 5, None, None, None, 0.25), (6300, 0, 6, None, None, None, 0.75),
    (6300, 1, 0, "dow", None, [1.0, 4.0, 7.0], None), (6300, 1, 1, "merchant_id", 40.0, None, None), (6300, 1, 2, None, None, None, 0.125),
    (6300, 1, 3, None, None, None, -0.0625), (6300, 1, 4, None, None, None, 0.5),
    (5411, 0, 0, "std_7", 0.6, None, None), (5411, 0, 1, None, None, None, 0.1), (5411, 0, 2, None, None, None, -0.2),
]

TREE_SCORE_SQL = """
CASE r.mcc
  WHEN 6300 THEN exp(0.9 + CASE WHEN r.lag_1 <= 1 THEN -0.35 WHEN r.ma_7 <= 0.5 THEN 0.25 ELSE 0.75 END
                     + CASE WHEN r.dow NOT IN (1, 4, 7) THEN 0.125 WHEN r.merchant_id <= 40 THEN -0.0625 ELSE 0.5 END)
  WHEN 5411 THEN exp(0.2 + CASE WHEN r.std_7 <= 0.6 THEN 0.1 ELSE -0.2 END) END"""


def fixed_trees(spark: SparkSession) -> DataFrame:
    rows = [(*t, 1, None) for t in TREES]
    return spark.createDataFrame(rows, TREE_SCHEMA)
