"""Column names and schemas shared by every operator."""

from pyspark.sql import types as T

MCC = "mcc"
MERCHANT = "merchant_id"
DAY = "day"
TOTAL = "total"
GROUP = [MCC, MERCHANT]

# The model features, in model order.
CALENDAR_FEATURES = [
    "dow", "week", "day_of_month", "month", "year",
    "is_weekend", "is_holiday", "is_payday", "is_month_start", "is_month_end",
]
HISTORY_FEATURES = [
    "lag_1", "lag_2", "lag_7", "lag_14", "lag_30",
    "ma_7", "ma_14", "std_7", "diff_week",
]
FEATURES = CALENDAR_FEATURES + HISTORY_FEATURES + [MERCHANT]
CATEGORICAL_FEATURES = [
    "dow", "is_weekend", "is_holiday", "is_payday", "is_month_start", "is_month_end",
]

LAGS = (1, 2, 7, 14, 30)
MEAN_WINDOWS = (7, 14)
STDDEV_WINDOWS = (7,)

# MCC -1 stands for a missing code and 0 for an unassigned one; neither has a usable model.
UNSCORED_MCCS = (-1, 0)

FEATURE_TABLE = [MCC, MERCHANT, DAY, TOTAL] + CALENDAR_FEATURES + HISTORY_FEATURES

DAILY_SCHEMA = T.StructType([
    T.StructField(MERCHANT, T.StringType(), False),
    T.StructField(DAY, T.DateType(), False),
    T.StructField(TOTAL, T.LongType(), False),
    T.StructField(MCC, T.IntegerType(), False),
])

PREDICTION_TYPE = T.DecimalType(18, 10)
PREDICTION_SCHEMA = T.StructType([
    T.StructField("tax_id", T.StringType(), True),
    T.StructField(MERCHANT, T.StringType(), True),
    T.StructField(MCC, T.IntegerType(), True),
    T.StructField(DAY, T.DateType(), True),
    T.StructField("prediction", PREDICTION_TYPE, False),
    T.StructField("notify", T.BooleanType(), False),
])

MODEL_SCHEMA = T.StructType([
    T.StructField(MCC, T.IntegerType(), False),
    T.StructField("feature_names", T.ArrayType(T.StringType()), False),
    T.StructField("coefs", T.ArrayType(T.DoubleType()), False),
    T.StructField("intercept", T.DoubleType(), False),
    T.StructField("n_rows", T.LongType(), False),
])

# A row per node of each tree. Round -1 holds the constant that a category starts from. Below node k lie 2 k + 1 (values up to the threshold,
# or in left_values) and 2 k + 2; a node without feature is a leaf, whose value adds to the logarithm of the expected count.
TREE_SCHEMA = T.StructType([
    T.StructField(MCC, T.IntegerType(), False),
    T.StructField("round", T.IntegerType(), False),
    T.StructField("node", T.IntegerType(), False),
    T.StructField("feature", T.StringType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("left_values", T.ArrayType(T.DoubleType()), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("n_rows", T.LongType(), True),
    T.StructField("gain", T.DoubleType(), True),
])
