"""Merchant master: the best row per merchant, and its link to special accounts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from countcast.columns import MCC, MERCHANT
from countcast.functions.codes import code_text, event_day, merchant_number, tax_id_text
from countcast.operators.scoring import eligible_models

# Fixed value: the name of a merchant that has none.
NO_NAME = "SIN NOMBRE COMERCIAL"


def merchant_attributes(sources: list[DataFrame]) -> DataFrame:
    """One frame of (merchant_id, tax_id, mcc, trade_name, day) from all sources.

    A source holds merchant_id, mcc, trade_name and event_ts; its numeric tax_id is optional.
    """
    def projected(source: DataFrame) -> DataFrame:
        tax_id = tax_id_text("tax_id") if "tax_id" in source.columns else F.lit(None).cast("string")
        return source.select(
            code_text(MERCHANT).alias(MERCHANT),
            tax_id.alias("tax_id"),
            F.col(MCC).try_cast("int").alias(MCC),
            F.coalesce("trade_name", F.lit(NO_NAME)).alias("trade_name"),
            event_day("event_ts").alias("day"),
        )

    return reduce(DataFrame.unionByName, [projected(s) for s in sources])


def best_merchant_rows(attributes: DataFrame) -> DataFrame:
    """One row per merchant: with a tax id if there is one, then with a category, then the newest.

    Ties are settled by the remaining columns. Equal attributes first merge to their newest day,
    which combines on the map side, so a merchant with a large share of all events reaches
    the ranking as a handful of rows.
    """
    merged = attributes.groupBy(MERCHANT, "tax_id", MCC, "trade_name").agg(F.max("day").alias("day"))
    best_first = Window.partitionBy(MERCHANT).orderBy(
        F.col("tax_id").isNull().cast("int"),
        F.col(MCC).isNull().cast("int"),
        F.col("day").desc_nulls_last(),
        "tax_id", MCC, "trade_name",
    )
    return _top(merged, best_first).select(MERCHANT, "tax_id", MCC, "trade_name", "day")


def with_account_id(merchants: DataFrame, accounts: DataFrame) -> DataFrame:
    """Merchants with the id of their special account; one row per matching account."""
    return (
        merchants.alias("m")
        .join(accounts.alias("a"), F.col("m.tax_id") == F.col("a.tax_id"), "left")
        .select("m.tax_id", f"m.{MERCHANT}", f"m.{MCC}", F.col("a.id").alias("account_id"), "m.trade_name")
    )


def one_account_per_tax_id(accounts: DataFrame) -> DataFrame:
    """The account that routes the mail of a tax id: one with addresses, then the lowest id."""
    best_first = Window.partitionBy("tax_id").orderBy(
        F.col("notify_emails").isNull().cast("int"), "id", "notify_emails")
    return _top(accounts.filter(F.col("tax_id").isNotNull()), best_first).select("tax_id", "notify_emails")


def scoring_merchants(master: DataFrame, accounts: DataFrame, models: DataFrame) -> DataFrame:
    """One row per (mcc, merchant number) with name, tax id and addresses, for categories with a model.

    Codes that are no numbers cannot match a scored merchant and are left out. None of the
    joined sides is hinted: Spark broadcasts one when its measured size allows it.
    """
    numbered = (
        master
        .select(MCC, merchant_number(MERCHANT).alias(MERCHANT), "trade_name", "tax_id")
        .filter(F.col(MERCHANT).isNotNull())
        .join(eligible_models(models).select(MCC).distinct(), MCC, "left_semi")
    )
    best_first = Window.partitionBy(MCC, MERCHANT).orderBy(
        F.col("tax_id").isNull().cast("int"), F.col("trade_name").isNull().cast("int"), "tax_id", "trade_name")
    return (
        _top(numbered, best_first)
        .join(one_account_per_tax_id(accounts), "tax_id", "left")
        .select(MCC, MERCHANT, "trade_name", "tax_id", "notify_emails")
    )


def _top(rows: DataFrame, best_first) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") == 1).drop("place")
