"""The merchant job: the best known row per merchant, linked to its special account."""

from collections.abc import Callable

from pyspark.sql import DataFrame

from countcast.operators.merchants import best_merchant_rows, merchant_attributes, with_account_id
from countcast.sinks.tables import write_table


def build_master(sources: list[DataFrame], accounts: DataFrame, folder: str,
                 save: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Stores the merchant master and its linked form; ``save`` may also put that into a database."""
    spark = accounts.sparkSession
    write_table(best_merchant_rows(merchant_attributes(sources)), f"{folder}/merchants")
    linked = with_account_id(spark.read.parquet(f"{folder}/merchants"), accounts)
    write_table(linked, f"{folder}/merchants_linked")
    if save is not None:
        save(spark.read.parquet(f"{folder}/merchants_linked"))
    return spark.read.parquet(f"{folder}/merchants_linked")
