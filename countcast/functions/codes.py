"""Normalisers for merchant, category and tax codes, given a column name."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _trimmed(name: str) -> str:
    return f"trim(CAST({name} AS STRING))"


def code_text(name: str) -> Column:
    """Merchant code without surrounding blanks."""
    return F.expr(_trimmed(name))


def mcc_number(name: str) -> Column:
    """Category code as int: -1 when missing or blank, NULL when it is no number."""
    text = _trimmed(name)
    return F.expr(f"CASE WHEN coalesce({text}, '') = '' THEN -1 ELSE try_cast({text} AS INT) END")


def merchant_number(name: str) -> Column:
    """Merchant code as bigint, NULL when it is no number."""
    return F.expr(f"try_cast({_trimmed(name)} AS BIGINT)")


def tax_id_text(name: str) -> Column:
    """Numeric tax id, often stored as a float, as text of up to 11 digits."""
    return F.expr(f"CAST(try_cast({name} AS DECIMAL(11,0)) AS STRING)")


def event_day(name: str, is_text: bool = False) -> Column:
    """Calendar day of an event; unreadable text gives NULL."""
    return F.expr(f"try_to_date({name})" if is_text else f"to_date({name})")
