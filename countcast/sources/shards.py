"""Fact tables that are split by year, some years over two tables."""

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from countcast.functions.dates import as_date


@dataclass(frozen=True)
class Shard:
    year: int
    part: int = 1

    @property
    def suffix(self) -> str:
        return "" if self.part == 1 else f"-{self.part}"


def years_back(day: dt.date | str, days: int) -> range:
    """The years that hold the ``days`` days up to ``day``."""
    last = as_date(day)
    return range((last - dt.timedelta(days=days)).year, last.year + 1)


def shards(years: Iterable[int], doubled_from: int | None = None, single_years: Iterable[int] = ()) -> list[Shard]:
    """One shard per year, and a second one from ``doubled_from`` on except in ``single_years``."""
    single = set(single_years)
    found = []
    for year in years:
        found.append(Shard(year))
        if doubled_from is not None and year >= doubled_from and year not in single:
            found.append(Shard(year, 2))
    return found


def denied_table(shard: Shard) -> tuple[str, str]:
    """Database and table of a shard of denied events."""
    return "Denegadas", f"[dbo].[Den{shard.year}]"


def transactions_table(shard: Shard) -> tuple[str, str]:
    """Database and table of a shard of transactions."""
    return f"Year{shard.year}{shard.suffix}", f"[dbo].[Año{shard.year}{shard.suffix}]"


def union_shards(found: list[Shard], read: Callable[[Shard], DataFrame]) -> DataFrame:
    """All shards as one lazy frame, to be counted in one pass: an event day that lies
    in two shards then gives one count, not two."""
    return reduce(DataFrame.unionByName, [read(s) for s in found])
