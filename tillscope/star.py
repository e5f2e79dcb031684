"""The retail star schema: two facts, three conformed dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.periods import MONTH_PARTITION, STOCK_MONTH, YEAR_PARTITION

TABLE_NAMES = ("products", "stores", "calendar", "sales", "inventory")
MONTH_FOLDERS = {"sales": MONTH_PARTITION, "inventory": STOCK_MONTH}


class Tracker(Protocol):
    """What a store knows of the history of its facts."""

    def changes(self, table: str) -> dict[int, str]:
        """For each month of a fact (numbers like 202406), a digest that changes with its rows or with the dimensions."""

    def months(self, table: str) -> dict[int, str]:
        """The same for the rows alone."""

    def loads(self, table: str) -> set[int]:
        """Numbers of the loads that a fact was made from."""

    def of_loads(self, table: str, loads: Iterable[int]) -> DataFrame:
        """The rows that came with some loads."""


class Star:
    """The five tables every plan reads, as lazy DataFrames.

    Column names and types are those of ``tillscope.sources.schema``. Where the
    DataFrames come from (a loaded warehouse, a staging area, other tables) is
    of no concern to the plans. A table may be given as a function, which is
    called when a plan first asks for it. Where facts are stored by month and
    load, ``tracker`` tells what has changed.
    """

    def __init__(self, tracker: Tracker | None = None, **tables: DataFrame | Callable[[], DataFrame]):
        if set(tables) != set(TABLE_NAMES):
            raise ValueError(f"a star has the tables {TABLE_NAMES}, got {sorted(tables)}")
        self._tables = dict(tables)
        self.tracker = tracker

    def of_months(self, fact: str, months: Iterable[int]) -> Star:
        """The star with one fact cut to the folders of some months, given as numbers like 202406."""
        wanted = sorted(months)
        rows = self.table(fact).where(F.col(MONTH_FOLDERS[fact]).isin(wanted))
        if YEAR_PARTITION in rows.columns:
            rows = rows.where(F.col(YEAR_PARTITION).isin(sorted({m // 100 for m in wanted})))
        return Star(**{**self._tables, fact: rows})

    def table(self, name: str) -> DataFrame:
        given = self._tables[name]
        if not isinstance(given, DataFrame):
            given = self._tables[name] = given()
        return given

    @property
    def products(self) -> DataFrame:
        return self.table("products")

    @property
    def stores(self) -> DataFrame:
        return self.table("stores")

    @property
    def calendar(self) -> DataFrame:
        return self.table("calendar")

    @property
    def sales(self) -> DataFrame:
        return self.table("sales")

    @property
    def inventory(self) -> DataFrame:
        return self.table("inventory")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLE_NAMES}
