"""The stored star: catalog tables in one database."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions.periods import MONTH_PARTITION, STOCK_MONTH, YEAR_PARTITION, year_month
from tillscope.sources.schema import DESCRIPTIONS, KEYS, TABLES
from tillscope.sources.shared import COMPACT, delete_folder, materialized, shuffles_deleted
from tillscope.sources.versions import MADE_FROM, VersionedTables, Written
from tillscope.star import Star


def with_comments(df: DataFrame, table: str) -> DataFrame:
    """Attach the schema's column descriptions."""
    notes = {f.name: f.metadata for f in TABLES[table].fields}
    return df.select(*[F.col(c).alias(c, metadata=notes.get(c, {})) for c in df.columns])


def analyze(spark: SparkSession, table: str, columns: Iterable[str] = (), histograms: bool = False) -> None:
    """Refresh table statistics and those of single columns, with equi-height histograms if asked for.

    The optimizer uses column statistics where ``spark.sql.cbo.enabled`` is set.
    """
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if not columns:
        return
    setting = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(histograms).lower())
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    finally:
        spark.conf.set(setting, before)


def statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """What the catalog holds about columns: rows of the table, least and greatest value, and NULLs."""
    size = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'").first()["data_type"]
    total = int(size.split(",")[1].split()[0])
    rows = []
    for column in columns:
        info = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
        rows.append((column, total, info["min"], info["max"], int(info["num_nulls"])))
    return spark.createDataFrame(rows, "column_name string, rows long, least string, greatest string, nulls long")


@dataclass(frozen=True)
class Layout:
    """How a fact is laid out: its date, the partition columns made from it, and the order of the rows of a date."""

    date: str
    months: tuple[str, ...]
    order: tuple[str, ...]

    @property
    def month(self) -> str:
        return self.months[-1]


LAYOUTS = {
    "sales": Layout("sale_date", (YEAR_PARTITION, MONTH_PARTITION), ("sale_id",)),
    "inventory": Layout("snapshot_date", (STOCK_MONTH,), ("product_id", "store_id")),
}
#: Columns that filters and joins of the plans estimate by.
ESTIMATED = {
    "products": ("product_id", "category", "brand"),
    "stores": ("store_id", "chain", "format", "region"),
    "calendar": ("cal_date", "year", "month"),
    "sales": ("product_id", "store_id", "sale_date", "channel", YEAR_PARTITION, MONTH_PARTITION),
    "inventory": ("product_id", "store_id", "snapshot_date", "final_stock", STOCK_MONTH),
}
LOADS, LAST_KEY = "loads", "last_key"
#: A fact is put in order a range of months at a time: so many rows at least, and so many ranges at most.
RANGE_ROWS, MOST_RANGES = 1_000_000, 4


def as_ranges(numbers: Iterable[int]) -> str:
    """Whole numbers as ``1-4,7``."""
    out: list[list[int]] = []
    for n in sorted(set(numbers)):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return ",".join(f"{a}-{b}" if a < b else str(a) for a, b in out)


def from_ranges(text: str) -> set[int]:
    pairs = re.findall(r"(\d+)(?:-(\d+))?", text)
    return {n for a, b in pairs for n in range(int(a), int(b or a) + 1)}


class Warehouse(VersionedTables):
    """Load, append, clear, archive and read the five tables.

    ``location`` is the database folder; it must be storage that all executors
    reach. Facts lie in folders by month, or by day with ``grain="day"``, which
    suits months of many thousand files: a range of dates lists the folders it
    needs only. Inside a folder files are cut by ranges of dates and sorted.
    With ``ticket_buckets`` sale files are cut and sorted by ticket instead, so
    tickets are grouped without moving lines.

    Every addition to a fact has a load number, which its folders carry.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        location: str | None = None,
        keep: int = 4,
        grain: str = "month",
        ticket_buckets: int = 0,
    ):
        if grain not in ("month", "day"):
            raise ValueError(f"grain is month or day, got {grain}")
        super().__init__(spark, database, location, keep, "Retail analytics star schema")
        self.grain = grain
        self.ticket_buckets = ticket_buckets

    # Facts

    def _laid_out(self, df: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
        """Rows in the order and parts they are stored in, and their partition columns.

        Ranges of dates are found from a sample of the rows; rows of one date
        are told apart by a hash of all their columns, so a date that holds a
        third of all rows spreads over as many tasks as its size asks for.
        Tickets go where their bucket is written; lines without a ticket, of
        which there may be many, go to any task.
        """
        layout = LAYOUTS[table]
        made = {layout.month: year_month(layout.date)}
        if YEAR_PARTITION in layout.months:
            made[YEAR_PARTITION] = F.year(layout.date)
        rows, spread = df.withColumns(made), F.xxhash64(*df.columns)
        partition_by = [*layout.months, *([layout.date] if self.grain == "day" else [])]
        if self._buckets(table):
            ticket = F.coalesce("ticket_id", spread.cast("string"))
            rows = rows.repartition(self.ticket_buckets, ticket).sortWithinPartitions(*partition_by, "ticket_id")
        else:
            order = [c for c in layout.order if c in df.columns]
            rows = rows.repartitionByRange(layout.date, spread).sortWithinPartitions(*partition_by, layout.date, *order)
        return rows, partition_by

    def _ranges(self, df: DataFrame, table: str) -> list[DataFrame]:
        """The rows cut between months into ranges of dates; rows without a date are in the first."""
        day = F.col(LAYOUTS[table].date).cast("date")
        counted = df.groupBy(year_month(LAYOUTS[table].date)).agg(F.min(F.unix_date(day)).alias("first"), F.count("*").alias("n"))
        months = sorted((r["first"], r["n"]) for r in counted.collect() if r["first"] is not None)
        size = max(RANGE_ROWS, -(-sum(n for _, n in months) // MOST_RANGES))
        starts, held = [], size
        for first, n in months:
            if held >= size:
                starts.append(F.date_from_unix_date(F.lit(first)))
                held = 0
            held += n
        if len(starts) < 2:
            return [df]
        inner = [df.where((day >= a) & (day < b)) for a, b in zip(starts[1:], starts[2:])]
        return [df.where((day < starts[1]) | day.isNull()), *inner, df.where(day >= starts[-1])]

    def _buckets(self, table: str) -> int:
        return self.ticket_buckets if table == "sales" else 0

    def write_fact(self, table: str, df: DataFrame, load: int, stored: bool = False) -> Written:
        """Store the rows of a load beside the table, under its load number.

        Rows are computed once, into a folder that goes at the end, unless they are ``stored`` already. From there they are
        exchanged and written a range of dates after the other, so never more than one range lies in shuffle files.
        """
        folder = self.work_folder()
        with shuffles_deleted(self.spark):
            try:
                rows = df if stored else materialized(df, folder, COMPACT)
                ranges = self._ranges(rows, table)
                parts = [self._laid_out(part, table) for part in ranges]
                first, *more = [with_comments(part, table) for part, _ in parts]
                buckets = self._buckets(table)
                return self.write(table, first, parts[0][1], str(load), buckets, ["ticket_id"], COMPACT, more)
            finally:
                delete_folder(self.spark, folder)

    def work_folder(self) -> str:
        """A new, unused folder for rows on their way; a vacuum deletes what a change that broke off left in one."""
        return self._folder(f"rows_{uuid.uuid4().hex[:16]}")

    def loads(self, table: str) -> set[int]:
        """Numbers of the loads that the current version of a fact was made from."""
        return from_ranges(self.properties(table).get(LOADS, "")) if self.exists(table) else set()

    def next_load(self) -> int:
        taken = set().union(*(self.loads(table) for table in LAYOUTS), self._listed_loads())
        return max(taken, default=0) + 1

    def switch_fact(self, table: str, written: Written | None, load: int, append: bool, last_key: int | None = None) -> None:
        """Make a load visible: after it, or instead of all before it."""
        kept, loads, key = (), {load}, last_key
        if append and self.exists(table):
            kept, loads = self.parts(table), self.loads(table) | {load}
            key = max(last_key or 0, self.last_key(table))
        notes = {LOADS: as_ranges(loads), LAST_KEY: str(key if key is not None else 0)}
        self.switch(table, written, kept, notes, DESCRIPTIONS[table])

    def last_key(self, table: str) -> int:
        """The largest generated key of a fact so far, also of rows that have gone since."""
        if not self.exists(table):
            return 0
        return int(self.properties(table).get(LAST_KEY, "0"))

    def _largest_key(self, written: Written, table: str) -> int:
        key = KEYS[table]
        return self.stored(written).agg(F.max(key)).first()[0] or 0 if key in written.columns else 0

    def put_fact(self, table: str, df: DataFrame, mode: str = "overwrite") -> None:
        """Store rows of a fact, instead of or after those stored."""
        load = self.next_load()
        written = self.write_fact(table, df, load)
        self.switch_fact(table, written, load, mode == "append", self._largest_key(written, table))

    def write_sales(self, df: DataFrame, mode: str = "overwrite") -> None:
        """Store sale lines. Any year in the data gets its own directory."""
        self.put_fact("sales", df, mode)

    def of_loads(self, table: str, loads: Iterable[int]) -> DataFrame:
        """Rows of a fact that came with the given loads; only their folders are read."""
        rows = self.spark.table(self.current_table(table))
        chosen = rows.where(F.col(MADE_FROM).isin([str(n) for n in loads]))
        return chosen.select(*[c for c in self.table(table).columns])

    def months(self, table: str) -> dict[int, str]:
        """For each month of a fact, a digest of the folders that hold it."""
        held: dict[int, list[str]] = {}
        for part in self.parts(table):
            month = part[LAYOUTS[table].month]
            held.setdefault(int(month) if month else 0, []).append(part.path)
        return {m: hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16] for m, paths in held.items()}

    # All tables

    def write_dimension(self, table: str, df: DataFrame) -> Written:
        return self.write(table, with_comments(df, table), options=COMPACT)

    def write_table(self, table: str, df: DataFrame, mode: str = "overwrite") -> None:
        """Store a table: a dimension as a whole, a fact as ``mode`` says."""
        if table in LAYOUTS:
            self.put_fact(table, df, mode)
        elif mode != "overwrite":
            raise ValueError(f"{table} is stored as a whole")
        else:
            self.switch(table, self.write_dimension(table, df), comment=DESCRIPTIONS[table])

    def write_star(self, star: Star) -> None:
        """Store all five tables, dimensions first, and refresh statistics."""
        for table in ("products", "stores", "calendar", "sales", "inventory"):
            self.write_table(table, star.tables()[table])
        self.analyze()
        self.vacuum()

    def analyze(self, columns: bool = False) -> None:
        """Statistics of all tables; with ``columns`` also histograms of those that plans filter and join by."""
        for table in TABLES:
            analyze(self.spark, self.current_table(table), ESTIMATED[table] if columns else (), histograms=columns)

    def clear(self) -> None:
        """Empty facts, then product and store dimensions; the calendar stays. Readers keep what they have opened."""
        for table in ("sales", "inventory"):
            self.switch(table, None, (), {LOADS: "", LAST_KEY: "0"}, DESCRIPTIONS[table])
        for table in ("stores", "products"):
            self.write_table(table, self.table(table).limit(0))

    def archive_year(self, year: int, archive_table: str) -> int:
        """Move one year of sales to another table of this database; returns the rows moved.

        Folders are handed over, no row is copied. The year replaces what the
        archive holds of it, so a run that broke off can be repeated; the year
        leaves the sales table after the archive has it.
        """
        archive = archive_table.split(".")[-1]
        if archive_table not in (archive, self.name(archive)):
            raise ValueError(f"the archive is a table of {self.database}, got {archive_table}")
        moved = self.table("sales").where(F.col(YEAR_PARTITION) == year).count()
        parts = self.parts("sales")
        going = [p for p in parts if p[YEAR_PARTITION] == str(year)]
        held = [p for p in self.parts(archive) if p[YEAR_PARTITION] != str(year)]
        self.switch(archive, None, [*held, *going], comment="Sales of past years", like=self.current_table("sales"))
        notes = {key: self.properties("sales").get(key, "") for key in (LOADS, LAST_KEY)}
        self.switch("sales", None, [p for p in parts if p not in going], notes, DESCRIPTIONS["sales"])
        return moved

    def archive_before(self, day: date, archive_table: str) -> dict[int, int]:
        """Archive every year that ended before ``day``; rows moved by year."""
        years = sorted({int(p[YEAR_PARTITION]) for p in self.parts("sales") if p[YEAR_PARTITION]})
        return {year: self.archive_year(year, archive_table) for year in years if year < day.year}

    # Ledger of loaded files and rejected rows

    _LEDGER = "load int, table_name string, digest string, lines long, path string"

    def _logs(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.place}/{name}"
        empty = self.spark.createDataFrame([], schema)
        empty.coalesce(1).write.mode("ignore").parquet(folder)
        return self.spark.read.schema(schema).parquet(folder)

    def _listed_loads(self) -> set[int]:
        """Load numbers in the ledger, also of loads that broke off."""
        return {r["load"] for r in self._logs("ledger", self._LEDGER).select("load").distinct().collect()}

    def loaded_files(self) -> DataFrame:
        """The files whose rows the facts hold: ``load, table_name, digest, lines, path``.

        A load counts once the fact's current version names it.
        """
        rows = self._logs("ledger", self._LEDGER)
        return rows.where(self._is_committed())

    def _is_committed(self) -> Column:
        held = [(F.col("table_name") == t) & F.col("load").isin(sorted(self.loads(t))) for t in LAYOUTS]
        return reduce(Column.__or__, held)

    def list_files(self, files: DataFrame) -> None:
        """Enter the files of a load that is under way."""
        self._logs("ledger", self._LEDGER)
        columns = [c.split()[0] for c in self._LEDGER.split(", ")]
        files.select(*columns).coalesce(1).write.mode("append").parquet(f"{self.place}/ledger")

    _REJECTED = "load int, table_name string, broken_rules array<string>, source_row string"

    def keep_rejected(self, rows: DataFrame, load: int) -> None:
        """Store rejected rows (``table_name, broken_rules, source_row``) of a load beside those of others."""
        self._logs("rejected", self._REJECTED)
        numbered = rows.select(F.lit(load).alias("load"), "table_name", "broken_rules", "source_row")
        numbered.write.mode("append").options(**COMPACT).parquet(f"{self.place}/rejected")

    def rejected(self, load: int | None = None) -> DataFrame:
        """Rejected rows of all loads that the facts hold, or of one load."""
        rows = self._logs("rejected", self._REJECTED)
        if load is not None:
            return rows.where(F.col("load") == load)
        held = sorted(set().union(*(self.loads(table) for table in LAYOUTS)))
        return rows.where(F.col("load").isin(held))

    # Reading

    def descriptions(self, table: str) -> DataFrame:
        """Column names, types and comments as the catalog holds them."""
        return self.spark.sql(f"DESCRIBE TABLE {self.name(table)}")

    def table(self, table: str) -> DataFrame:
        return self.read(table)

    def star(self) -> Star:
        return Star(**{table: partial(self.table, table) for table in TABLES}, tracker=self)

    def changes(self, table: str) -> dict[int, str]:
        """For each month of a fact, a digest that changes with its rows or with the dimensions."""
        dimensions = [self.current_table(t) for t in TABLES if t not in LAYOUTS]
        digests = self.months(table).items()
        return {m: hashlib.sha256("\n".join([d, *dimensions]).encode()).hexdigest()[:16] for m, d in digests}
