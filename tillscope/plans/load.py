"""From exchange files to a stored, checked star."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.periods import month_number, time_of_day
from tillscope.operators.keys import assign_keys
from tillscope.operators.quality import mark, mark_duplicates, mark_known
from tillscope.sources.csv import CORRUPT, content_digests, read_csv, with_defaults, with_inventory_value
from tillscope.sources.schema import DESCRIPTIONS, KEYS
from tillscope.sources.shared import COMPACT, delete_folder, materialized, shuffles_deleted
from tillscope.sources.versions import Written
from tillscope.sources.warehouse import LAYOUTS, Warehouse

#: Rows are checked a portion at a time: so many rows at least, and so many portions at most.
PORTION_ROWS, MOST_PORTIONS = 1_000_000, 4


@dataclass(frozen=True)
class SourceFiles:
    products: str
    stores: str
    sales: Sequence[str]
    inventory: str | Sequence[str]


def _stage(table: str, paths: str | Sequence[str], warehouse: Warehouse, key: str | None, start_after: int = 0) -> DataFrame:
    """Parse a table's files once, into a staging table; rows that do not parse are kept marked.

    A generated key is assigned on the scan of the files, where the order of
    rows is fixed, and stored, so all that read the table see the same keys.
    """
    raw = read_csv(warehouse.spark, table, paths, keep_corrupt=True)
    name = warehouse.name(f"staging_{table}")
    keyed = assign_keys(raw, key, start_after) if key else raw
    keyed.write.mode("overwrite").format("parquet").options(**COMPACT).saveAsTable(name)
    return warehouse.spark.table(name)


def _portions(table: str, rows: DataFrame, count: int, keys: dict[str, tuple[str, ...]]) -> list[DataFrame]:
    """The rows cut by a hash of their unique key, else of the generated one; rows under more than one key are not cut."""
    n = min(MOST_PORTIONS, max(1, -(-count // PORTION_ROWS)))
    key = next(iter(keys.values()), (KEYS[table],))
    if n == 1 or len(keys) > 1 or not set(key) <= set(rows.columns):
        return [rows]
    return [rows.where(F.pmod(F.xxhash64(*key), F.lit(n)) == i) for i in range(n)]


def _parsed(table: str, staged: DataFrame) -> DataFrame:
    """Staged rows with ``broken_rules`` where a field is no value of its type; times of day in one form."""
    bad = F.col(CORRUPT).isNotNull()
    if table == "sales":
        bad = bad | (F.col("sale_time").isNotNull() & time_of_day("sale_time").isNull())
        staged = staged.withColumn("_time", time_of_day("sale_time"))
    rows = staged.withColumn("_unparsed", bad)
    if table == "sales":
        rows = rows.withColumn("sale_time", F.coalesce("_time", "sale_time")).drop("_time")
    return rows


def _checked(
    table: str,
    staged: DataFrame,
    warehouse: Warehouse,
    keys: dict[str, tuple[str, ...]],
    targets: dict[str, DataFrame] | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """The staged rows with the rules they break, computed once into a table, after which the staging table goes.

    Keys must be unique among the rows and, with ``stored``, must not be those of stored rows. Rows are checked a portion
    after the other, so never more than one portion lies in shuffle files.
    """
    name, folder = warehouse.name(f"checked_{table}"), warehouse.work_folder()

    def keep(unknown: DataFrame) -> DataFrame:
        return materialized(unknown, f"{folder}/{unknown.columns[0]}")

    with shuffles_deleted(warehouse.spark):
        try:
            rows = mark(with_defaults(_parsed(table, staged), table), table, targets, keep)
            unparsed = F.when(F.col("_unparsed"), F.array(F.lit("PARSE"))).otherwise(F.col("broken_rules"))
            rows = rows.withColumn("broken_rules", unparsed)
            mode = "overwrite"
            for portion in _portions(table, rows, staged.count(), keys):
                for rule_id, key in keys.items():
                    portion = mark_duplicates(portion, key, rule_id, primary=rule_id == "DQ1")
                    if stored is not None:
                        portion = mark_known(portion, key, rule_id, stored)
                portion.drop("_unparsed").write.mode(mode).format("parquet").options(**COMPACT).saveAsTable(name)
                mode = "append"
        finally:
            delete_folder(warehouse.spark, folder)
    _drop_work_tables(warehouse, [table], ["staging"])
    return warehouse.spark.table(name)


def _valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("broken_rules") == 0).drop("broken_rules", CORRUPT)


def _rejects(table: str, checked: DataFrame) -> DataFrame:
    """Rejected rows of any table in one shape."""
    data = [c for c in checked.columns if c not in ("broken_rules", "created_at", "updated_at")]
    return checked.filter(F.size("broken_rules") > 0).select(
        F.lit(table).alias("table_name"), "broken_rules", F.to_json(F.struct(*data)).alias("source_row")
    )


def _keep_rejects(checked: dict[str, DataFrame], warehouse: Warehouse, load: int) -> None:
    warehouse.keep_rejected(reduce(DataFrame.unionByName, [_rejects(table, rows) for table, rows in checked.items()]), load)


def _drop_work_tables(warehouse: Warehouse, tables: Sequence[str] = tuple(DESCRIPTIONS), kinds: Sequence[str] = ("staging", "checked")) -> None:
    for table in tables:
        for kind in kinds:
            warehouse.spark.sql(f"DROP TABLE IF EXISTS {warehouse.name(f'{kind}_{table}')}")


def _returned(warehouse: Warehouse, load: int) -> DataFrame:
    return warehouse.rejected(load).drop("load")


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


SALE_KEYS: dict[str, tuple[str, ...]] = {}
STOCK_KEYS = {"DQ4": ("product_id", "store_id", "snapshot_date")}
FACT_KEYS = {"sales": SALE_KEYS, "inventory": STOCK_KEYS}


def _last_key(checked: DataFrame, table: str) -> int:
    return checked.agg(F.max(KEYS[table])).first()[0] or 0


def load_star(files: SourceFiles, calendar: DataFrame, warehouse: Warehouse) -> DataFrame:
    """Read, check and store all tables anew; returns the rejected rows.

    Files are parsed into staging tables and checked into ``checked_`` tables,
    each once; facts are checked against the new dimensions. Both go as soon as
    a table's rows, valid and rejected, are written. All five tables are
    written beside the old ones and change places at the end, so readers never
    see an empty or a missing table. Statistics are computed with histograms.
    Rejected rows are kept with the ids of the rules they break.
    """
    load = warehouse.next_load()
    for table in LAYOUTS:  # first of all, so that a load that breaks off keeps its number to itself
        _enter(table, content_digests(warehouse.spark, table, _paths(getattr(files, table))), warehouse, load)
    last_keys: dict[str, int] = {}
    written: dict[str, Written] = {"calendar": warehouse.write_dimension("calendar", calendar)}
    for table, paths, keys in (
        ("products", files.products, {"DQ1": ("product_id",), "DQ2": ("sku",)}),
        ("stores", files.stores, {"DQ1": ("store_id",), "DQ3": ("store_code",)}),
    ):
        checked = _checked(table, _stage(table, paths, warehouse, None), warehouse, keys)
        written[table] = warehouse.write_dimension(table, _valid(checked))
        _keep_rejects({table: checked}, warehouse, load)
        _drop_work_tables(warehouse, [table])

    targets = {name: warehouse.stored(written[name]) for name in ("products", "stores", "calendar")}
    for table in LAYOUTS:
        staged = _stage(table, _paths(getattr(files, table)), warehouse, KEYS[table])
        checked = _checked(table, staged, warehouse, FACT_KEYS[table], targets)
        written[table] = warehouse.write_fact(table, _complete(table, _valid(checked)), load, stored=True)
        _keep_rejects({table: checked}, warehouse, load)
        last_keys[table] = _last_key(checked, table)
        _drop_work_tables(warehouse, [table])
    for table in ("calendar", "products", "stores"):
        warehouse.switch(table, written[table], comment=DESCRIPTIONS[table])
    for table in LAYOUTS:
        warehouse.switch_fact(table, written[table], load, False, last_keys[table])
    _drop_work_tables(warehouse)
    warehouse.vacuum()
    warehouse.analyze(columns=True)
    return _returned(warehouse, load)


def _complete(table: str, rows: DataFrame) -> DataFrame:
    return with_inventory_value(rows) if table == "inventory" else rows


def _enter(table: str, digests: DataFrame, warehouse: Warehouse, load: int) -> None:
    warehouse.list_files(digests.select(F.lit(load).alias("load"), F.lit(table).alias("table_name"), "digest", "lines", "path"))


def _new_files(table: str, paths: Sequence[str], warehouse: Warehouse) -> DataFrame:
    """``path, digest, lines`` of the files whose content is not loaded yet; of equal ones the first path."""
    given = content_digests(warehouse.spark, table, paths)
    known = warehouse.loaded_files().where(F.col("table_name") == table).select("digest")
    fresh = given.join(known, "digest", "left_anti")
    return fresh.groupBy("digest").agg(F.min_by("path", "place").alias("path"), F.first("lines").alias("lines"))


def append(table: str, paths: str | Sequence[str], warehouse: Warehouse) -> DataFrame:
    """Add files to a stored fact, each content once; returns the rejected rows of this call.

    A file is known by the content of its lines, whatever its name and however
    it is cut into parts. Files that the fact already holds, and all but one of
    equal ones, are passed over. Keys continue after the largest one so far. Rows
    are checked against the dimensions as stored; a snapshot whose product,
    store and day are stored already breaks DQ4, and only the months of the new
    rows are read for that.

    The new rows, the rejected ones and the ledger's entries are written beside
    what is there. The switch to the fact's new version is the commit: before it
    nothing counts, and the call can be repeated.
    """
    fresh = {r["path"]: r for r in _new_files(table, _paths(paths), warehouse).collect()}
    load = warehouse.next_load()
    if not fresh:
        return _returned(warehouse, load)
    rows = [(r["digest"], r["lines"], r["path"]) for r in fresh.values()]
    _enter(table, warehouse.spark.createDataFrame(rows, "digest string, lines long, path string"), warehouse, load)
    staged = _stage(table, sorted(fresh), warehouse, KEYS[table], warehouse.last_key(table))
    targets = {name: warehouse.table(name) for name in ("products", "stores", "calendar")}
    stored = _stored_months(table, staged, warehouse) if FACT_KEYS[table] else None
    checked = _checked(table, staged, warehouse, FACT_KEYS[table], targets, stored)
    written = warehouse.write_fact(table, _complete(table, _valid(checked)), load, stored=True)
    _keep_rejects({table: checked}, warehouse, load)
    warehouse.switch_fact(table, written, load, True, _last_key(checked, table))
    _drop_work_tables(warehouse)
    warehouse.vacuum()
    return _returned(warehouse, load)


def _stored_months(table: str, staged: DataFrame, warehouse: Warehouse) -> DataFrame:
    """The stored rows of the months that staged rows are of."""
    layout = LAYOUTS[table]
    days = staged.select(F.trunc(layout.date, "MM").alias("month")).where("month IS NOT NULL").distinct().collect()
    return warehouse.table(table).where(F.col(layout.month).isin([month_number(r["month"]) for r in days]))


def append_sales(paths: str | Sequence[str], warehouse: Warehouse) -> DataFrame:
    """Add sale files, such as another year; see ``append``."""
    return append("sales", paths, warehouse)


def append_inventory(paths: str | Sequence[str], warehouse: Warehouse) -> DataFrame:
    """Add snapshot files; see ``append``."""
    return append("inventory", paths, warehouse)
