"""Registered queries: every plan and operator bound to the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope import testbind
from tillscope.functions.measures import net_sales, with_net
from tillscope.functions.periods import snapshots_between, sold_between
from tillscope.operators import calendar as cal
from tillscope.operators import keys, quality, validate
from tillscope.plans import advanced, inventory, kpi, metrics, products, sales, season, served, state, summary, tickets
from tillscope.plans.load import SourceFiles, append_inventory, append_sales, load_star
from tillscope.sources import csv
from tillscope.sources.shared import fresh_folder, materialized
from tillscope.sources.warehouse import Warehouse, analyze, statistics
from tillscope.star import Star

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2001, 7, 31)
YEAR = (date(2000, 1, 1), date(2000, 12, 31))
QUARTER = (date(2000, 10, 1), date(2000, 12, 31))
NOVEMBER = (date(2000, 11, 1), date(2000, 11, 30))
FIRST_QUARTER_2001 = (date(2001, 1, 1), date(2001, 3, 31))
LAST_MONTHS = date(2001, 5, 1)  # from here on facts are appended where a check needs an append
LONG = 2500  # look-back that holds repeated sales of a pair in the test tables


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double and short integers as bigint, for other engines."""
    kinds = {"decimal": "double", "int": "bigint", "smallint": "bigint", "tinyint": "bigint"}
    return df.select(
        *[F.col(f"`{n}`").cast(kinds[t.split("(")[0]]).alias(n) if t.split("(")[0] in kinds else F.col(f"`{n}`")
          for n, t in df.dtypes]
    )


def on_star(plan: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A plan over the star of the test tables."""
    return lambda spark, folder: comparable(plan(testbind.star(spark, folder), *args, **kwargs))


def on_spoiled(plan: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: comparable(plan(testbind.spoiled_star(spark, folder)))


def null_categories(star: Star) -> Star:
    """The star, one product in 31 without category; spoiled lines have NULL discounts too."""
    category = F.when(F.col("product_id") % 31 != 3, F.col("category"))
    products = star.products.filter("product_id IS NOT NULL").dropDuplicates(["product_id"])
    return Star(
        products=products.withColumn("category", category), stores=star.stores, calendar=star.calendar,
        sales=star.sales, inventory=star.inventory,
    )


def m3(star: Star) -> DataFrame:
    return summary.build_regional_performance(star, AS_OF)


def m4(star: Star) -> DataFrame:
    return summary.build_latest_inventory(star, AS_OF, days=365)


def m5(star: Star) -> DataFrame:
    return summary.build_recent_sales(star, AS_OF, days=LONG, min_days=2)


def m6(star: Star) -> DataFrame:
    return summary.build_inventory_alerts(star, m4(star), m5(star))


# Test parameters for the alert summaries; the defaults fit daily sales.
TEST_SUMMARIES = {
    **summary.SUMMARIES,
    "latest_inventory": summary.Summary(lambda s, _, d: m4(s), "inventory", "snapshot_date"),
    "recent_sales": summary.Summary(lambda s, _, d: m5(s), "inventory", "last_sale_date"),
}


def _database() -> str:
    return f"tillscope_{uuid.uuid4().hex[:12]}"


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, _database(), fresh_folder(spark))


def _store(spark: SparkSession) -> summary.SummaryStore:
    return summary.SummaryStore(spark, _database(), fresh_folder(spark))


# Sources, sinks and keys -------------------------------------------------------


def csv_round_trip(table: str) -> Query:
    """Write a table's exchange file and read it back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = testbind.star(spark, folder).tables()[table]
        if table == "stores":
            df = df.withColumn("opened_on", F.lit(None).cast("date"))
        path = fresh_folder(spark)
        csv.write_csv(df, table, path)
        return comparable(csv.read_csv(spark, table, path))

    return run


def sales_files_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Write one sales file set per year and read them as one table."""
    path = fresh_folder(spark)
    lines = testbind.sales(spark, folder)
    years = range(testbind.FIRST_DAY.year, testbind.LAST_DAY.year + 1)
    for year in years:
        csv.write_csv(lines.filter(F.year("sale_date") == year), "sales", f"{path}/sales_{year}")
    return comparable(csv.read_sales(spark, [f"{path}/sales_{year}" for year in years]))


def defaults(spark: SparkSession, folder: str) -> DataFrame:
    lines = testbind.sales(spark, folder).drop("discount_pct", "tax_pct", "channel")
    filled = csv.with_defaults(lines, "sales").withColumn("has_created_at", F.col("created_at").isNotNull())
    return comparable(filled.select("sale_id", "discount_pct", "tax_pct", "channel", "has_created_at"))


def inventory_value(star: Star) -> DataFrame:
    return csv.with_inventory_value(star.inventory.drop("stock_value")).select("inventory_id", "stock_value")


def stored_sales(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    warehouse.write_sales(testbind.sales(spark, folder))
    by_year = with_net(warehouse.table("sales")).groupBy("sale_year")
    return comparable(
        by_year.agg(F.count("*").alias("lines"), F.sum("quantity").alias("units"), net_sales().alias("net_sales"))
    )


def stored_later_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales moved a year ahead: the year after the calendar is stored too."""
    warehouse = _warehouse(spark)
    moved = testbind.sales(spark, folder).withColumn("sale_date", F.date_add("sale_date", 365))
    warehouse.write_sales(moved)
    outside = F.col("sale_date") > F.lit(testbind.LAST_DAY)
    return comparable(
        warehouse.table("sales")
        .groupBy("sale_year")
        .agg(F.count("*").alias("lines"), F.count_if(outside).alias("outside_calendar"))
    )


def stored_inventory(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    warehouse.write_table("inventory", testbind.star(spark, folder).inventory)
    columns = list(csv.CSV_HEADERS["inventory"].values())
    return comparable(warehouse.table("inventory").select(*columns))


def clear_and_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the emptied tables and of a reload into a second database."""
    star = testbind.star(spark, folder)
    cleared, reloaded = _warehouse(spark), _warehouse(spark)
    cleared.write_star(star)
    cleared.clear()
    reloaded.write_star(star)
    reloaded.clear()
    reloaded.write_star(star)
    parts = [
        validate.table_counts(w.star().tables()).withColumn("stage", F.lit(stage))
        for stage, w in (("cleared", cleared), ("reloaded", reloaded))
    ]
    return comparable(reduce(DataFrame.unionByName, parts))


def sale_keys(star: Star) -> DataFrame:
    keyed = keys.assign_keys(star.sales.drop("sale_id"), "sale_id", start_after=1000)
    return keyed.agg(
        F.lit("plain").alias("kind"),
        F.count("*").alias("rows"),
        F.count_distinct("sale_id").alias("distinct_keys"),
        F.count_if(F.col("sale_id") > 1000).alias("above_start"),
    )


def product_keys(star: Star) -> DataFrame:
    keyed = keys.assign_dense_keys(star.products.drop("product_id"), "product_id", ["sku"], start_after=1000)
    return keyed.agg(
        F.count("*").alias("rows"),
        F.count_distinct("product_id").alias("distinct_keys"),
        F.min("product_id").alias("first_key"),
        F.max("product_id").alias("last_key"),
    )


def key_status(spark: SparkSession, folder: str) -> DataFrame:
    star = testbind.star(spark, folder)
    keyed = {"products": (star.products, "product_id"), "stores": (star.stores, "store_id")}
    upcoming = {table: keys.next_key(df, key).first()["next_id"] for table, (df, key) in keyed.items()}
    return comparable(keys.key_status(spark, keyed, upcoming))


def analyzed_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Store sales, refresh their statistics, and read them from the catalog."""
    warehouse, columns = _warehouse(spark), ["product_id", "store_id", "sale_date"]
    warehouse.write_sales(testbind.sales(spark, folder))
    analyze(spark, warehouse.current_table("sales"), columns)
    return statistics(spark, warehouse.current_table("sales"), columns)


def estimated_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows behind filters on the loaded star, and whether the optimizer's estimate from its histograms is within a factor of 1.5."""
    star, path, warehouse = testbind.star(spark, folder), fresh_folder(spark), _warehouse(spark)
    load_star(_exchange_files(star, path), star.calendar, warehouse)
    wanted = {
        "sales before 1997": warehouse.table("sales").filter("sale_date < DATE '1997-01-01'"),
        "sales of a quarter": warehouse.table("sales").filter("sale_date BETWEEN DATE '2000-10-01' AND DATE '2000-12-31'"),
        "low product ids": warehouse.table("sales").filter("product_id <= 100"),
        "low stock": warehouse.table("inventory").filter("final_stock < 20"),
    }
    before = spark.conf.get("spark.sql.cbo.enabled")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        found = []
        for name, df in wanted.items():
            guess = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
            rows = df.count()
            found.append((name, rows, guess.isDefined() and rows / 1.5 <= int(str(guess.get())) <= rows * 1.5))
    finally:
        spark.conf.set("spark.sql.cbo.enabled", before)
    return spark.createDataFrame(found, "filter_name string, rows long, estimate_holds boolean")


def described_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions of the stored sales columns, with the lines that have a value in each."""
    warehouse = _warehouse(spark)
    warehouse.write_sales(testbind.sales(spark, folder))
    stored = warehouse.table("sales")
    filled = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).unpivot([], stored.columns, "col_name", "filled")
    notes = warehouse.descriptions("sales").filter("comment <> ''").select("col_name", "comment").distinct()
    return notes.join(filled, "col_name")


# Calendar ----------------------------------------------------------------------


def calendar_with_lines(*columns: str, where: str = "true") -> Query:
    """Calendar of the years sold in, with the lines sold per day."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        lines = testbind.sales(spark, folder)
        per_day = lines.groupBy(F.col("sale_date").alias("cal_date")).agg(F.count("*").alias("lines"))
        days = cal.calendar_covering(lines, "sale_date").filter(where)
        joined = days.join(per_day, "cal_date", "left")
        return comparable(joined.select("cal_date", *columns, F.coalesce("lines", F.lit(0)).alias("lines")))

    return run


def over_calendar(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: comparable(
        plan(cal.calendar_covering(testbind.sales(spark, folder), "sale_date"))
    )


FIXED_DATE_NAMES = ", ".join(f"'{rule.name}'" for rule in cal.HOLIDAYS if rule.iso_weekday is None)


# Validation, summaries, load -----------------------------------------------------


def summary_list(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark)
    summary.refresh(store, testbind.star(spark, folder), AS_OF, summary.group_names("inventory"), TEST_SUMMARIES)
    return comparable(summary.list_summaries(store))


def summary_count(star: Star) -> DataFrame:
    return validate.table_counts({"daily_sales": summary.build_daily_summary(star)})


def stored_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Files and sizes of the tables the star is read from; bytes differ by writer, so they are compared with the rows."""
    names = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")
    sizes = validate.table_sizes(spark, {name: f"{folder}/{name}.parquet" for name in names})
    counts = validate.table_counts({name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names})
    joined = sizes.join(counts, "table_name")
    return joined.select("table_name", "record_count", (F.col("bytes") >= F.col("record_count")).alias("a_byte_a_row"))


def file_profile(spark: SparkSession, folder: str) -> DataFrame:
    found = validate.profile_files(spark.read.parquet(f"{folder}/lineitem.parquet"))
    return found.select("file", "records", (F.col("size_mb") * 1048576 >= F.col("records")).alias("a_byte_a_row"))


def refreshed(*names: str, twice: bool = False) -> Query:
    """Refresh summaries (a second time, to swap versions) and report status."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        star, store = testbind.star(spark, folder), _store(spark)
        status = summary.refresh(store, star, AS_OF, names, TEST_SUMMARIES)
        if twice:
            status = summary.refresh(store, star, AS_OF, names, TEST_SUMMARIES)
        return comparable(status.drop("refreshed_at"))

    return run


def rebuilt(name: str, *names: str, twice: bool = False) -> Query:
    """Refresh summaries (a second time, to swap versions) and read one of them back."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        star, store = testbind.star(spark, folder), _store(spark)
        for _ in range(1 + twice):
            summary.refresh(store, star, AS_OF, names, TEST_SUMMARIES)
        return comparable(store.read(name))

    return run


def old_reader(spark: SparkSession, folder: str) -> DataFrame:
    """A reader opened before three refreshes still reads its version after them."""
    star, store = testbind.star(spark, folder), _store(spark)
    summary.refresh(store, star, AS_OF, ["daily_sales"])
    before = store.read("daily_sales")
    for _ in range(3):
        summary.refresh(store, star, AS_OF, ["daily_sales"])
    return comparable(before)


def all_stats(spark: SparkSession, folder: str) -> DataFrame:
    store = _store(spark)
    summary.refresh(store, testbind.star(spark, folder), AS_OF, TEST_SUMMARIES, TEST_SUMMARIES)
    return comparable(summary.summary_stats(store, AS_OF).drop("refreshed_at"))


def _exchange_files(star: Star, path: str) -> SourceFiles:
    for table in ("products", "stores", "sales", "inventory"):
        df = star.tables()[table]
        df = df.withColumn("opened_on", F.lit(None).cast("date")) if table == "stores" else df
        csv.write_csv(df, table, f"{path}/{table}", compression="gzip")
    return SourceFiles(f"{path}/products", f"{path}/stores", [f"{path}/sales"], f"{path}/inventory")


def _loaded_but_last_year(spark: SparkSession, folder: str) -> tuple[Star, Warehouse, str]:
    """A star, a warehouse loaded with all of it but the last year's facts, and a folder for further files."""
    star, path, warehouse = testbind.star(spark, folder), fresh_folder(spark), _warehouse(spark)
    year = testbind.LAST_DAY.year
    before = Star(
        products=star.products, stores=star.stores, calendar=star.calendar,
        sales=star.sales.filter(F.year("sale_date") < year), inventory=star.inventory.filter(F.year("snapshot_date") < year),
    )
    load_star(_exchange_files(before, path), star.calendar, warehouse)
    for table, day in (("sales", "sale_date"), ("inventory", "snapshot_date")):
        csv.write_csv(star.tables()[table].filter(F.year(day) == year), table, f"{path}/more_{table}")
    return star, warehouse, path


def appended(spark: SparkSession, folder: str) -> DataFrame:
    """Load all years but the last, append that one; per year the lines, keys, and whether keys follow the load's."""
    _, warehouse, path = _loaded_but_last_year(spark, folder)
    largest = warehouse.table("sales").agg(F.max("sale_id")).first()[0]
    append_sales([f"{path}/more_sales"], warehouse)
    return comparable(
        warehouse.table("sales").groupBy("sale_year").agg(
            F.count("*").alias("lines"), F.count_distinct("sale_id").alias("keys"),
            F.count_if(F.col("sale_id") > largest).alias("new_keys"), F.count("seller_id").alias("sellers"),
        )
    )


def appended_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Load the snapshots of all years but the last, append that one: every stored snapshot, and whether its key is new."""
    _, warehouse, path = _loaded_but_last_year(spark, folder)
    largest = warehouse.table("inventory").agg(F.max("inventory_id")).first()[0]
    append_inventory(f"{path}/more_inventory", warehouse)
    columns = [*csv.CSV_HEADERS["inventory"].values(), "stock_value"]
    stored = warehouse.table("inventory")
    return comparable(stored.select(*columns, (F.col("inventory_id") > largest).alias("is_new")))


class _BreaksOff(Warehouse):
    """A warehouse whose next switch of a fact fails, as if the driver were lost before the commit."""

    def switch_fact(self, *args, **kwargs) -> None:
        raise RuntimeError("broken off")


def appended_twice(spark: SparkSession, folder: str) -> DataFrame:
    """An append that breaks off before its commit, then the same files again and again, and under another name.

    Per fact and year the stored rows, and the rows of the files that the ledger holds.
    """
    star, warehouse, path = _loaded_but_last_year(spark, folder)
    broken = _BreaksOff(spark, warehouse.database)
    for table, day, append in (("sales", "sale_date", append_sales), ("inventory", "snapshot_date", append_inventory)):
        try:
            append([f"{path}/more_{table}"], broken)
        except RuntimeError:
            pass
        append([f"{path}/more_{table}"], warehouse)
        append([f"{path}/more_{table}"], warehouse)
        moved = star.tables()[table].filter(F.year(day) == testbind.LAST_DAY.year).repartition(3)
        csv.write_csv(moved, table, f"{path}/other_{table}")
        append([f"{path}/other_{table}"], warehouse)
    listed = warehouse.loaded_files().groupBy("table_name").agg(F.sum("lines").alias("file_lines"))
    counts = [
        warehouse.table(table).groupBy(F.lit(table).alias("table_name"), F.year(day).alias("year")).agg(F.count("*").alias("rows"))
        for table, day in (("sales", "sale_date"), ("inventory", "snapshot_date"))
    ]
    return comparable(reduce(DataFrame.unionByName, counts).join(listed, "table_name"))


def rejected_again(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots that are stored already, given again beside new ones: rejected rows by load and rule."""
    star, warehouse, path = _loaded_but_last_year(spark, folder)
    years = testbind.LAST_DAY.year
    overlapping = star.inventory.filter(F.year("snapshot_date") >= years - 1)
    csv.write_csv(overlapping, "inventory", f"{path}/overlapping")
    append_inventory(f"{path}/overlapping", warehouse)
    rules = warehouse.rejected().select("load", F.explode("broken_rules").alias("rule_id"))
    stored = warehouse.table("inventory").agg(F.count("*").alias("stored_rows"))
    counted = rules.groupBy("load", "rule_id").agg(F.count("*").alias("rejected_rows"))
    return comparable(counted.withColumn("stored_rows", F.lit(stored.first()[0])))


def _stored_star(spark: SparkSession, folder: str) -> tuple[Warehouse, Callable[[], None]]:
    """A warehouse with all facts but those of the last three months, and a function that appends these."""
    star, warehouse = testbind.star(spark, folder), _warehouse(spark)
    days = {"sales": "sale_date", "inventory": "snapshot_date"}
    for table in ("products", "stores", "calendar"):
        warehouse.write_table(table, star.tables()[table])
    for table, day in days.items():
        warehouse.write_table(table, star.tables()[table].filter(F.col(day) < F.lit(LAST_MONTHS)))

    def append() -> None:
        for table, day in days.items():
            warehouse.write_table(table, star.tables()[table].filter(F.col(day) >= F.lit(LAST_MONTHS)), "append")

    return warehouse, append


def refreshed_after_append(name: str) -> Query:
    """Build a summary, append three months, refresh it: the summary as readers see it."""
    names = [*summary.SUMMARIES[name].needs, name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        warehouse, append = _stored_star(spark, folder)
        store = _store(spark)
        summary.refresh(store, warehouse.star(), AS_OF, names)
        append()
        summary.refresh(store, warehouse.star(), AS_OF, names)
        return comparable(store.read(name))

    return run


def rewritten_months(spark: SparkSession, folder: str) -> DataFrame:
    """Months of the daily summary that a refresh after an append wrote, and those it kept, with their rows."""
    warehouse, append = _stored_star(spark, folder)
    store = _store(spark)
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    before = {p["written_as"] for p in store.parts("daily_sales")}
    append()
    summary.refresh(store, warehouse.star(), AS_OF, ["daily_sales"])
    rows = spark.table(store.current_table("daily_sales"))
    written = (~F.col("written_as").isin(sorted(before))).alias("rewritten")
    return comparable(rows.groupBy("year", "month", written).agg(F.count("*").alias("rows")))


def positions_after_append(spark: SparkSession, folder: str) -> DataFrame:
    """Maintained positions after an append: alerts over the latest snapshot of every pair."""
    warehouse, append = _stored_star(spark, folder)
    store = _store(spark)
    state.refresh_positions(store, warehouse.star())
    append()
    star = warehouse.star()
    positions = state.refresh_positions(store, star)
    return comparable(inventory.inventory_alerts_full(star, AS_OF, lookback_days=LONG, min_days=2, positions=positions))


def latest_from_positions(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, append = _stored_star(spark, folder)
    store = _store(spark)
    append()
    star = warehouse.star()
    positions = state.refresh_positions(store, star)
    return comparable(summary.build_latest_inventory(star, AS_OF, days=365, positions=positions))


def margin_from_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Margin of a year over cost intervals that were brought up to date after an append."""
    warehouse, append = _stored_star(spark, folder)
    store = _store(spark)
    state.refresh_costs(store, warehouse.star())
    append()
    star = warehouse.star()
    return comparable(metrics.margin(star, *YEAR, state.refresh_costs(store, star)))


def cost_intervals(spark: SparkSession, folder: str) -> DataFrame:
    warehouse, append = _stored_star(spark, folder)
    append()
    intervals = state.refresh_costs(_store(spark), warehouse.star())
    return comparable(intervals.select("product_id", "store_id", "unit_cost", "valid_from", "valid_to", "cost_year"))


def served_read(read: Callable[[summary.SummaryStore], DataFrame]) -> Query:
    """A dashboard read over the tables that are kept ready for it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        star, store = testbind.star(spark, folder), _store(spark)
        names = ["regional_performance", "daily_sales", *summary.group_names("inventory")]
        summary.refresh(store, star, AS_OF, names, TEST_SUMMARIES)
        served.refresh(store, AS_OF)
        return comparable(read(store))

    return run


def read_beside_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that readers count after a reload, an archive run and a clearing, having opened the tables before."""
    star, warehouse = testbind.star(spark, folder), _warehouse(spark)
    warehouse.write_star(star)
    opened = warehouse.star().tables()
    warehouse.write_table("products", star.products.limit(1))
    warehouse.write_sales(star.sales.filter(F.col("sale_date") >= F.lit(LAST_MONTHS)))
    warehouse.archive_before(testbind.LAST_DAY, "old_sales")
    warehouse.clear()
    return comparable(validate.table_counts(opened))


def read_one_month(spark: SparkSession, folder: str) -> DataFrame:
    """A month of both stored facts by day, with the number of month folders that its files lie in."""
    star, warehouse = testbind.star(spark, folder), _warehouse(spark)
    for table in ("sales", "inventory"):
        warehouse.write_table(table, star.tables()[table])
    parts = []
    for table, day, cut in (("sales", "sale_date", sold_between), ("inventory", "snapshot_date", snapshots_between)):
        rows = cut(warehouse.table(table), *NOVEMBER)
        month = F.regexp_extract(F.input_file_name(), r"_month=(\d+)", 1)
        per_day = rows.withColumn("folder", month).groupBy(F.col(day).alias("day"))
        counted = per_day.agg(F.count("*").alias("rows"), F.count_distinct("folder").alias("folders"))
        parts.append(counted.withColumn("table_name", F.lit(table)))
    return comparable(reduce(DataFrame.unionByName, parts))


def by_category_with_large_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary by category where the catalogue is too large to be broadcast and one product has a third of the lines."""
    star = testbind.star(spark, folder)
    hot = F.when(F.col("sale_id") % 3 == 0, F.lit(1)).otherwise(F.col("product_id")).cast("bigint").alias("product_id")
    lines = star.sales.select(*[hot if c == "product_id" else c for c in star.sales.columns])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        skewed = Star(**{**star.tables(), "sales": lines})
        return comparable(materialized(summary.build_daily_summary(skewed, by_category=True)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def tickets_of_buckets(plan: Callable[..., DataFrame]) -> Query:
    """A ticket plan over sales that are stored in buckets of tickets."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        star = testbind.star(spark, folder)
        warehouse = Warehouse(spark, _database(), fresh_folder(spark), ticket_buckets=8)
        for table in ("products", "stores", "calendar", "sales"):
            warehouse.write_table(table, star.tables()[table])
        stored = {t: warehouse.table(t) for t in ("products", "stores", "calendar", "sales")}
        return comparable(plan(Star(**stored, inventory=star.inventory), *YEAR))

    return run


def loaded(spark: SparkSession, folder: str) -> DataFrame:
    """Stage exchange files with faults in them; rejected rows per rule."""
    star, path = testbind.spoiled_star(spark, folder), fresh_folder(spark)
    rejected = load_star(_exchange_files(star, path), star.calendar, _warehouse(spark))
    return (
        rejected.select("table_name", F.explode("broken_rules").alias("rule_id"))
        .groupBy("table_name", "rule_id")
        .agg(F.count("*").alias("rejected_rows"))
    )


def archived(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per year in the sales table and the archive after moving a year."""
    warehouse = _warehouse(spark)
    warehouse.write_sales(testbind.sales(spark, folder))
    archive = f"{warehouse.database}.sales_archive"
    warehouse.archive_year(testbind.FIRST_DAY.year, archive)
    parts = [
        spark.table(table).groupBy("sale_year").agg(F.count("*").alias("lines")).withColumn("place", F.lit(place))
        for table, place in ((warehouse.name("sales"), "current"), (archive, "archive"))
    ]
    return comparable(reduce(DataFrame.unionByName, parts))


QUERIES: dict[str, Query] = {
    "q1_1_daily_sales_by_chain": on_star(sales.daily_sales_by_chain, *YEAR),
    "q1_2_weekly_sales_trend": on_star(sales.weekly_sales_trend, AS_OF),
    "q1_3_store_ranking": on_star(sales.store_ranking, *QUARTER),
    "q2_1_top_products": on_star(products.top_products, 2000, 4),
    "q2_2_top_products_by_region": on_star(products.top_products_by_region, AS_OF),
    "q2_3_sales_by_channel": on_star(products.sales_by_channel, *YEAR),
    "q3_1_weekly_ticket_by_format": on_star(tickets.weekly_ticket_by_format, *YEAR),
    "q3_1_weekly_ticket_by_format_per_ticket": on_star(tickets.weekly_ticket_by_format, *YEAR, per_ticket=True),
    "q3_2_monthly_ticket_by_region": on_star(tickets.monthly_ticket_by_region, *YEAR),
    "q3_1_weekly_ticket_of_buckets": tickets_of_buckets(tickets.weekly_ticket_by_format),
    "q3_2_monthly_ticket_of_buckets": tickets_of_buckets(tickets.monthly_ticket_by_region),
    "q3_3_hourly_tickets": on_star(tickets.hourly_tickets, *NOVEMBER),
    "q4_1_stock_alerts": on_star(inventory.stock_alerts, AS_OF, lookback_days=LONG, min_obs=2, fresh_days=365),
    "q4_2_inventory_turnover": on_star(inventory.inventory_turnover, *YEAR),
    "q4_3_stockout_frequency": on_star(inventory.stockout_frequency, *YEAR, min_snapshots=3),
    "q5_1_seasonality_index": on_star(season.seasonality_index, 1998, 2000),
    "q5_2_holiday_impact": on_star(season.holiday_impact, 1998, 2000),
    "q5_2_holiday_impact_corrected": on_star(season.holiday_impact, 1998, 2000, corrected=True),
    "kpi1_sales_vs_previous": on_star(kpi.sales_vs_previous, AS_OF),
    "kpi2_top_bottom_stores": on_star(kpi.top_bottom_stores, AS_OF, min_days=3),
    "kpi3_category_matrix": on_star(kpi.category_matrix, AS_OF),
    "kpi4_channel_performance": on_star(kpi.channel_performance, AS_OF),
    "kpi5_inventory_health": on_star(kpi.inventory_health, AS_OF, days=31),
    "a1_category_affinity": on_star(advanced.category_affinity, *QUARTER),
    "a2_weekly_trend": on_star(advanced.weekly_trend, 1998, 2000, 2000),
    "a3_price_elasticity": on_star(advanced.price_elasticity, *YEAR, min_stores=2),
    "a4_store_segments": on_star(advanced.store_segments, *YEAR, min_days=15),
    "a5_store_cohort": on_star(advanced.store_cohort, *YEAR),
    "m1_daily_summary": on_star(summary.build_daily_summary),
    "m1_refresh_after_append": refreshed_after_append("daily_sales"),
    "m1_rewritten_months": rewritten_months,
    "m2_refresh_after_append": refreshed_after_append("product_performance"),
    "m3_refresh_after_append": refreshed_after_append("regional_performance"),
    "m4_maintained_positions": latest_from_positions,
    "m2_product_performance": on_star(summary.build_product_performance),
    "m3_regional_performance": on_star(m3),
    "m4_latest_inventory": on_star(m4),
    "m5_recent_sales": on_star(m5),
    "m6_inventory_alerts": on_star(m6),
    "m7_rebuild": rebuilt("daily_sales", "daily_sales", twice=True),
    "m8_refresh_sales_summaries": rebuilt(
        "product_performance", "daily_sales", "product_months", "product_performance"
    ),
    "m9_refresh_regional": rebuilt("regional_performance", "regional_performance"),
    "m10_refresh_inventory": rebuilt("inventory_alerts", *summary.group_names("inventory")),
    "m11_refresh_beside_readers": old_reader,
    "m12_refresh_status": refreshed("store_performance"),
    "e1_daily_sales_by_chain_quarter": on_star(sales.daily_sales_by_chain_quarter, *QUARTER),
    "e2a_regional_ranking": on_star(products.regional_ranking, AS_OF),
    "e2b_regional_ranking_fast": on_star(lambda s: products.regional_ranking_fast(m3(s), AS_OF)),
    "e2b_regional_ranking_served": served_read(served.regional_ranking),
    "e3b_critical_alerts_served": served_read(served.critical_alerts),
    "r1_daily_kpis_served": served_read(lambda store: served.daily_kpis(store, AS_OF, "BUILDING")),
    "r2_top_in_category_region_served": served_read(lambda store: served.top_in_category_region(store, "ECONOMY", "ASIA")),
    "e3a_inventory_alerts_full": on_star(inventory.inventory_alerts_full, AS_OF, lookback_days=LONG, min_days=2),
    "e3a_inventory_alerts_of_positions": positions_after_append,
    "e3b_critical_alerts": on_star(lambda s: inventory.critical_alerts(m6(s))),
    "r1_daily_kpis": on_star(lambda s: summary.daily_kpis(summary.build_daily_summary(s), AS_OF, "BUILDING")),
    "r2_top_in_category_region": on_star(
        lambda s: products.top_in_category_region(m3(s), AS_OF, "ECONOMY", "ASIA")
    ),
    "r3_ticket_by_format": on_star(tickets.ticket_by_format, *FIRST_QUARTER_2001),
    "r4_alerts_for_chain": on_star(lambda s: inventory.alerts_for_chain(m6(s), "FURNITURE")),
    "s1_read_products": csv_round_trip("products"),
    "s2_read_stores": csv_round_trip("stores"),
    "s3_read_sales": sales_files_by_year,
    "s4_read_inventory": csv_round_trip("inventory"),
    "s5_with_defaults": defaults,
    "s6_with_inventory_value": on_star(inventory_value),
    "s7_write_sales": stored_sales,
    "s8_catch_all_years": stored_later_sales,
    "s9_write_table": stored_inventory,
    "s10_write_csv": csv_round_trip("sales"),
    "s9_read_one_month": read_one_month,
    "s11_clear_and_reload": clear_and_reload,
    "s11_readers_beside_changes": read_beside_changes,
    "s12_assign_keys": on_star(sale_keys),
    "s12_assign_dense_keys": on_star(product_keys),
    "s13_key_status": key_status,
    "s14_analyze": analyzed_sales,
    "s14_estimates": estimated_rows,
    "s15_descriptions": described_sales,
    "c1_date_series": calendar_with_lines(),
    "c2_date_parts": calendar_with_lines("day", "month", "quarter", "year"),
    "c3_iso_weekday": calendar_with_lines("iso_weekday"),
    "c4_iso_week": calendar_with_lines("iso_week", "year"),
    "c5_padded_names": calendar_with_lines("day_name", "month_name"),
    "c6_weekend_flag": calendar_with_lines("is_weekend"),
    "c7_fiscal_period": calendar_with_lines("fiscal_period"),
    "c8_fixed_holidays": calendar_with_lines(
        "holiday_name", "is_holiday", where=f"holiday_name IN ({FIXED_DATE_NAMES})"
    ),
    "c9_floating_holidays": calendar_with_lines(
        "holiday_name", "is_holiday", where=f"is_holiday AND holiday_name NOT IN ({FIXED_DATE_NAMES})"
    ),
    "c10_calendar_summary": over_calendar(cal.calendar_summary),
    "c11_holiday_list": over_calendar(cal.holiday_list),
    "v1_orphan_sales": on_spoiled(
        lambda s: validate.orphan_count(s.sales, s.products, "product_id", "Orphaned sales records")
    ),
    "v2_orphan_inventory": on_spoiled(
        lambda s: validate.orphan_count(s.inventory, s.products, "product_id", "Orphaned inventory records")
    ),
    "v3_table_counts": on_star(lambda s: validate.table_counts(s.tables())),
    "v4_date_span": on_star(lambda s: validate.date_span(s.sales)),
    "v5_daily_net_by_chain": on_star(sales.daily_net_by_chain, *QUARTER),
    "v6_list_summaries": summary_list,
    "v7_summary_row_count": on_star(summary_count),
    "v8_table_sizes": stored_sizes,
    "v9_profile_files": file_profile,
    "x1_store_performance": on_star(summary.build_store_performance),
    "x2_store_vs_chain": on_star(metrics.store_vs_chain, *QUARTER),
    "x3_margin": on_star(metrics.margin, *YEAR),
    "x3_margin_of_intervals": margin_from_intervals,
    "x3_cost_intervals": cost_intervals,
    "x4_sales_by_weekday": on_star(season.sales_by_weekday, 1998, 2000),
    "x5_gross_sales": on_star(metrics.gross_sales, *YEAR),
    "x6_low_stock_share": on_star(metrics.low_stock_share, AS_OF, days=31),
    "x7_product_velocity": on_star(summary.build_product_performance, velocity=True),
    "x8_daily_summary_by_category": on_star(summary.build_daily_summary, by_category=True),
    "x8_by_category_large_catalogue": by_category_with_large_catalogue,
    "x9_summary_stats": all_stats,
    "x10_load_pipeline": loaded,
    "x10_append_year": appended,
    "x10_append_inventory": appended_inventory,
    "x10_append_twice": appended_twice,
    "x10_rejects_of_loads": rejected_again,
    "x11_archive_year": archived,
    "x12_freshness": refreshed("daily_sales", "regional_performance"),
    "x13_daily_change": on_star(lambda s: summary.with_day_before(summary.build_daily_summary(s))),
    "a1_category_affinity_with_nulls": on_spoiled(
        lambda s: advanced.category_affinity(null_categories(s), *YEAR, min_pairs=1, n=1000)
    ),
    "dq_all_rules": on_spoiled(quality.check),
}
for _number in range(1, 23):
    QUERIES[f"dq{_number}_rule"] = on_spoiled(lambda s, rule=f"DQ{_number}": quality.check(s, {rule}))
