"""Summary tables, their refresh, and their status."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions.measures import NET_X100, change_pct, money, net_sales, ratio, share_pct, with_net
from tillscope.functions.periods import (
    calendar_days,
    days_before,
    month_number,
    month_of_number,
    months_before,
    snapshots_between,
    sold_between,
)
from tillscope.operators.joins import with_day, with_product, with_product_of_lines, with_store
from tillscope.operators.quality import CHANNELS
from tillscope.operators.ranking import rank_descending
from tillscope.plans.inventory import PAIR, label_priority, latest_stock, recent_sales, with_supply
from tillscope.plans.state import current_positions
from tillscope.sources.schema import STOCK_VALUE
from tillscope.sources.shared import scratch
from tillscope.sources.versions import MADE_FROM, Part, VersionedTables, Written
from tillscope.sources.warehouse import analyze
from tillscope.star import Star


def build_daily_summary(star: Star, by_category: bool = False) -> DataFrame:
    """Tickets, units and net sales per day, chain, format and region.

    The calendar joins the aggregate, not the lines. ``by_category`` adds the
    product category; tickets are then counted once in each of theirs. A large
    catalogue meets the lines then, without its products of many lines moving.
    """
    keys = ["chain", "format", "region"]
    lines = with_store(with_net(star.sales), star.stores, *keys)
    if by_category:
        lines = with_product_of_lines(lines, star.products, "category", counted=star.sales)
        keys = [*keys, "category"]
    per_day = lines.groupBy("sale_date", *keys).agg(
        F.count_distinct("ticket_id").alias("tickets"),
        F.sum("quantity").alias("units"),
        net_sales().alias("net_sales"),
    )
    dated = with_day(per_day, calendar_days(star.calendar), "year", "month", "month_name", "day_name")
    return dated.select(
        "sale_date", "year", "month", "month_name", "day_name", *keys, "tickets", "units", "net_sales"
    )


def build_product_months(star: Star, velocity: bool = False) -> DataFrame:
    """Monthly units and net sales per product.

    ``velocity`` adds the sale days of the month and the units per sale day.
    """
    measures = [F.sum("quantity").alias("units"), net_sales().alias("net_sales")]
    if velocity:
        measures.append(F.count_distinct("sale_date").alias("sale_days"))
    monthly = (
        with_net(star.sales)
        .withColumn("month", F.trunc("sale_date", "MM"))
        .groupBy("product_id", "month")
        .agg(*measures)
    )
    if velocity:
        monthly = monthly.withColumn("units_per_sale_day", ratio("units", "sale_days"))
    more = ["sale_days", "units_per_sale_day"] if velocity else []
    return with_product(monthly, star.products, "product_name", "category", "brand").select(
        "month", "product_id", "product_name", "category", "brand", "units", "net_sales", *more
    )


def rank_product_months(months: DataFrame) -> DataFrame:
    """Rank of each product in its category and month.

    The ranking reads its input twice (band sizes, then rows), so a refresh
    gives it the stored product months instead of the sale lines.
    """
    ranked = rank_descending(months, ["category", "month"], "net_sales", "category_month_rank")
    return ranked.select(*months.columns, "category_month_rank")


def build_product_performance(star: Star, velocity: bool = False) -> DataFrame:
    """Product months with their rank, straight from the star."""
    return rank_product_months(build_product_months(star, velocity))


def build_regional_performance(star: Star, as_of: date, months: int = 6) -> DataFrame:
    """Net sales, units, stores and tickets per region, product and month."""
    lines = with_net(sold_between(star.sales, months_before(as_of, months)))
    monthly = (
        with_store(lines, star.stores, "region")
        .withColumn("month", F.trunc("sale_date", "MM"))
        .groupBy("product_id", "region", "month")
        .agg(
            net_sales().alias("net_sales"),
            F.sum("quantity").alias("units"),
            F.count_distinct("store_id").alias("stores"),
            F.count_distinct("ticket_id").alias("tickets"),
        )
    )
    return with_product(monthly, star.products, "category", "brand", "product_name").select(
        "region", "product_id", "category", "brand", "product_name", "month",
        "net_sales", "units", "stores", "tickets",
    )


def build_latest_inventory(
    star: Star, as_of: date, days: int = 30, positions: DataFrame | None = None
) -> DataFrame:
    """Newest snapshot per pair among those of the last days.

    The newest of all is the newest of the last days or there is none in them,
    so maintained ``positions`` (``plans/state``) only need a filter.
    """
    first = days_before(as_of, days)
    if positions is None:
        latest = latest_stock(snapshots_between(star.inventory, first))
    else:
        latest = positions.filter(F.col("snapshot_date") >= F.lit(first))
    return latest.withColumn(
        "stock_value", (F.col("final_stock") * F.col("unit_cost")).cast(STOCK_VALUE)
    )


def build_recent_sales(star: Star, as_of: date, days: int = 30, min_days: int = 3) -> DataFrame:
    return recent_sales(star, as_of, days, min_days)


def build_inventory_alerts(
    star: Star, latest: DataFrame, recent: DataFrame, low: int = 7, high: int = 60
) -> DataFrame:
    """Alerts with days of supply and priority, from the two summaries before it."""
    sold = recent.select(*PAIR, "avg_daily_sales", "last_sale_date")
    rows = with_supply(latest.join(sold, PAIR, "left"), low, high)
    rows = with_store(rows, star.stores, "chain", "store_name", "region")
    rows = with_product(rows, star.products, "category", "brand", "product_name")
    return rows.withColumn("priority", label_priority(F.col("alert"))).select(
        *PAIR, "category", "brand", "product_name", "chain", "store_name", "region", "final_stock",
        "avg_daily_sales", "days_of_supply", "alert", "snapshot_date", "last_sale_date", "priority",
    )


def build_store_performance(star: Star) -> DataFrame:
    """Sales, productivity and channel mix per store; lines of no listed channel are the share of others."""
    net = F.col(NET_X100)
    per_channel = [
        money(F.sum(F.when(F.col("channel") == c, net))).alias(f"net_{c.replace('-', '_')}") for c in CHANNELS
    ]
    listed = F.coalesce(F.col("channel").isin(*CHANNELS), F.lit(False))
    per_channel.append(money(F.sum(F.when(~listed, net))).alias("net_other"))
    per_store = (
        with_net(star.sales)
        .groupBy("store_id")
        .agg(
            F.sum("quantity").alias("units"),
            F.count_distinct("ticket_id").alias("tickets"),
            net_sales().alias("net_sales"),
            *per_channel,
        )
    )
    shares = [
        F.coalesce(share_pct(f"net_{c}", "net_sales"), F.lit(0.0)).alias(f"share_{c}_pct")
        for c in (*(name.replace("-", "_") for name in CHANNELS), "other")
    ]
    return with_store(
        per_store, star.stores, "store_name", "chain", "format", "region", "floor_area_m2"
    ).select(
        "store_id", "store_name", "chain", "format", "region", "units", "tickets", "net_sales",
        ratio("net_sales", "tickets").alias("net_per_ticket"),
        ratio("net_sales", "floor_area_m2").alias("net_per_m2"),
        *shares,
    )


def daily_kpis(daily: DataFrame, as_of: date, chain: str, days: int = 7) -> DataFrame:
    """Daily net sales, tickets and net per ticket of a chain, from the daily summary."""
    rows = daily.filter((F.col("sale_date") >= F.lit(days_before(as_of, days))) & (F.col("chain") == chain))
    first = days_before(as_of, days)
    if {"year", "month"} <= set(daily.columns):
        # The folders of stored summaries, which Spark cannot derive from the date.
        later = (F.col("year") == first.year) & (F.col("month") >= first.month)
        rows = rows.filter((F.col("year") > first.year) | later)
    return (
        rows.groupBy("sale_date", "chain")
        .agg(F.sum("net_sales").cast("decimal(38,6)").alias("net_sales"), F.sum("tickets").alias("tickets"))
        .withColumn("net_per_ticket", ratio("net_sales", "tickets"))
        .orderBy(F.desc("sale_date"))
    )


def with_day_before(daily: DataFrame) -> DataFrame:
    """The daily summary with net sales and tickets of the day before, and the change of net sales in percent.

    The day before is the calendar day, so after a day without sales it is NULL.
    """
    keys = ["chain", "format", "region"]
    before = daily.select(
        F.date_add("sale_date", 1).alias("sale_date"), *keys,
        F.col("net_sales").alias("net_sales_before"), F.col("tickets").alias("tickets_before"),
    )
    joined = daily.join(before, ["sale_date", *keys], "left")
    return joined.withColumn("change_pct", change_pct("net_sales", "net_sales_before"))


class SummaryStore(VersionedTables):
    """Published summary tables of one database.

    Every refresh makes a new version and then points the view of the summary's
    name at it; a summary kept by month shares the folders of months that have
    not changed with the version before. A reader that has started keeps the
    version it opened; the last ``keep`` versions are kept, so it survives
    ``keep - 1`` refreshes. What an attempt that broke off has left is in
    nobody's way, and the next refresh clears it.
    """

    def publish(
        self, name: str, df: DataFrame, as_of: date, freshness: str | None = None, partition_by: Sequence[str] = ()
    ) -> None:
        """Write a new version and switch readers to it."""
        self._release(name, self.write(name, df, partition_by), (), as_of, freshness)

    def publish_months(
        self,
        name: str,
        df: DataFrame | None,
        kept: Sequence[Part],
        digests: dict[int, str],
        month: Column,
        as_of: date,
        freshness: str | None,
        partition_by: Sequence[str],
    ) -> None:
        """Write some months (``df``), share the kept ones, and switch readers to the version of both.

        ``digests`` of the written months go into their folders' names; ``month`` gives a row's month as a number.
        """
        written = None
        if df is not None:
            pairs = [F.lit(x) for pair in {0: "", **digests}.items() for x in pair]
            written = self.write(name, df, partition_by, F.coalesce(F.create_map(*pairs)[month], F.lit("")))
        self._release(name, written, kept, as_of, freshness)

    def _release(
        self, name: str, written: Written | None, kept: Sequence[Part], as_of: date, freshness: str | None
    ) -> None:
        moment = datetime.now(timezone.utc).isoformat(timespec="seconds")
        notes = {"refreshed_at": moment, "as_of": str(as_of), "freshness_column": freshness or ""}
        self.switch(name, written, kept, notes)
        analyze(self.spark, self.current_table(name))


@dataclass(frozen=True)
class Months:
    """A summary whose months can be built alone.

    ``build`` gets the months as numbers like 202406; ``number`` is an
    expression of a row's month; ``of_part`` the month of a stored partition. ``since`` is the first
    month that the summary holds, by the day it is made for.
    """

    build: Callable[[Star, SummaryStore, date, list[int]], DataFrame]
    number: str
    of_part: Callable[[Part], int]
    since: Callable[[date], date] | None = None
    fact: str = "sales"

    def wanted(self, star: Star, as_of: date) -> dict[int, str]:
        first = month_number(self.since(as_of)) if self.since else 0
        return {m: digest for m, digest in star.tracker.changes(self.fact).items() if m >= first}


@dataclass(frozen=True)
class Summary:
    """How a summary is built from the star and the summaries before it."""

    build: Callable[[Star, SummaryStore, date], DataFrame]
    group: str
    freshness: str | None = None
    partition_by: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    months: Months | None = None


def _of_dated(part: Part) -> int:
    """Month of a partition named by its first day."""
    return month_number(date.fromisoformat(part["month"]))


def _by_date(build: Callable[[Star], DataFrame]) -> Months:
    """Months of a daily summary, whose partitions are named by year and month."""
    return Months(
        lambda s, _, d, months: build(s.of_months("sales", months)),
        "year * 100 + month",
        lambda part: int(part["year"]) * 100 + int(part["month"]),
    )


def _by_month(
    build: Callable[[Star, SummaryStore, date, list[int]], DataFrame], since: Callable[[date], date] | None = None
) -> Months:
    return Months(build, "year(month) * 100 + month(month)", _of_dated, since)


def _months_of(rows: DataFrame, months: list[int]) -> DataFrame:
    return rows.where(F.col("month").isin([month_of_number(m) for m in months]))


# In dependency order: the ranked products read the product months, the alerts the
# two inventory summaries before them.
SUMMARIES = {
    "daily_sales": Summary(
        lambda s, _, d: build_daily_summary(s), "sales", "sale_date", ("year", "month"), months=_by_date(build_daily_summary)
    ),
    "product_months": Summary(
        lambda s, _, d: build_product_months(s),
        "sales",
        "month",
        ("month",),
        months=_by_month(lambda s, _, d, months: build_product_months(s.of_months("sales", months))),
    ),
    "product_performance": Summary(
        lambda s, store, d: rank_product_months(store.read("product_months")),
        "sales",
        "month",
        ("month",),
        needs=("product_months",),
        months=_by_month(lambda s, store, d, months: rank_product_months(_months_of(store.read("product_months"), months))),
    ),
    "daily_sales_by_category": Summary(
        lambda s, _, d: build_daily_summary(s, by_category=True),
        "variants",
        "sale_date",
        ("year", "month"),
        months=_by_date(lambda s: build_daily_summary(s, by_category=True)),
    ),
    "product_velocity_months": Summary(
        lambda s, _, d: build_product_months(s, velocity=True),
        "variants",
        "month",
        ("month",),
        months=_by_month(lambda s, _, d, months: build_product_months(s.of_months("sales", months), velocity=True)),
    ),
    "product_velocity": Summary(
        lambda s, store, d: rank_product_months(store.read("product_velocity_months")),
        "variants",
        "month",
        ("month",),
        needs=("product_velocity_months",),
        months=_by_month(
            lambda s, store, d, months: rank_product_months(_months_of(store.read("product_velocity_months"), months))
        ),
    ),
    "regional_performance": Summary(
        lambda s, _, d: build_regional_performance(s, d),
        "regional",
        "month",
        ("month",),
        months=_by_month(
            lambda s, _, d, months: build_regional_performance(s.of_months("sales", months), d),
            since=lambda d: months_before(d, 6),
        ),
    ),
    "store_performance": Summary(lambda s, _, d: build_store_performance(s), "sales"),
    "latest_inventory": Summary(
        lambda s, store, d: build_latest_inventory(s, d, positions=current_positions(store, s)), "inventory", "snapshot_date"
    ),
    "recent_sales": Summary(lambda s, _, d: build_recent_sales(s, d), "inventory", "last_sale_date"),
    "inventory_alerts": Summary(
        lambda s, store, d: build_inventory_alerts(s, store.read("latest_inventory"), store.read("recent_sales")),
        "inventory",
        "snapshot_date",
        needs=("latest_inventory", "recent_sales"),
    ),
}


def group_names(group: str, summaries: dict[str, Summary] = SUMMARIES) -> list[str]:
    return [name for name, summary in summaries.items() if summary.group == group]


def refresh(
    store: SummaryStore,
    star: Star,
    as_of: date,
    names: Iterable[str],
    summaries: dict[str, Summary] = SUMMARIES,
) -> DataFrame:
    """Bring the named summaries up to date in dependency order; returns their status.

    Where the star tells which months of a fact have changed, a summary kept by
    month reads and writes those alone; others, and all of them over a star that
    does not tell, are built anew.
    """
    wanted = set(names)
    unknown = wanted - set(summaries)
    if unknown:
        raise ValueError(f"unknown summaries: {sorted(unknown)}")
    published = set(store.names())
    missing = {need for name in wanted for need in summaries[name].needs} - wanted - published
    if missing:
        raise ValueError(f"summaries not published yet: {sorted(missing)}")
    done = [name for name in summaries if name in wanted]
    for name in done:
        with scratch(store.spark):  # what a ranking stores on the way is gone once the summary is written
            if summaries[name].months and star.tracker:
                _refresh_months(store, star, as_of, name, summaries[name])
            else:
                _rebuild(store, star, as_of, name, summaries[name])
    store.vacuum()
    return summary_stats(store, as_of, done)


def _rebuild(store: SummaryStore, star: Star, as_of: date, name: str, summary: Summary) -> None:
    df = summary.build(star, store, as_of)
    if summary.partition_by:
        # Gathered by partition, so that not every task writes to each of them.
        df = df.hint("rebalance", *summary.partition_by)
    store.publish(name, df, as_of, summary.freshness, summary.partition_by)


def _refresh_months(store: SummaryStore, star: Star, as_of: date, name: str, summary: Summary) -> None:
    wanted = summary.months.wanted(star, as_of)
    kept = [p for p in store.parts(name) if wanted.get(summary.months.of_part(p)) == p[MADE_FROM]]
    held = {summary.months.of_part(p) for p in kept}
    stale = {m: digest for m, digest in sorted(wanted.items()) if m not in held}
    df = None
    if stale or not store.exists(name):
        df = summary.months.build(star, store, as_of, list(stale)).hint("rebalance", *summary.partition_by)
    store.publish_months(
        name, df, kept, stale, F.expr(summary.months.number), as_of, summary.freshness, summary.partition_by
    )


def refresh_all(store: SummaryStore, star: Star, as_of: date) -> DataFrame:
    return refresh(store, star, as_of, SUMMARIES)


STATUS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("refreshed_at", T.StringType()),
        T.StructField("newest_data", T.DateType()),
        T.StructField("days_behind", T.IntegerType()),
    ]
)


def summary_stats(store: SummaryStore, as_of: date, names: Iterable[str] | None = None) -> DataFrame:
    """Rows, refresh time and age of the newest data per published summary."""
    rows = []
    for name in store.names() if names is None else names:
        info = store.properties(name)
        column = info.get("freshness_column")
        newest = F.max(column) if column else F.lit(None).cast("date")
        total, last = store.read(name).agg(F.count("*"), newest).first()
        behind = (as_of - last).days if last else None
        rows.append((name, total, info.get("refreshed_at"), last, behind))
    return store.spark.createDataFrame(rows, STATUS)


def list_summaries(store: SummaryStore) -> DataFrame:
    """Published summaries with their current version."""
    rows = [(name, store.version(name)) for name in store.names()]
    return store.spark.createDataFrame(rows, "name string, version int")
