"""State tables that follow the facts: the newest position of every pair, and the intervals in which a unit cost holds.

Both are versions beside the summaries (``VersionedTables``), so readers keep what they have opened. An update reads the
loads or the years that are new; where the facts were replaced as a whole, the state is built anew.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.functions.periods import STOCK_MONTH
from tillscope.plans.inventory import PAIR, latest_stock
from tillscope.sources.versions import MADE_FROM, Part, VersionedTables
from tillscope.sources.warehouse import LOADS, as_ranges, from_ranges
from tillscope.star import Star

POSITIONS = "stock_positions"
COSTS = "unit_costs"
COST_YEAR = "cost_year"


def refresh_positions(store: VersionedTables, star: Star, buckets: int | None = None) -> DataFrame:
    """Bring the newest snapshot of every pair up to date, and return it.

    The table is cut and sorted by pair into ``buckets`` files (by default the
    session's number of shuffle partitions). New loads are reduced to their
    newest snapshots and joined to it, so only those move.
    """
    loads = star.tracker.loads("inventory")
    held = _held_loads(store)
    if held == loads and store.exists(POSITIONS):
        return store.read(POSITIONS)
    n = buckets or int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    if held and held < loads:
        rows = _merged(store.read(POSITIONS), latest_stock(star.tracker.of_loads("inventory", loads - held)))
    else:
        rows = latest_stock(star.inventory)
    written = store.write(POSITIONS, rows.repartition(n, *PAIR), buckets=n, bucket_by=PAIR)
    store.switch(POSITIONS, written, properties={LOADS: as_ranges(loads)})
    store.vacuum()
    return store.read(POSITIONS)


def _held_loads(store: VersionedTables) -> set[int]:
    return from_ranges(store.properties(POSITIONS).get(LOADS, "")) if store.exists(POSITIONS) else set()


def _merged(held: DataFrame, new: DataFrame) -> DataFrame:
    """The newer of two positions of each pair. Stored snapshots have no NULL in their pair (DQ5)."""
    columns = [c for c in held.columns if c not in PAIR]
    both = held.withColumnsRenamed({c: f"_held_{c}" for c in columns}).join(new, PAIR, "full_outer")
    newer = F.col("_held_snapshot_date").isNull() | (F.col("snapshot_date") >= F.col("_held_snapshot_date"))
    return both.select(*PAIR, *[F.when(newer, F.col(c)).otherwise(F.col(f"_held_{c}")).alias(c) for c in columns])


def current_positions(store: VersionedTables, star: Star) -> DataFrame | None:
    """The maintained positions if they are those of the star's snapshots, else nothing."""
    if not star.tracker or not store.exists(POSITIONS) or _held_loads(store) != star.tracker.loads("inventory"):
        return None
    return store.read(POSITIONS)


def _year_digests(star: Star) -> dict[int, str]:
    """For each year from the first snapshot to the last snapshot or sale, a digest of all snapshots up to its end."""
    months = {m: d for m, d in star.tracker.months("inventory").items() if m}
    if not months:
        return {}
    last = max(max(months), *star.tracker.months("sales"), 0) // 100
    digests, text = {}, ""
    for year in range(min(months) // 100, last + 1):
        text += "".join(f"{m}{d}" for m, d in sorted(months.items()) if m // 100 == year)
        digests[year] = hashlib.sha256(text.encode()).hexdigest()[:16]
    return digests


def _first_stale(parts: tuple[Part, ...], digests: dict[int, str]) -> int | None:
    """The first year whose intervals are missing or were made from other snapshots."""
    held = {int(p[COST_YEAR]): p[MADE_FROM] for p in parts}
    return next((year for year, digest in sorted(digests.items()) if held.get(year) != digest), None)


def refresh_costs(store: VersionedTables, star: Star) -> DataFrame:
    """Bring the cost intervals up to date, and return them: ``product_id, store_id, unit_cost, valid_from, valid_to, cost_year``.

    An interval runs from a snapshot with a cost to the day before the next one
    and is cut at the ends of years, so the costs of a year lie in one folder.
    Years are rebuilt from the first that has changed: from its snapshots, those
    of later years, and the costs at the end of the year before.
    """
    digests, parts = _year_digests(star), store.parts(COSTS)
    first = _first_stale(parts, digests)
    if first is None and store.exists(COSTS) and len(parts) == len(digests):
        return store.read(COSTS)
    begin = first if first is not None else max(digests, default=1969) + 1
    kept = [p for p in parts if int(p[COST_YEAR]) < begin and int(p[COST_YEAR]) in digests]
    written = None
    if first is not None or not store.exists(COSTS):
        carried = store.read(COSTS) if kept else None
        intervals = _intervals(star.inventory, carried, begin, max(digests, default=begin))
        pairs = [F.lit(x) for pair in {0: "", **digests}.items() for x in pair]
        made_from = F.coalesce(F.create_map(*pairs)[F.col(COST_YEAR)], F.lit(""))
        rows = intervals.hint("rebalance", COST_YEAR).sortWithinPartitions(*PAIR)
        written = store.write(COSTS, rows, [COST_YEAR], made_from)
    store.switch(COSTS, written, kept)
    store.vacuum()
    return store.read(COSTS)


def _intervals(inventory: DataFrame, carried: DataFrame | None, first: int, last: int) -> DataFrame:
    """Intervals of the years ``first`` to ``last``, cut by year."""
    rows = inventory
    if STOCK_MONTH in rows.columns:
        rows = rows.where(F.col(STOCK_MONTH) >= first * 100)
    snapshots = (
        rows.where((F.col("snapshot_date") >= F.lit(date(first, 1, 1))) & F.col("unit_cost").isNotNull())
        .groupBy(*PAIR, F.col("snapshot_date").alias("valid_from"))
        .agg(F.max("unit_cost").alias("unit_cost"))
    )
    if carried is not None:
        # A cost of the year before holds on until the first snapshot; one of New Year's Day replaces it.
        day = F.lit(date(first, 1, 1))
        before = carried.where((F.col(COST_YEAR) == first - 1) & (F.col("valid_to") == F.lit(date(first - 1, 12, 31))))
        snapshots = snapshots.withColumn("_own", F.lit(1)).unionByName(
            before.select(*PAIR, day.alias("valid_from"), "unit_cost", F.lit(0).alias("_own"))
        )
        newest = F.max_by("unit_cost", "_own").alias("unit_cost")
        snapshots = snapshots.groupBy(*PAIR, "valid_from").agg(newest)
    series = Window.partitionBy(*PAIR).orderBy("valid_from")
    until = F.coalesce(F.date_sub(F.lead("valid_from").over(series), 1), F.lit(date(last, 12, 31)))
    spans = snapshots.withColumn("valid_to", until)
    years = spans.withColumn(COST_YEAR, F.explode(F.sequence(F.year("valid_from"), F.year("valid_to"))))

    def cut(month: int, day: int) -> Column:
        return F.make_date(F.col(COST_YEAR), F.lit(month), F.lit(day))

    return years.select(
        *PAIR, "unit_cost", F.greatest("valid_from", cut(1, 1)).alias("valid_from"),
        F.least("valid_to", cut(12, 31)).alias("valid_to"), COST_YEAR,
    )


def current_costs(store: VersionedTables, star: Star) -> DataFrame | None:
    """The maintained intervals if they are those of the star's snapshots, else nothing."""
    if not star.tracker or not store.exists(COSTS):
        return None
    return store.read(COSTS) if _first_stale(store.parts(COSTS), _year_digests(star)) is None else None
