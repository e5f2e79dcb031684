"""Data-quality rules and the checks that apply them.

A row rule is a condition as in a SQL CHECK: it is broken only where it is
false, a NULL passes. All row rules of a table are counted in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.star import TABLE_NAMES, Star


@dataclass(frozen=True)
class RowRule:
    rule_id: str
    table: str
    name: str
    condition: str

    def broken(self) -> Column:
        return F.expr(f"NOT ({self.condition})")


@dataclass(frozen=True)
class KeyRule:
    """Columns that identify a row; a primary key also forbids NULLs."""

    rule_id: str
    table: str
    columns: tuple[str, ...]
    primary: bool = True

    @property
    def name(self) -> str:
        return f"unique({', '.join(self.columns)})"


@dataclass(frozen=True)
class ReferenceRule:
    rule_id: str
    table: str
    column: str
    target: str
    target_column: str

    @property
    def name(self) -> str:
        return f"{self.column} in {self.target}"


# Required columns, text lengths and channels of the data model.
REQUIRED = {
    "products": ("sku", "product_name", "brand", "category"),
    "stores": ("store_code", "store_name", "chain", "format", "region", "city"),
    "calendar": ("day", "iso_weekday", "day_name", "iso_week", "month", "month_name", "quarter", "year", "is_weekend"),
    "sales": ("product_id", "store_id", "sale_date", "quantity", "unit_price"),
    "inventory": ("product_id", "store_id", "snapshot_date", "opening_stock", "final_stock"),
}
MAX_LENGTH = {
    "products": {"sku": 50, "product_name": 200, "brand": 100, "category": 50, "subcategory": 50},
    "stores": {
        "store_code": 20, "store_name": 200, "chain": 100, "format": 50, "region": 50,
        "city": 100, "state": 50, "postal_code": 10,
    },
    "calendar": {"day_name": 20, "month_name": 20, "holiday_name": 100, "fiscal_period": 10},
    "sales": {"ticket_id": 50, "channel": 20},
}
CHANNELS = ("in-store", "online", "mobile", "phone")

ROW_RULES = (
    *(
        RowRule("DQ5", table, f"{column} required", f"{column} IS NOT NULL")
        for table, columns in REQUIRED.items()
        for column in columns
    ),
    RowRule("DQ6", "products", "list_price not negative", "list_price >= 0"),
    RowRule("DQ7", "stores", "floor_area_m2 positive", "floor_area_m2 > 0"),
    RowRule("DQ8", "sales", "quantity positive", "quantity > 0"),
    RowRule("DQ9", "sales", "unit_price not negative", "unit_price >= 0"),
    RowRule("DQ10", "sales", "discount_pct 0 to 100", "discount_pct BETWEEN 0 AND 100"),
    RowRule("DQ11", "sales", "tax_pct not negative", "tax_pct >= 0"),
    RowRule("DQ12", "inventory", "opening_stock not negative", "opening_stock >= 0"),
    RowRule("DQ12", "inventory", "final_stock not negative", "final_stock >= 0"),
    RowRule("DQ13", "inventory", "stock_in not negative", "stock_in >= 0"),
    RowRule("DQ13", "inventory", "stock_out not negative", "stock_out >= 0"),
    RowRule("DQ14", "inventory", "unit_cost not negative", "unit_cost >= 0"),
    RowRule("DQ15", "products", "product_name not blank", "length(trim(product_name)) > 0"),
    RowRule("DQ16", "stores", "store_name not blank", "length(trim(store_name)) > 0"),
    RowRule("DQ17", "sales", "channel known", f"channel IN {CHANNELS}"),
    RowRule("DQ18", "inventory", "stock balance", "opening_stock + stock_in - stock_out = final_stock"),
    *(
        RowRule("DQ21", table, f"{column} at most {limit}", f"length({column}) <= {limit}")
        for table, limits in MAX_LENGTH.items()
        for column, limit in limits.items()
    ),
)
KEY_RULES = (
    KeyRule("DQ1", "products", ("product_id",)),
    KeyRule("DQ1", "stores", ("store_id",)),
    KeyRule("DQ1", "calendar", ("cal_date",)),
    KeyRule("DQ1", "sales", ("sale_id", "sale_date")),
    KeyRule("DQ1", "inventory", ("inventory_id",)),
    KeyRule("DQ2", "products", ("sku",), primary=False),
    KeyRule("DQ3", "stores", ("store_code",), primary=False),
    KeyRule("DQ4", "inventory", ("product_id", "store_id", "snapshot_date"), primary=False),
)
REFERENCE_RULES = (
    ReferenceRule("DQ19", "sales", "product_id", "products", "product_id"),
    ReferenceRule("DQ19", "sales", "store_id", "stores", "store_id"),
    ReferenceRule("DQ19", "inventory", "product_id", "products", "product_id"),
    ReferenceRule("DQ19", "inventory", "store_id", "stores", "store_id"),
    ReferenceRule("DQ20", "sales", "sale_date", "calendar", "cal_date"),
    ReferenceRule("DQ20", "inventory", "snapshot_date", "calendar", "cal_date"),
)
PASS_TARGETS = ("stores", "calendar")
DATE_COLUMNS = {"sales": "sale_date", "inventory": "snapshot_date"}


def _finding(rule_id: str, table: str, name: str, count: Column) -> Column:
    return F.struct(
        F.lit(rule_id).alias("rule_id"),
        F.lit(table).alias("table_name"),
        F.lit(name).alias("rule"),
        F.coalesce(count, F.lit(0)).cast("bigint").alias("violations"),
    )


@dataclass(frozen=True)
class Probe:
    """A condition counted per row, under the rule it reports to."""

    rule_id: str
    table: str
    name: str
    broken: Column


def check_rows(df: DataFrame, probes: list[Probe]) -> DataFrame:
    """Violations of every probe, counted in one aggregate over the table."""
    counts = df.agg(*[F.count_if(probe.broken).alias(f"r{i}") for i, probe in enumerate(probes)])
    findings = [_finding(p.rule_id, p.table, p.name, F.col(f"r{i}")) for i, p in enumerate(probes)]
    return counts.select(F.inline(F.array(*findings)))


def check_key(df: DataFrame, rule: KeyRule) -> DataFrame:
    """Rows beyond the first of each key value; NULL keys count if primary.

    For a key that is only unique, NULLs never collide.
    """
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in rule.columns])
    surplus = F.sum(F.when(missing, F.col("n") if rule.primary else F.lit(0)).otherwise(F.col("n") - 1))
    counted = df.groupBy(*rule.columns).agg(F.count("*").alias("n")).agg(surplus.alias("broken"))
    return counted.select(F.inline(F.array(_finding(rule.rule_id, rule.table, rule.name, F.col("broken")))))


def check_reference(df: DataFrame, target: DataFrame, rule: ReferenceRule) -> DataFrame:
    """Rows whose key has no match; a NULL key passes, as for a foreign key."""
    per_key = df.filter(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count("*").alias("n"))
    known = target.select(F.col(rule.target_column).alias(rule.column))
    broken = per_key.join(known, rule.column, "left_anti").agg(F.sum("n").alias("broken"))
    return broken.select(F.inline(F.array(_finding(rule.rule_id, rule.table, rule.name, F.col("broken")))))


def date_range_probe(table: str, calendar: DataFrame) -> Probe:
    """Dates before the first or after the last calendar day."""
    column = DATE_COLUMNS[table]
    first = calendar.agg(F.min("cal_date")).scalar()
    last = calendar.agg(F.max("cal_date")).scalar()
    outside = (F.col(column) < first) | (F.col(column) > last)
    return Probe("DQ22", table, f"{column} inside the calendar", outside)


def check_table(star: Star, table: str, chosen: Callable[[str], bool]) -> list[DataFrame]:
    """Findings of one table.

    Row rules, the date range and references to stores and days share one pass.
    A reference to the catalogue is checked on the table's distinct keys.
    """
    df, findings = star.table(table), []
    probes = [Probe(r.rule_id, table, r.name, r.broken()) for r in ROW_RULES if r.table == table and chosen(r.rule_id)]
    if table in DATE_COLUMNS and chosen("DQ22"):
        probes.append(date_range_probe(table, star.calendar))
    for i, rule in enumerate(r for r in REFERENCE_RULES if r.table == table and chosen(r.rule_id)):
        target = star.table(rule.target)
        known = target.select(F.col(rule.target_column).alias(rule.column)).distinct()
        if rule.target in PASS_TARGETS:
            found = f"_found_{i}"
            df = df.join(known.withColumn(found, F.lit(True)), rule.column, "left")
            missing = F.col(found).isNull() & F.col(rule.column).isNotNull()
            probes.append(Probe(rule.rule_id, table, rule.name, missing))
        else:
            findings.append(check_reference(star.table(table), target, rule))
    if probes:
        findings.append(check_rows(df, probes))
    return findings


def check(star: Star, rule_ids: set[str] | None = None) -> DataFrame:
    """Findings of the chosen rules (all by default) over the whole star.

    A key rule is left out where its table lacks the generated key.
    """

    def chosen(rule_id: str) -> bool:
        return rule_ids is None or rule_id in rule_ids

    findings = [found for table in TABLE_NAMES for found in check_table(star, table, chosen)]
    findings += [
        check_key(star.table(r.table), r)
        for r in KEY_RULES
        if chosen(r.rule_id) and set(r.columns) <= set(star.table(r.table).columns)
    ]
    return reduce(DataFrame.unionByName, findings)


def broken_row_rules(table: str) -> Column:
    """Array with the ids of the row rules a row breaks."""
    hits = [F.when(r.broken(), F.lit(r.rule_id)) for r in ROW_RULES if r.table == table]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def unknown_keys(df: DataFrame, target: DataFrame, rule: ReferenceRule) -> DataFrame:
    """The distinct keys of ``df`` that the target lacks.

    Keys are made distinct before they move, so a key that a third of the rows
    have is one row per task.
    """
    known = target.select(F.col(rule.target_column).alias(rule.column))
    return df.select(rule.column).where(F.col(rule.column).isNotNull()).distinct().join(known, rule.column, "left_anti")


#: So many unknown keys are broadcast at most; a key takes 8 bytes.
FEW_KEYS = 10_000


def mark(
    df: DataFrame, table: str, targets: dict[str, DataFrame] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Rows with ``broken_rules``: the ids of the row rules and, with ``targets``, references they break.

    References are checked on distinct keys, which runs a job for each while the
    plan is built. Rows meet the unknown keys only: none at all need no join, few
    are broadcast, and many are joined by key; ``keep`` may store these, so that a
    result read in portions does not find them again for each.
    """
    rows = df.withColumn("broken_rules", broken_row_rules(table))
    for rule in (r for r in REFERENCE_RULES if r.table == table and targets and r.target in targets):
        unknown = unknown_keys(df, targets[rule.target], rule)
        some = unknown.limit(FEW_KEYS + 1).collect()
        if not some:
            continue
        if len(some) <= FEW_KEYS:
            unknown = F.broadcast(df.sparkSession.createDataFrame(some, unknown.schema))
        elif keep:
            unknown = keep(unknown)
        unknown = unknown.withColumn("_unknown", F.lit(True))
        more = F.when(F.col("_unknown"), F.array(F.lit(rule.rule_id))).otherwise(F.array().cast("array<string>"))
        rows = (
            rows.join(unknown, rule.column, "left")
            .withColumn("broken_rules", F.array_union("broken_rules", more))
            .drop("_unknown")
        )
    return rows


def mark_known(rows: DataFrame, key: tuple[str, ...], rule_id: str, stored: DataFrame) -> DataFrame:
    """Marked rows where also those whose key is that of a stored row break ``rule_id``; a NULL in a key matches nothing.

    Only rows that broke no rule before are compared.
    """
    known = stored.select(*key).distinct().withColumn("_stored", F.lit(True))
    marked = rows.join(known, list(key), "left")
    broken = (F.size("broken_rules") == 0) & F.col("_stored").isNotNull()
    return marked.withColumn(
        "broken_rules", F.when(broken, F.array(F.lit(rule_id))).otherwise(F.col("broken_rules"))
    ).drop("_stored")


def mark_duplicates(rows: DataFrame, key: tuple[str, ...], rule_id: str, primary: bool = False) -> DataFrame:
    """Marked rows where also every row of a repeated key, and of a missing one if it is primary, breaks ``rule_id``.

    Only rows that broke no rule before are compared. Which copy is the right
    one cannot be told, so none is kept.
    """
    whole = F.size("broken_rules") == 0
    repeated = rows.filter(whole).groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    marked = rows.join(repeated.select(*key, F.lit(True).alias("_repeated")), list(key), "left")
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in key]) if primary else F.lit(False)
    broken = whole & (F.col("_repeated").isNotNull() | missing)
    return marked.withColumn(
        "broken_rules", F.when(broken, F.array(F.lit(rule_id))).otherwise(F.col("broken_rules"))
    ).drop("_repeated")


def split(df: DataFrame, table: str, targets: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows by row rules and, with ``targets``, references.

    Rejected rows carry the ids of the rules they break in ``broken_rules``.
    """
    rows = mark(df, table, targets)
    whole = F.size("broken_rules") == 0
    return rows.filter(whole).drop("broken_rules"), rows.filter(~whole)
