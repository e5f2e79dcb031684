"""Joins of a fact with a dimension.

No large side is hinted: Spark broadcasts a side by the session's threshold, and adaptive execution decides again from
the sizes it has measured. Where rows must meet the catalogue before they are reduced, ``with_product_of_lines`` keeps
products with many lines out of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with this share of the rows is heavy; at most HEAVY_KEYS can be. TRACKED bounds a sketch's memory in a task.
HEAVY_SHARE, HEAVY_KEYS, TRACKED = 1 / 256, 256, 4096


def with_store(facts: DataFrame, stores: DataFrame, *columns: str) -> DataFrame:
    return facts.join(stores.select("store_id", *columns), "store_id")


def with_product(facts: DataFrame, products: DataFrame, *columns: str) -> DataFrame:
    """Add product attributes.

    The catalogue may be large, so this is called on rows already aggregated
    by product: if a shuffle join is needed, those rows are already
    partitioned by ``product_id``.
    """
    return facts.join(products.select("product_id", *columns), "product_id")


def with_day(sales: DataFrame, days: DataFrame, *columns: str) -> DataFrame:
    return sales.join(days.select("sale_date", *columns), "sale_date")


def heavy_keys(rows: DataFrame, key: str, share: float = HEAVY_SHARE, most: int = HEAVY_KEYS) -> list:
    """The keys that may have more than ``share`` of the rows, by a sketch of fixed size for each task; runs a job.

    The sketch over- or underestimates a count by less than a thousandth of the rows, so a key near the share may be
    missed or added, which moves work but changes no result. NULL is no key.
    """
    found = rows.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k({key}, {most}, {TRACKED})").alias("top"), F.count("*").alias("n")
    )
    top, n = found.first()
    return [item["item"] for item in top or [] if item["count"] > share * n]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark would broadcast ``df`` by the size it estimates."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    most = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= most


def with_product_of_lines(lines: DataFrame, products: DataFrame, *columns: str, counted: DataFrame | None = None) -> DataFrame:
    """Add product attributes to rows in which one product may have a large share.

    A catalogue small enough is broadcast as any. Otherwise the products with
    many rows, at most ``HEAVY_KEYS``, are told by a sketch over ``counted`` (by
    default the lines) and broadcast to their rows, which stay where they are;
    all other rows are shuffled to the catalogue. Together they are the inner
    join, and no key with a share of more than ``HEAVY_SHARE`` is shuffled.
    """
    catalogue = products.select("product_id", *columns)
    if fits_broadcast(catalogue):
        return lines.join(catalogue, "product_id")
    heavy = heavy_keys(lines if counted is None else counted, "product_id")
    if not heavy:
        return lines.join(catalogue, "product_id")
    is_heavy = F.col("product_id").isin(heavy)
    kept = lines.where(is_heavy).join(F.broadcast(catalogue.where(is_heavy)), "product_id")
    moved = lines.where(~is_heavy).join(catalogue.where(~is_heavy), "product_id")
    return kept.unionByName(moved)
