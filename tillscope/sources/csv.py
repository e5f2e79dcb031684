"""Exchange CSV files: header row, UTF-8, doubled quotes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.sources.schema import CSV_HEADERS, DEFAULTS, KEYS, STOCK_VALUE, TABLES
from tillscope.sources.shared import shuffles_deleted

CORRUPT = "corrupt_record"
# What an unquoted empty field is read as before it becomes NULL. It differs
# from "", so that a quoted empty field stays an empty string.
NULL_MARK = "\u0000"


def file_schema(table: str) -> T.StructType:
    """Schema of a table's file, with the file's own header names."""
    target = TABLES[table]
    return T.StructType([T.StructField(head, target[col].dataType) for head, col in CSV_HEADERS[table].items()])


def read_csv(
    spark: SparkSession, table: str, paths: str | Sequence[str], keep_corrupt: bool = False, multi_line: bool = False
) -> DataFrame:
    """Read a table's files with its fixed schema, renamed to our columns.

    The header is checked against the schema. An empty field is NULL, a quoted
    one an empty string. A row that does not parse stops
    the read, or with ``keep_corrupt`` is kept with its text in
    ``corrupt_record``. Files are split between tasks unless ``multi_line``
    allows line breaks inside quotes.
    """
    schema = file_schema(table)
    reader = spark.read.options(
        header=True, encoding="UTF-8", escape='"', nullValue=NULL_MARK, enforceSchema=False, multiLine=multi_line
    )
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    else:
        reader = reader.option("mode", "FAILFAST")
    rows = reader.schema(schema).csv(list(paths) if not isinstance(paths, str) else paths)
    return rows.withColumnsRenamed(CSV_HEADERS[table])


def content_digests(spark: SparkSession, table: str, paths: Sequence[str]) -> DataFrame:
    """``place, path, digest, lines`` of each given file or folder, by the content of its lines.

    The digest does not depend on the order of the lines, on their cut into
    files, or on how often the header stands among them: it is made of sums of
    two hashes over the other lines, and of their number. Lines are read once,
    where they lie.
    """
    header = ",".join(CSV_HEADERS[table])
    first, second = F.xxhash64("value"), F.xxhash64(F.lit("second"), "value")
    found = []
    for place, path in enumerate(paths):
        lines = spark.read.text(path).where(F.rtrim("value") != header)
        sums = lines.agg(
            F.count("*").alias("lines"),
            *[F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("string").alias(n) for h, n in ((first, "a"), (second, "b"))],
        )
        digest = F.sha2(F.concat_ws("/", F.lit(table), "lines", "a", "b"), 256)
        found.append(sums.select(F.lit(place).alias("place"), F.lit(path).alias("path"), digest.alias("digest"), "lines"))
    return reduce(DataFrame.unionByName, found)


def read_products(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, "products", path, **options)


def read_stores(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, "stores", path, **options)


def read_sales(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """Sale lines of several files (one per year) in one read."""
    return read_csv(spark, "sales", paths, **options)


def read_inventory(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, "inventory", path, **options)


def write_csv(df: DataFrame, table: str, path: str, compression: str = "none") -> None:
    """Write a table's exchange columns under their file headers, blanks kept.

    A file with ``compression`` is read by one task; there is one for each task that wrote.
    """
    columns = [F.col(col).alias(head) for head, col in CSV_HEADERS[table].items()]
    writer = df.select(*columns).write.mode("overwrite").options(
        header=True, encoding="UTF-8", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        compression=compression,
    )
    with shuffles_deleted(df.sparkSession):
        writer.csv(path)


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Add columns the source left out: their default, or NULL without one.

    The table's own key is not invented here; see ``tillscope.operators.keys``.
    """
    defaults = DEFAULTS[table]
    missing = {
        field.name: F.expr(defaults.get(field.name, "NULL")).cast(field.dataType)
        for field in TABLES[table].fields
        if field.name not in df.columns and field.name != KEYS.get(table)
    }
    return df.withColumns(missing) if missing else df


def with_inventory_value(df: DataFrame) -> DataFrame:
    """Stock value, always computed from final stock and unit cost."""
    return df.withColumn("stock_value", (F.col("final_stock") * F.col("unit_cost")).cast(STOCK_VALUE))
