"""Versions of stored tables, side by side in one catalog database.

Data is written to folders that never change afterwards. A version of a table is a catalog table over such folders: each
of its partitions names the folder it lies in, so a new version shares what it did not replace with the versions before.
A view with the table's name points at the current version. Moving the view is the one step that readers see, and the
last one of every change: a change that breaks off before it has not happened, and a reader that has started keeps the
folders it opened for as long as a kept version, or any other table of the database, names them.

One process changes a database at a time; any number read it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.sources.shared import shuffles_deleted

#: Partition columns that no reader sees: what a partition was made from, and the folder its write went to.
MADE_FROM, WRITTEN_AS = "made_from", "written_as"
HIDDEN = (MADE_FROM, WRITTEN_AS)
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_STATEMENT_PARTS = 200


@dataclass(frozen=True)
class Part:
    """A partition by its folder path below the write's folder, such as ``sale_year=2024/made_from=7/written_as=ab``."""

    path: str

    def __getitem__(self, column: str) -> str | None:
        value = dict(piece.split("=", 1) for piece in self.path.split("/"))[column]
        return None if value == _NO_VALUE else value

    def spec(self) -> str:
        pairs = (piece.split("=", 1) for piece in self.path.split("/"))
        return ", ".join(f"{column} = " + ("null" if value == _NO_VALUE else f"'{value}'") for column, value in pairs)


@dataclass(frozen=True)
class Written:
    """Rows in their folder under a catalog table of their own, not yet part of any version."""

    table: str
    token: str
    columns: tuple[str, ...]
    parts: tuple[Part, ...] | None


class VersionedTables:
    """Tables of one database; ``keep`` versions of each are kept."""

    def __init__(
        self, spark: SparkSession, database: str, location: str | None = None, keep: int = 4, comment: str = ""
    ):
        self.spark = spark
        self.database = database
        self.keep = keep
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} COMMENT '{comment}'{place}")
        self.place = spark.catalog.getDatabase(database).locationUri.rstrip("/")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def _folder(self, token: str) -> str:
        return f"{self.place}/files/{token}"

    # Versions and what they hold

    def _tables(self, name: str) -> dict[int, str]:
        """Version tables of a name by number."""
        prefix = f"{name}__v"
        numbered = {t[len(prefix) :].split("_")[0]: t for t in self._named(f"{prefix}*")}
        return dict(sorted((int(number), t) for number, t in numbered.items() if number.isdigit()))

    def _named(self, pattern: str) -> list[str]:
        return [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{pattern}'").collect()]

    def names(self) -> list[str]:
        return sorted(r["viewName"] for r in self.spark.sql(f"SHOW VIEWS IN {self.database}").collect() if not r["isTemporary"])

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.name(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.name(name))

    def version(self, name: str) -> int:
        """Number of the current version, 0 if there is none."""
        return int(self.current_table(name).split("__v")[-1].split("_")[0]) if self.exists(name) else 0

    def current_table(self, name: str) -> str:
        """The version table that the view points at."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(name)} ('version_table')").first()["value"]
        return self.name(found)

    def properties(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.current_table(name)}").collect()
        return {row["key"]: row["value"] for row in rows}

    def _parts_of(self, table: str) -> tuple[Part, ...] | None:
        if WRITTEN_AS not in self.spark.table(table).columns:
            return None
        return tuple(Part(r["partition"]) for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect())

    def parts(self, name: str) -> tuple[Part, ...]:
        """Partitions of the current version; none for a table that does not exist yet."""
        return (self._parts_of(self.current_table(name)) or ()) if self.exists(name) else ()

    # Changes

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        made_from: Column | str = "",
        buckets: int = 0,
        bucket_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
        more: Iterable[DataFrame] = (),
    ) -> Written:
        """Store rows in a new folder; nobody sees them before ``switch``.

        A partitioned table gets two more partition columns: ``made_from`` tells what the rows were made from, as the
        caller sees fit. With ``buckets`` the files of every partition are cut and sorted by ``bucket_by``. Rows of ``more``
        are stored beside those of ``df``, each by a job of its own.
        """
        token = uuid.uuid4().hex[:16]
        table = self.name(f"{name}__data_{token}")
        with shuffles_deleted(self.spark):
            for rows in (df, *more):
                if partition_by:
                    made = F.lit(made_from) if isinstance(made_from, str) else made_from
                    rows = rows.withColumns({MADE_FROM: made, WRITTEN_AS: F.lit(token)})
                writer = rows.write.format("parquet").options(**options or {}).option("path", self._folder(token))
                if partition_by:
                    writer = writer.partitionBy(*partition_by, *HIDDEN)
                if buckets:
                    writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
                writer.mode("append").saveAsTable(table)
        return Written(table, token, tuple(df.columns), self._parts_of(table) if partition_by else None)

    def stored(self, written: Written) -> DataFrame:
        """The rows of a write that is not part of a version yet."""
        return self.spark.table(written.table).select(*written.columns)

    def switch(
        self,
        name: str,
        written: Written | None,
        kept: Iterable[Part] = (),
        properties: Mapping[str, str] | None = None,
        comment: str = "",
        like: str | None = None,
    ) -> None:
        """Make a version of what was written, and of the partitions kept of older versions, the current one.

        Without rows written the new version has the columns of the version table ``like``, by default the current one.
        """
        current, tables = self.version(name), self._tables(name)
        for left in [n for n in tables if n > current]:  # of changes that broke off
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(tables.pop(left))}")
        table = f"{name}__v{current + 1}_{uuid.uuid4().hex[:12]}"
        like = written.table if written else like or self.current_table(name)
        parts = (*kept, *((written.parts or ()) if written else ()))
        whole = written is not None and written.parts is None
        place = self._folder(written.token) if whole else f"{self.place}/versions/{table}"
        self.spark.sql(f"CREATE TABLE {self.name(table)} LIKE {like} LOCATION '{place}'")
        for first in range(0, len(parts), _STATEMENT_PARTS):
            placed = [
                f"PARTITION ({p.spec()}) LOCATION '{self._folder(p[WRITTEN_AS])}/{p.path}'"
                for p in parts[first : first + _STATEMENT_PARTS]
            ]
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD {' '.join(placed)}")
        notes = {**(properties or {}), "stored_in": written.token if whole else ""}
        pairs = ", ".join(f"'{key}' = '{value}'" for key, value in notes.items())
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ({pairs})")
        if comment:
            self.spark.sql(f"COMMENT ON TABLE {self.name(table)} IS '{comment}'")
        columns = written.columns if written else [c for c in self.spark.table(like).columns if c not in HIDDEN]
        self._point(name, table, columns, comment)
        if written:
            self.spark.sql(f"DROP TABLE {written.table}")
        for old in sorted(tables)[: max(0, len(tables) + 1 - self.keep)]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(tables[old])}")

    def _point(self, name: str, table: str, columns: Sequence[str], comment: str) -> None:
        """Move the view to a version table."""
        shown = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(name)} COMMENT '{comment}' TBLPROPERTIES ('version_table' = '{table}') "
            f"AS SELECT {shown} FROM {self.name(table)}"
        )

    def drop_version(self, name: str, version: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(self._tables(name)[version])}")

    def drop(self, name: str) -> None:
        """Remove a table with all its versions, if it exists."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(name)}")
        for version in self._tables(name):
            self.drop_version(name, version)
        self.vacuum()

    def vacuum(self) -> list[str]:
        """Delete the folders that no version of any table names; returns them, below the folder of all files.

        They are what dropped versions leave, and what a change that broke off has left. Not to be called while
        another process changes the database.
        """
        for table in self._named("*__data_*"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        named: set[str] = set()
        for table in self._named("*__v*"):
            parts = self._parts_of(self.name(table))
            if parts is not None:
                named |= {f"{p[WRITTEN_AS]}/{p.path}" for p in parts}
            else:
                named.add(self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)} ('stored_in')").first()["value"])
        above = {path[:k] for path in named for k, c in enumerate(path) if c == "/"}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.place}/files")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone: list[str] = []

        def clear(folder, prefix: str) -> None:
            for entry in system.listStatus(folder):
                below = prefix + entry.getPath().getName()
                if below in above:
                    clear(entry.getPath(), below + "/")
                elif below not in named and (entry.isDirectory() or not prefix):
                    system.delete(entry.getPath(), True)
                    gone.append(below)

        if system.exists(path):
            clear(path, "")
        return sorted(gone)
