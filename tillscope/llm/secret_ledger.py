"""Secret scans over a ledger of content-addressed versions.

A text is addressed by its SHA-256: its *blob*. The ledger holds every version of every path as (path, blob), which rule
versions each blob has been scanned with, and what was found in it. Recording a batch of versions scans only pairs of blob
and rule version that the ledger has not seen, each blob once however many paths hold it; findings are joined back to all
paths that ever held the blob.

A batch is written to a folder of its own and counts once its name is in the table of commits, which is the last write.
What a broken-off attempt leaves behind is read by nobody, and recording the batch again scans it again.

Everything is DataFrame expressions. Places of matches come from the lengths of the matches and of the gaps between them,
summed by a window along each blob, so a text with very many matches needs no array that grows with every one of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillscope.llm import textstats
from tillscope.llm.stored import stored

#: A hash and a list of rules take under 200 bytes; so many blobs are broadcast at most, beyond that they are joined.
FEW_BLOBS = 50_000


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has ``least`` characters or more.

    A new pattern or limit needs a new ``version``: the ledger takes equal kind and version for the same rule.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The first three rules. Runs of 24 or more hexadecimal digits are the runs of any length that are long
# enough, and likewise for access keys, since a run is always taken whole.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE_RULES,
    Rule("github", 1, r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)


def _pieces(text: Column, rule: Rule) -> Column:
    """For each match the characters of the gap before it, its own, and whether it is long enough; null without a match."""

    def placed(matches: Column) -> Column:
        def sized(gaps: Column) -> Column:
            def piece(match: Column, i: Column) -> Column:
                part = F.regexp_extract(match, rule.pattern, rule.group) if rule.group else match
                return F.struct(
                    F.length(F.get(gaps, i)).alias("gap"), F.length(match).alias("size"), (F.length(part) >= rule.least).alias("holds")
                )

            return F.transform(matches, piece)

        return F.when(F.size(matches) > 0, textstats.let(F.split(text, rule.pattern, -1), sized))

    return textstats.let(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), placed)


def scan(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob, kind, version, start, end`` of the secrets in ``blob, text, todo``; places in code points, end exclusive.

    Only the rules whose name is in ``todo`` are applied to a text.
    """
    each = [
        F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
            F.when(F.array_contains("todo", r.name), _pieces(F.col("text"), r)).alias("pieces"),
        )
        for r in rules
    ]
    # The outer forms keep Spark from adding a filter on the array's size, which would match all patterns twice.
    matched = texts.select("blob", F.explode_outer(F.filter(F.array(*each), lambda x: x["pieces"].isNotNull())).alias("m"))
    pieces = matched.select("blob", "m.kind", "m.version", F.posexplode_outer("m.pieces").alias("at", "piece"))
    along = Window.partitionBy("blob", "kind", "version").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.where("piece IS NOT NULL").withColumn("end", F.sum(F.col("piece.gap") + F.col("piece.size")).over(along))
    return placed.where("piece.holds").select("blob", "kind", "version", (F.col("end") - F.col("piece.size")).alias("start"), "end")


class SecretLedger:
    """Versions, scans and findings in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        spark.createDataFrame([], "batch string").coalesce(1).write.mode("ignore").parquet(f"{self.folder}/commits")

    def _read(self, what: str, schema: str) -> DataFrame:
        """A table over all committed batches."""
        names = [r.batch for r in self.spark.read.schema("batch string").parquet(f"{self.folder}/commits").collect()]
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{name}/{what}" for name in sorted(names)])

    def versions(self, path_type: str = "long") -> DataFrame:
        """``path, blob``: a row for each version of a path that was recorded."""
        return self._read("versions", f"path {path_type}, blob string")

    def scans(self) -> DataFrame:
        """``blob, rules``: names of the rule versions a blob was scanned with; a blob may have several rows."""
        return self._read("scans", "blob string, rules array<string>")

    def findings(self) -> DataFrame:
        """``blob, kind, version, start, end``."""
        return self._read("findings", "blob string, kind string, version int, start long, end long").distinct()

    def _unseen(self, blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        """``blob, todo``: the rule versions that each blob has not been scanned with."""
        done = self.scans().select("blob", F.explode("rules").alias("rule")).where(F.col("rule").isin([r.name for r in rules]))
        seen = done.groupBy("blob").agg(F.collect_set("rule").alias("done"))
        every = F.array(*[F.lit(r.name) for r in rules])
        todo = F.when(F.col("done").isNull(), every).otherwise(F.array_except(every, F.col("done")))
        return blobs.join(seen, "blob", "left").select("blob", todo.alias("todo")).where(F.size("todo") > 0)

    def record(self, docs: DataFrame, rules: Sequence[Rule] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
        """Add each row of ``docs`` as a version of its path, and scan what is unseen; returns ``blob, todo`` of the scans.

        A null text is an empty one; a null path is a path like any other; a row given twice is recorded twice and
        scanned once. An empty table commits an empty batch. Other columns are not read. The texts of unseen blobs move
        once, one for each blob and task; few unseen blobs are broadcast, so that no other text moves.
        """
        batch = f"batch-{uuid.uuid4().hex}"
        at = f"{self.folder}/{batch}"
        texts = docs.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        addressed = texts.withColumn("blob", F.sha2("text", 256))
        addressed.select("path", "blob").write.parquet(f"{at}/versions")
        blobs = self.spark.read.schema(addressed.select("path", "blob").schema).parquet(f"{at}/versions").select("blob").distinct()
        unseen = stored(self._unseen(blobs, rules))
        if unseen.count() <= FEW_BLOBS:
            addressed = addressed.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
        once = addressed.groupBy("blob").agg(F.first("text").alias("text"))
        scan(once.join(unseen, "blob"), rules).write.parquet(f"{at}/findings")
        unseen.select("blob", F.col("todo").alias("rules")).write.parquet(f"{at}/scans")
        self.spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return unseen

    def by_path(self, rules: Sequence[Rule] = RULES, path_type: str = "long") -> DataFrame:
        """``path, blob, spans`` for each recorded version: structs ``start, rank, kind, end`` in order of place and rule."""
        wanted = [F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules]
        rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).cast("int")
        current = self.findings().where(F.struct("kind", "version").isin(wanted))
        span = F.struct("start", rank.alias("rank"), "kind", "end")
        spans = current.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"))
        none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
        joined = self.versions(path_type).join(spans, "blob", "left")
        return joined.select("path", "blob", F.coalesce("spans", none).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
