"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm import textstats


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * top / bottom <= high``; a bottom of 0 passes. Compared in whole numbers."""

    name: str
    top: str
    bottom: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        top, bottom = 1000 * F.col(self.top), F.col(self.bottom)
        tests = [F.lit(True)]
        if self.low is not None:
            tests.append(top >= self.low * bottom)
        if self.high is not None:
            tests.append(top <= self.high * bottom)
        return reduce(and_, tests)


#: Limits in thousandths.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2500, high=12000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("exclamations", "n_exclamations", "n_words", high=500),
    Rule("capitals", "n_capitals", "word_chars", high=400),
    Rule("stop_words", "n_stop_words", "n_words", low=10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=400),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=300),
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules compare."""
    whole = F.coalesce(F.col(text), F.lit(""))
    structs = docs.select(
        "*",
        textstats.word_statistics(whole).alias("_words"),
        textstats.line_statistics(whole).alias("_lines"),
        F.length(textstats.without(whole, textstats.SPACES)).cast("long").alias("word_chars"),
        textstats.count_of(whole, textstats.SYMBOLS).cast("long").alias("n_symbols"),
        textstats.count_of(whole, "!").cast("long").alias("n_exclamations"),
        textstats.count_of(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"),
    )
    kept = [c for c in structs.columns if c not in ("_words", "_lines")]
    return structs.select(*kept, "_words.*", "_lines.*")


def apply_rules(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per row of ``docs``: its id, counts, the names of the rules it breaks, and whether it is kept.

    Null, empty and blank texts have no words, so the base test fails and they go. Other columns of ``docs`` are not
    carried, so their names cannot clash. Equal rows give equal results. A document is dropped by the base test (fewer
    than 20 words, or more than 30 percent of the words in repeated windows) or by any rule.
    """
    counts = measured(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))).drop("text")
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]))
    return counts.withColumns({"base_failed": base_failed, "broken_rules": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)
    )
