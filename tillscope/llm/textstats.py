"""Text statistics as Spark column expressions.

Words are runs of characters other than space and U+0009 to U+000D; lines are cut at ``\\n``. A null text counts as an
empty one. Array functions run inside the JVM; nothing here needs a user function.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of the four languages of the test tables.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "as", "with", "be", "by", "on", "not", "he",
           "this", "are", "or", "his", "from", "at", "which", "but", "have", "an", "had", "they", "you", "was", "were"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem",
           "nicht", "ein", "eine", "als", "auch", "es", "an", "werden", "aus", "er", "hat", "dass", "sie", "nach"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par",
           "plus", "pas", "au", "sur", "ne", "se", "ce", "il", "sont", "avec", "son", "aux", "ou", "elle"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una",
           "su", "al", "lo", "como", "más", "pero", "sus", "le", "ya", "o", "este", "sí", "porque"],
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of the text are in ``characters``."""
    return F.length(text) - F.length(without(text, characters))


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def word_lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.length(without(line, SPACES)) > 0)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words which occurs twice or more in the list, first one included.

    Windows are compared by 64-bit hash of their words. Only a list with a repeated window is sorted.
    """

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1) - p, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def in_repeats(ordered: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            beside = F.when(k > 0, F.get(ordered, k - 1)["h"]).eqNullSafe(x["h"])
            return beside | F.get(ordered, k + 1)["h"].eqNullSafe(x["h"])

        places = F.array_sort(F.transform(F.filter(ordered, repeated), lambda x: x["i"]))
        return let(places, covered)

    def from_hashes(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(ordered, in_repeats))

    starts = F.sequence(F.lit(1), F.size(words) - (width - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, width)))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(let(hashes, from_hashes))


def stop_words_in(words: Column, stop_words: Sequence[str]) -> Column:
    return F.size(F.filter(words, lambda w: F.lower(w).isin(list(stop_words))))


def all_stop_words() -> list[str]:
    return sorted({w for words in STOP_WORDS.values() for w in words})


def word_statistics(text: Column) -> Column:
    """A struct of counts that need the list of words."""

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            stop_words_in(words, all_stop_words()).cast("long").alias("n_stop_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
        )

    return let(word_list(text), of)


def line_statistics(text: Column) -> Column:
    """A struct of counts over lines with a word."""

    def of(lines: Column) -> Column:
        distinct = F.size(F.array_distinct(lines)).cast("long")
        bulleted = F.filter(lines, lambda line: F.ltrim(line).rlike(r"^[-*•]"))
        trailing = F.filter(lines, lambda line: F.rtrim(line).endswith("...") | F.rtrim(line).endswith("…"))
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - distinct).alias("n_dup_lines"),
            F.size(bulleted).cast("long").alias("n_bullet_lines"),
            F.size(trailing).cast("long").alias("n_ellipsis_lines"),
        )

    return let(word_lines(text), of)
