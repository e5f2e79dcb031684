"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees of a random forest are cut into paths; each path from a root is a rule, a conjunction of limits on statistics.
A logistic regression with a lasso penalty weighs the rules and drops most of them. What is left is compiled into one
Spark expression, so scoring needs no model on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm import textstats
from tillscope.llm.quality_rules import measured
from tillscope.llm.stored import stored

TREES = 24
DEPTH = 3
PENALTY = 0.001
SEED = 11


def _ratio(top: str, bottom: str) -> Column:
    return F.coalesce(F.col(top) / F.nullif(F.col(bottom), F.lit(0)), F.lit(0.0)).cast("double")



def _statistics() -> dict[str, Column]:
    """Statistics by name, over the counts of ``quality_rules.measured`` and a few more."""
    return {
        "log_words": F.log1p("n_words"),
        "log_lines": F.log1p("n_lines"),
        "word_length": _ratio("word_chars", "n_words"),
        "words_per_line": F.log1p(_ratio("n_words", "n_lines")),
        "symbols": _ratio("n_symbols", "n_words"),
        "exclamations": _ratio("n_exclamations", "n_words"),
        "stops": _ratio("n_stops", "n_words"),
        "capitals": _ratio("n_capitals", "word_chars"),
        "digits": _ratio("n_digits", "word_chars"),
        "stop_words": _ratio("n_stop_words", "n_words"),
        "distinct_words": _ratio("n_distinct_words", "n_words"),
        "repeated_words": _ratio("n_repeat_words", "n_words"),
        "repeated_lines": _ratio("n_dup_lines", "n_lines"),
        "bullet_lines": _ratio("n_bullet_lines", "n_lines"),
        "ellipsis_lines": _ratio("n_ellipsis_lines", "n_lines"),
    }


@dataclass(frozen=True)
class Limit:
    statistic: str
    above: bool
    value: float

    def holds(self) -> Column:
        column = F.col(self.statistic)
        return column > self.value if self.above else column <= self.value


Rule = frozenset[Limit]


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: dict[Rule, float]

    def score(self) -> Column:
        """The probability of label 1 as an expression over the statistics."""
        terms = [F.when(_holds(rule), F.lit(w)).otherwise(0.0) for rule, w in self.weights.items()]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(add, terms, F.lit(self.intercept))))


def _holds(rule: Rule) -> Column:
    return reduce(and_, [limit.holds() for limit in sorted(rule, key=lambda x: (x.statistic, x.above, x.value))])


def statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of each row; a null text is an empty one."""
    counts = measured(docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    more = counts.withColumns({
        "n_digits": textstats.count_of(F.col("text"), "0123456789"), "n_stops": textstats.count_of(F.col("text"), ".,;:?"),
    })
    return more.select("doc_id", *[c.alias(name) for name, c in _statistics().items()])


def _paths(node, names: list[str], limits: Rule = frozenset()) -> list[Rule]:
    """The rules of all nodes below a tree's node."""
    if node.subtreeDepth() == 0:
        return []
    split = node.split()
    name, value = names[split.featureIndex()], float(split.threshold())
    rules = []
    for above, child in ((False, node.leftChild()), (True, node.rightChild())):
        rule = limits | {Limit(name, above, value)}
        rules += [rule, *_paths(child, names, rule)]
    return rules


def fit(found: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleEnsemble:
    """An ensemble from rows of statistics with a ``label`` of 0 or 1; rows with another label are not used.

    With one label only, the ensemble has no rule and always gives that label; with none it gives 0.5.
    """
    names = list(_statistics())
    rows = stored(found.where("label IN (0, 1)").select(*names, F.col("label").cast("double").alias("label")))
    labels = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if len(labels) < 2:
        return RuleEnsemble(0.0 if not labels else 50.0 if labels == [1.0] else -50.0, {})
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="sqrt", cacheNodeIds=False
    ).fit(assembled)
    rules = sorted(
        {rule for tree in forest.trees for rule in _paths(tree._java_obj.rootNode(), names)},
        key=lambda rule: sorted((x.statistic, x.above, x.value) for x in rule),
    )
    held = rows.select("label", *[_holds(rule).cast("double").alias(f"rule{k}") for k, rule in enumerate(rules)])
    matrix = VectorAssembler(inputCols=held.columns[1:], outputCol="features").transform(held).select("label", "features")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(stored(matrix))
    weights = {rule: w for rule, w in zip(rules, lasso.coefficients.toArray().tolist()) if w != 0.0}
    return RuleEnsemble(float(lasso.intercept), weights)


def score(found: DataFrame, ensemble: RuleEnsemble) -> DataFrame:
    """``doc_id, score`` of rows of statistics."""
    return found.select("doc_id", ensemble.score().alias("score"))


def train_and_score(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[DataFrame, RuleEnsemble]:
    """Scores of all ``docs`` by an ensemble fitted on those of the ``labels`` (``doc_id, label``) where ``learn`` holds.

    Statistics are computed once, over whole texts. A null, empty or blank text has statistics of 0 and a score like any
    other. A document with several labels counts once for each; labels without a document, null ids and null labels are
    not used; equal rows are scored alike. Other columns are not carried.
    """
    found = stored(statistics(docs))
    known = found.where(F.coalesce(learn, F.lit(False))).join(labels.select("doc_id", "label"), "doc_id")
    ensemble = fit(known)
    return score(found, ensemble), ensemble
