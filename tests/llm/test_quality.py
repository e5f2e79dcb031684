import math
import re

import pytest
from pyspark.sql import functions as F

from tillscope.llm import quality_classifier as qc
from tillscope.llm import quality_rules
from tillscope.llm.textstats import all_stop_words

CLEAN = "the cat sat on a mat and the dog lay by the door of that old house in town while it rained for days"
TEXTS = [
    None, "", " \t\n ", "one", CLEAN, CLEAN.upper() + "!!", " ".join(f"{w}&&&" for w in CLEAN.split()),
    " ".join([CLEAN] * 3), "\n".join([CLEAN] * 4), "été " * 30, "a b " * 400, "word " * 20000,
    "x\n\nx\n x\nx ", "…".join(["ein Satz ist hier"] * 9), CLEAN, CLEAN,
]


def plain(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
        len(words) < 20 or 100 * len(hit) > 30 * len(words),
    )


def test_counts_equal_plain_counts(documents):
    found = quality_rules.apply_rules(documents(*TEXTS)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert {r.doc_id: tuple(r[n] for n in names) for r in found} == {k: plain(t) for k, t in enumerate(TEXTS)}


def test_verdicts(documents):
    kept = {r.doc_id: (r.kept, r.broken_rules) for r in quality_rules.apply_rules(documents(*TEXTS)).collect()}
    assert kept[4][0] and kept[14][0] and kept[15][0]
    assert "capitals" in kept[5][1] and "symbols" in kept[6][1] and not kept[7][0]
    assert not any(kept[k][0] for k in (0, 1, 2, 3, 9, 10, 11))


def test_empty_table(documents, spark):
    assert quality_rules.apply_rules(documents().limit(0)).count() == 0


def test_no_python_in_the_plan(documents):
    plan = quality_rules.apply_rules(documents(*TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def labelled(spark):
    texts = [CLEAN + f" number {k}" for k in range(40)] + [" ".join(f"{w}{'&' * (k % 3 + 1)}" for w in CLEAN.split()) for k in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(None, None), (900, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 40)) for k in range(80)] + [(None, 1), (5000, 0), (3, None)], "doc_id long, label int")
    return docs, labels


def test_classifier_separates_held_out_rows(labelled):
    docs, labels = labelled
    scores, ensemble = qc.train_and_score(docs, labels, learn=F.col("doc_id") % 2 == 0)
    found = {r.doc_id: r.score for r in scores.collect()}
    assert len(found) == 82 and all(0 <= s <= 1 for s in found.values())
    assert all((found[k] >= 0.7) == (k < 40) for k in range(80))
    assert ensemble.weights and all(len(rule) <= qc.DEPTH for rule in ensemble.weights)


def plain_statistics(text):
    """The statistics of the rules, written out."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols, dup, repeats, _ = plain(text)
    per = lambda top, bottom: top / bottom if bottom else 0.0
    return {
        "log_words": math.log1p(n), "log_lines": math.log1p(len(lines)), "word_length": per(chars, n),
        "words_per_line": math.log1p(per(n, len(lines))), "symbols": per(symbols, n), "exclamations": per(text.count("!"), n),
        "stops": per(sum(c in ".,;:?" for c in text), n), "capitals": per(len(re.findall("[A-Z]", text)), chars),
        "digits": per(len(re.findall("[0-9]", text)), chars),
        "stop_words": per(sum(w.lower() in set(all_stop_words()) for w in words), n), "distinct_words": per(len(set(words)), n),
        "repeated_words": per(repeats, n), "repeated_lines": per(dup, len(lines)),
        "bullet_lines": per(sum(bool(re.match(r" *[-*•]", x)) for x in lines), len(lines)),
        "ellipsis_lines": per(sum(x.rstrip(" ").endswith(("...", "…")) for x in lines), len(lines)),
    }


def plain_score(text, ensemble):
    """The logistic sum of the weights of the rules that hold, rule by rule."""
    found, total = plain_statistics(text), ensemble.intercept
    for rule, weight in ensemble.weights.items():
        if all((found[x.statistic] > x.value) == x.above for x in rule):
            total += weight
    return 1 / (1 + math.exp(-total))


def test_scores_equal_those_of_a_plain_scorer(labelled, spark):
    docs, labels = labelled
    _, ensemble = qc.train_and_score(docs, labels, learn=F.lit(True))
    texts = [*TEXTS, "- a\n* b\n c...\nd …", "UPPER 123 lower, 4!", "the &&& of " * 30000]
    rows = [(k, t, 0.5, "x") for k, t in enumerate(texts)] + [(0, None, 0.5, "x"), (4, CLEAN, 0.1, "y"), (None, CLEAN, 0.2, "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, score double, n_words string")
    found = qc.score(qc.statistics(table), ensemble).collect()
    want = sorted(((k, plain_score(t, ensemble)) for k, t, *_ in rows), key=repr)
    got = sorted(((r.doc_id, r.score) for r in found), key=repr)
    assert [k for k, _ in got] == [k for k, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=1e-9)
    assert qc.score(qc.statistics(table.limit(0)), ensemble).count() == 0


@pytest.mark.parametrize("rows, want", [([], 0.5), ([(1, 1), (3, 1)], 1.0), ([(2, 0)], 0.0)])
def test_classifier_with_one_label_or_none(labelled, spark, rows, want):
    labels = spark.createDataFrame(rows, "doc_id long, label int")
    scores, _ = qc.train_and_score(labelled[0], labels, learn=F.lit(True))
    assert {round(r.score, 6) for r in scores.collect()} == {want}
