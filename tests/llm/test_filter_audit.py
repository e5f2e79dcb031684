import itertools
import re

import pytest
from pyspark.sql import functions as F

from tillscope.llm import filter_audit as fa

LONG = " ".join(f"word{k}" for k in range(60))
TEXTS = [
    None, "", "one", LONG, LONG, LONG + " $", LONG.upper(), "a b " * 40, "A B " * 40, LONG + "\x0b|\x0c" + LONG, "x " * 30000 + LONG,
    "  ", "Ä" * 10 + " " + LONG, LONG, "", "%",
]
SCHEMA = "doc_id long, text string, source string, part string, mask int, kept boolean"
LABELS = "doc_id long, quality int, toxic int, good string"


def plain(docs, labels):
    """The audit by running all 120 orders over the documents."""
    firsts, marks = {}, {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            firsts[text or ""] = min(firsts.get(text or "", doc_id), doc_id)
    for doc_id, quality, toxic, _ in labels:
        good, bad = marks.get(doc_id, (False, False))
        marks[doc_id] = (good or quality == 1, bad or toxic == 1)
    judged = []
    for doc_id, text, source, *_ in docs:
        text, words = text or "", [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > firsts[text],
        }
        judged.append((source or "", {k for k, v in fails.items() if v}, *marks.get(doc_id if doc_id is not None else "-", (False, False))))
    out = {}
    for part in {row[0] for row in judged}:
        inside = [row for row in judged if row[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = inside
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in inside) - len(gone), sum(r[1] == {f} for r in inside),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def found(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in df.collect()}


def test_audit_equals_running_all_orders(spark):
    docs = [(k, t, ["a", "b", None][k % 3], "p", 7, True) for k, t in enumerate(TEXTS)]
    docs += [(None, LONG, "a", "", 0, False), (None, None, "a", "", 0, False), (3, LONG, "a", "", 0, False), (3, LONG, "b", "", 0, False)]
    labels = [(k, k % 2, int(k % 5 == 0), "x") for k in range(12)] + [(3, 0, None, None), (None, 1, 1, None), (99, 1, 1, None)]
    audit = fa.audit_documents(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS))
    got = found(audit)
    assert got == plain(docs, labels) and len(got) == 3 * 600


def test_potentials_of_a_known_game(spark):
    # Two filters fail 3 and 5 documents, 2 of them both: worths 0, 3, 5, 6.
    row = spark.range(1).select(fa.potentials(F.array(*[F.lit(x).cast("long") for x in (0, 3, 5, 6)]), 2).alias("p")).first()
    assert row.p == [0, 6, 10, 14]  # twice P; the filters get 14 - 10 and 14 - 6 over the two orders: 2 * (2 + 4)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert fa.audit_documents(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", "s", "", 0, True)], SCHEMA)
    assert {r.removed for r in fa.audit_documents(one, labels).where("filter_order = 'ABCDE' AND step = 1").collect()} == {1}


@pytest.mark.parametrize("names", [[], list("ABCDEFG"), ["AB"], ["'"]])
def test_names_are_checked(spark, names):
    with pytest.raises(ValueError):
        fa.audit(spark.createDataFrame([], "part string, mask int, n long, good long, toxic long"), names)
