import random

import pytest
from pyspark.sql import functions as F

from tillscope.llm import line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(text, edits):
    for _ in range(edits):
        at = random.randrange(len(text) or 1)
        text = random.choice([text[:at] + text[at + 1 :], text[:at] + random.choice("abé𝄞") + text[at:], text[:at] + "z" + text[at + 1 :]])
    return text


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_automaton_equals_edit_distance(spark, threshold):
    random.seed(threshold)
    pairs = []
    for _ in range(150):
        a = "".join(random.choice("abé𝄞 ") for _ in range(random.randrange(0, 14)))
        pairs.append((a, edited(a, random.randrange(5)) if a else "ab"))
    pairs += [("", ""), ("", "a"), ("abc", "abc")]
    found = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), threshold).alias("near")
    )
    for r in found.collect():
        assert r.near == (distance(r.a, r.b) <= threshold), (r.a, r.b)


def plain(docs, threshold, least):
    lines = [(doc, place, line) for doc, text in docs if text for place, line in enumerate(text.split("\n")) if line.strip(" \t\r\x0b\x0c")]
    first = {}
    for doc, place, line in lines:
        first[line] = min(first.get(line, (doc, place)), (doc, place))
    near = {
        a for a in first for b in first
        if a != b and first[b] < first[a] and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= threshold
        and distance(a, b) <= threshold
    }
    links = {
        a: sum(a != b and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold
               for b in first)
        for a in first
    }
    out = {doc: ([], [], []) for doc, _ in docs}
    for doc, place, line in lines:
        out[doc][2].append(links[line])
        if first[line] != (doc, place):
            out[doc][0].append(place)
        elif line in near:
            out[doc][1].append(place)
    return {doc: (exact, near, sum(n)) for doc, (exact, near, n) in out.items()}


def decided(docs, **options):
    found = line_dedup.decide(docs, **options).documents.collect()
    return {r.doc_id: (list(r.exact), list(r.near), r.n_links) for r in found}


def test_equals_plain_search(documents):
    random.seed(5)
    base = ["".join(random.choice("abcde fé") for _ in range(random.randrange(18, 60))) for _ in range(12)]
    texts = ["\n".join(edited(random.choice(base), random.choice([0, 0, 1, 2, 3])) for _ in range(5)) for _ in range(40)]
    texts += [None, "", "\n \n", "short\nshort\nshort", base[0] * 300]
    found = line_dedup.decide(documents(*texts)).documents.collect()
    want = plain(list(enumerate(texts)), 2, 20)
    assert {r.doc_id: (list(r.exact), list(r.near), r.n_links) for r in found} == want
    assert any(near for _, near, _ in want.values())
    assert {r.doc_id: r.n_lines for r in found}[40] == 0 and {r.doc_id: r.n_lines for r in found}[42] == 3


def test_cleaned_documents(documents):
    long = "a line that is long enough to be compared with others"
    docs = documents(f"{long}\nown one", f"x\n{long}", long, f"{long[:-1]}\nkept", None, "", long, ids=[1, 2, 3, 4, 5, 6, 1])
    found = line_dedup.without_repeated_lines(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [
        (1, f"{long}\nown one"), (2, "x"), (4, "kept"), (5, None), (6, "")
    ] or sorted((r.doc_id, r.text or "") for r in found.collect()) == [(1, long), (1, "own one"), (2, "x"), (4, "kept"), (5, ""), (6, "")]


def test_equal_rows_are_one_document_and_empty_table(documents):
    docs = documents("some words here", "some words here", ids=[1, 1])
    assert [r.n_links for r in line_dedup.decide(docs).documents.collect()] == [0, 0]
    long = "some words here that are long enough"
    twice = documents(long, long, long + "!", ids=[1, 1, 2])
    assert sorted(r.n_links for r in line_dedup.decide(twice).documents.collect()) == [1, 1, 1]
    assert [(list(r.exact), r.n_lines) for r in line_dedup.decide(docs).documents.collect()] == [([], 1), ([], 1)]
    assert line_dedup.decide(docs.limit(0)).documents.count() == 0


def test_lines_that_occur_often(documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "OFTEN", 2)
    random.seed(6)
    base = ["".join(random.choice("abcde fé") for _ in range(40)) for _ in range(4)]
    texts = ["\n".join(edited(random.choice(base), random.choice([0, 0, 0, 1])) for _ in range(6)) for _ in range(12)]
    assert decided(documents(*texts)) == plain(list(enumerate(texts)), 2, 20)


@pytest.mark.parametrize("threshold", [0, 1, 2])
def test_lines_of_every_length_can_be_compared(documents, threshold):
    random.seed(9)
    texts = ["\n".join("".join(random.choice("ab c") for _ in range(random.randrange(0, 9))) for _ in range(4)) for _ in range(25)]
    got = decided(documents(*texts), threshold=threshold, near_length=threshold + 1)
    assert got == plain(list(enumerate(texts)), threshold, threshold + 1)
    with pytest.raises(ValueError):
        line_dedup.decide(documents(*texts), threshold=threshold, near_length=threshold)


def test_no_python_in_the_plan(documents):
    plan = line_dedup.decide(documents("a\nb")).documents._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_few_texts_of_a_large_group_are_compared(documents, monkeypatch):
    words = [f"word{chr(97 + k)}" for k in range(12)]
    lines = [" ".join([*words[:k], "thirteen", *words[k:]]) + f" {j}{j}{j}" for k in (1, 10) for j in range(10)]
    held, stored = {}, line_dedup.stored

    def counted(df):
        held[tuple(df.columns)] = out = stored(df)
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    found = line_dedup.decide(documents(*lines)).documents.collect()
    assert sum(r.n_links for r in found) == 0
    assert held["h1_a", "h1_b"].count() <= 90  # of 190: those with the word at the same place
