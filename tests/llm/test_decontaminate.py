import random
import re

from tillscope.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, window):
    cut = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            cut.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for window_words, names in cut.items():
            n = len(window_words)
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == window_words:
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((doc, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=repr)


def test_equals_plain_search(documents, spark):
    random.seed(3)
    some = lambda n: " ".join(random.choice("ab é C,d. x1".split()) for _ in range(n))
    items = [(k, some(random.choice([0, 1, 2, 3, 4, 5, 9]))) for k in range(14)] + [(50, None), (51, "…!"), (52, "a b"), (53, "A, b"), (53, "é x1 é")]
    texts = [some(random.choice([0, 1, 4, 12, 60])) for _ in range(30)] + [None, "", some(3000), "A b", "a b", "a b"]
    ids = [*range(len(texts) - 2), 900, 900]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_hit int")
    for window in (4, 2):
        found = decontaminate.find_overlaps(documents(*texts, ids=ids), table, window=window).by_document().collect()
        got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in found), key=repr)
        assert got == plain(list(zip(ids, texts)), items, window)


def test_equal_ids_with_different_texts_are_told_apart(documents, spark):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = documents("x one two three y", "nothing here", "one two three", ids=[7, 7, None])
    found = decontaminate.find_overlaps(docs, items).by_document().collect()
    assert sorted((r.doc_id or -1, r.n_hit) for r in found) == [(-1, 3), (7, 0), (7, 3)]
    assert [r.text for r in decontaminate.without_contaminated(docs, items).collect()] == ["nothing here"]


def test_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.find_overlaps(documents("a b", None), none).by_document().collect()
    assert sorted((r.n_words, r.n_hit, list(r.item_ids)) for r in found) == [(0, 0, []), (2, 0, [])]
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate.find_overlaps(documents().limit(0), some).by_document().count() == 0


def test_a_small_filter_changes_nothing(documents, spark):
    items = spark.createDataFrame([(k, f"w{k} v{k} u{k} t{k}") for k in range(40)], "item_id long, text string")
    docs = documents(*[f"a w{k} v{k} u{k} t{k} b" if k % 2 else f"w{k} v{k} z" for k in range(40)])
    found = decontaminate.find_overlaps(docs, items, window=4, filter_bits=8).by_document().collect()
    assert {r.doc_id: r.n_hit for r in found} == {k: 4 * (k % 2) for k in range(40)}
