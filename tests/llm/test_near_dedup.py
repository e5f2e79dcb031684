import random

import numpy as np
import pyarrow as pa

from tillscope.llm import near_dedup, order_sketch
from tillscope.llm.components import components
from tillscope.llm.words import shingles, split_words


def common(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_in_a_wide_band_is_the_longest_common_subsequence():
    random.seed(1)
    for _ in range(300):
        x = [random.randrange(4) for _ in range(random.randrange(0, 30))]
        y = [random.randrange(4) for _ in range(random.randrange(0, 30))]
        assert order_sketch.banded_alignment(x, y, 40) == common(x, y)
        assert order_sketch.banded_alignment(x, y, 3) <= common(x, y)


def test_similarity_equals_full_alignment():
    random.seed(2)
    for _ in range(300):
        x = [random.randrange(50) for _ in range(random.randrange(1, 60))]
        y = [v for v in x if random.random() < 0.95]
        y = [random.randrange(50) if random.random() < 0.04 else v for v in y]
        m = common(x, y)
        want = m / (len(x) + len(y) - m)
        got = order_sketch.similarity(np.array(x, np.uint64), np.array(y, np.uint64))
        assert got == (want if want >= 0.8 else 0.0)


def test_words_are_cut_as_defined():
    texts = ["Ab, c\x00d", None, "", "x" * 10, "É a-b", " ".join(["w"] * 5), "\x80é_z"]
    found = split_words(pa.array(texts))
    assert [found.text(a, b) for a, b in zip(found.first[:-1], found.first[1:])] == ["ab c d", "", "", "x" * 10, "É a b", "w w w w w", "\x80é z"]
    again = split_words(pa.array(["pad", *texts])).hashes[1:]
    assert (again == found.hashes).all()
    assert len(shingles(found, 5)[0]) == 1


def many(n, seed):
    random.seed(seed)
    return [f"w{random.randrange(500)}" for _ in range(n)]


def changed(words, n):
    words = list(words)
    for _ in range(n):
        words[random.randrange(len(words))] = f"z{random.randrange(10**6)}"
    return words


def plain(texts):
    words = [split_words(pa.array([(t or "").lower()])) for t in texts]
    keys = [w.text(0, len(w.hashes)) for w in words]
    rows = [shingles(w, 5)[1] for w in words]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if keys[i] == keys[j] or order_sketch.similarity(rows[i], rows[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(texts))}


def test_classes_equal_plain_search(documents):
    base = [many(200, s) for s in range(4)]
    texts = [" ".join(changed(b, n)) for b in base for n in (0, 1, 2, 3, 4, 4, 8, 12)]
    texts += [texts[3].upper(), texts[3] + ".", None, "", " ;", "one two", "One, two!", "one three", " ".join(many(6000, 9)), "a " * 400, "a " * 390]
    found = near_dedup.near_duplicates(documents(*texts)).documents.collect()
    assert {r.doc_id: r.class_id for r in found} == plain(texts)


def test_short_texts_at_the_limit_share_a_bucket():
    missed = 0
    for seed in range(2000):
        words = [f"w{seed}a{k}" for k in range(9)]
        one, other = (shingles(split_words(pa.array([" ".join(words[:n])])), 5)[1] for n in (8, 9))
        keys = [order_sketch.band_keys(h, order_sketch.bands_of(len(h))) for h in (one, other)]
        missed += not (keys[0][: len(keys[1])] == keys[1][: len(keys[0])]).any()
    assert missed <= 8  # 24 bands miss about 30


def test_a_group_whose_members_are_close_to_a_centre_only(documents):
    centre = many(300, 77)
    texts = [" ".join(changed(centre, 5)) for _ in range(60)] + [" ".join(centre)]
    found = near_dedup.near_duplicates(documents(*texts)).documents.collect()
    assert {r.doc_id: r.class_id for r in found} == plain(texts)


def test_rows_without_id_and_repeated_ids(documents):
    text = " ".join(many(30, 5))
    docs = documents(text, text, text, "x y", "x y", ids=[None, 4, 4, 9, None])
    found = near_dedup.near_duplicates(docs).documents.collect()
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in found) == [(0, 0), (0, 0), (4, 4), (4, 4), (9, 9)]
    assert near_dedup.near_duplicates(docs.limit(0)).documents.count() == 0
    kept = near_dedup.without_near_duplicates(documents(text, text, "x y", ids=[3, 1, 2]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 300), (300, 200), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 1 for k in range(1, 61)}, 100: 100, 200: 100, 300: 100}
