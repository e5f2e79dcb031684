import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillscope.llm import trees, vector_codes as vc
from tillscope.llm.oracles import ORACLES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codebooks, and code and error of each row, by comparing every part with every entry."""
    rows = sorted(((i, [math.floor(scale * x) for x in v], label) for i, v, label in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    nearest = lambda u, book: min((sum((a - b) ** 2 for a, b in zip(u, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], book)[1], []).append(c[p])
            for k, members in groups.items():
                book[k] = [sum(x) // len(members) for x in zip(*members)]
    coded = []
    for (i, _, label), c in zip(rows, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    return [x for book in books for e in book for x in e], coded


def vectors(n, width=16, seed=3, centres=5):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(centres)]
    return [(k, [float(np.float32(m + rng.gauss(0, 0.05))) for m in rng.choice(middles)], rng.choice([1, 1, 1, 2, None])) for k in range(n)]


def compressed(spark, rows, parts=4, **options):
    given = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA).repartition(parts)
    codes = vc.compress(given, **options)
    return codes, sorted(((r.vec_id, r.label, r.code, r.error) for r in codes.rows.collect()), key=repr)


@pytest.mark.parametrize("n, block, leaf", [(400, 2048, 16), (400, 37, 3), (9, 4, 1), (1, 8, 16)])
def test_equal_to_comparing_everything(spark, n, block, leaf):
    rows = vectors(n)
    codes, got = compressed(spark, rows, block=block, leaf=leaf)
    books, want = plain(rows)
    assert [x for b in codes.codebooks for x in b.ravel().tolist()] == books
    assert got == sorted(want, key=repr)


def test_ties_repeats_and_whole_nodes(spark):
    rows = [(k, [float(k % 3)] * 16, 1) for k in range(90)] + [(200 + k, [0.5] * 16, None) for k in range(300)] + [(5, [1.0] * 16, 2)] * 2
    codes, got = compressed(spark, rows, leaf=4)
    books, want = plain(rows)
    assert [x for b in codes.codebooks for x in b.ravel().tolist()] == books and got == sorted(want, key=repr)


def test_unsound_vectors_go(spark):
    good = vectors(30)
    bad = [(100, None, 1), (101, [], 1), (102, [None] * 16, 1), (103, [math.nan] + [0.0] * 15, 1), (104, [math.inf] * 16, 1),
           (105, [-math.inf] * 16, 1), (106, [0.0] * 15, 1), (107, [1e30] * 16, 1)]
    codes, got = compressed(spark, good + bad)
    assert got == compressed(spark, good)[1] and len(got) == 30
    unnamed = vectors(20) + [(None, [0.1] * 16, None), (None, [0.2] * 16, None)]
    assert len(compressed(spark, unnamed)[1]) == 22


def test_components_at_the_limit(spark):
    top = vc.greatest_component(16) / vc.SCALE
    rows = [(k, [top * (-1) ** (k + j) for j in range(16)], 1) for k in range(40)]
    codes, got = compressed(spark, rows)
    assert got == sorted(plain(rows)[1], key=repr)


def test_empty_table_and_uneven_parts(spark):
    codes, got = compressed(spark, [(1, None, 2)])
    assert got == [] and codes.codebooks == []
    codes, got = compressed(spark, [(k, [float(k)] * 5, 1) for k in range(3)], entries=2, rounds=0)
    assert [b.shape for b in codes.codebooks] == [(2, 1)] * 5 and [g[2] for g in got] == ["00" * 5, "01" * 5, "01" * 5]


def test_label_error_joins_nulls(spark):
    rows = spark.createDataFrame([(1, 7, "a", 5), (2, None, "b", 3), (3, None, "c", 4)], "vec_id long, label int, code string, error long")
    got = {r.vec_id: r.label_error for r in vc.with_label_error(rows).collect()}
    assert got == {1: 5, 2: 7, 3: 7}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 9), st.integers(1, 3), st.integers(1, 5), st.integers(0, 6), st.integers(0, 999))
def test_walk_over_pairs_of_nodes(n, m, width, leaf, spread, seed):
    rng = np.random.default_rng(seed)
    points, entries = rng.integers(-spread, spread + 1, (n, width)), rng.integers(-spread, spread + 1, (m, width))
    tree, entry_tree = trees.build(points, leaf), trees.build(entries, 1)
    ordered = points[tree.order]
    found = trees.assign(ordered, tree, entries, entry_tree)
    got = np.full(n, -1)
    for (first, last), entry in zip(trees.ranges(n, tree.depth)[found.nodes], found.whole):
        got[first:last] = entry
    got[found.places] = found.single
    want = trees.squared_distances(ordered, entries).argmin(axis=1)
    assert (got == want).all()
    assert (tree.sum_of(np.array([1])) == points.sum(axis=0)).all()
    assert len(found.places) + sum(b - a for a, b in trees.ranges(n, tree.depth)[found.nodes]) == n


def test_sql_has_seven_assignments():
    assert ORACLES["op13_vector_code_compression"].count("arg_min") == 7
