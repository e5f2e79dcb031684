import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillscope.llm import language_id, near_dedup, packing
from tillscope.llm.stored import stored

WORDS = {
    "en": "the house and garden with which they were thinking about weather every morning".split(),
    "de": "das Haus und der Garten über welche sie jeden Morgen wieder nachgedacht haben".split(),
}


def sentence(lang, n=25):
    return " ".join(random.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    random.seed(8)
    rows = [(k, sentence("en" if k % 2 else "de"), "en" if k % 2 else "de") for k in range(160)]
    rows += [(1000, None, "en"), (None, "the", None), (1001, "123 !", "de")]
    return language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_probabilities_of_a_context_sum_to_one(model):
    base, _ = language_id.codes(pa.array(["the gar", "zzz qqq", ""]))
    letters = np.unique(np.concatenate([language_id.codes(pa.array([" ".join(WORDS["en"] + WORDS["de"])]))[0] & np.uint64(0xFFFF), [0]]).astype(np.uint64))
    for code in base[:6]:
        context = code >> np.uint64(16) << np.uint64(16)
        total = model.probabilities(context | letters).sum(axis=0)
        assert (total <= 1.0 + 1e-6).all() and (total > 0.9).all()


def test_languages_scores_and_rejection(spark, model):
    random.seed(9)
    texts = [sentence("en"), sentence("de"), None, "", "42 %!", "zxqj vkwq xzjq " * 30, sentence("en", 3), sentence("de", 4000)]
    table = spark.createDataFrame([(k, t, 1.0) for k, t in enumerate(texts)], "doc_id long, text string, score double")
    rows = {r.doc_id: r for r in language_id.classify(table, model).collect()}
    assert [rows[k].lang_pred for k in range(8)] == ["en", "de", "und", "und", "und", rows[5].lang_pred, "en", "de"]
    assert all(0.0 <= r.score <= 1.0 for r in rows.values()) and rows[0].score > 0.9
    assert [rows[k].rejected for k in range(8)] == [False, False, True, True, True, True, False, False]
    assert {r.doc_id for r in language_id.without_rejected(table, model).collect()} == {0, 1, 6, 7}
    assert language_id.classify(table.limit(0), model).count() == 0


def test_grams_of_a_text():
    code, rows = language_id.codes(pa.array(["Ab, c", None, "é"]))
    text = lambda c: "".join(chr(int(c) >> s & 0xFFFF) if int(c) >> s & 0xFFFF else "_" for s in (48, 32, 16, 0))
    assert [text(c) for c in code] == ["___a", "__ab", "_ab_", "ab_c", "___é"] and rows.tolist() == [0, 0, 0, 0, 2]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 50])
def test_pieces_of_long_texts_change_no_gram(monkeypatch, piece):
    random.seed(piece)
    texts = ["".join(random.choice("ab é.\n1ßЖ𝒳") for _ in range(random.randint(0, 120))) for _ in range(60)] + [None, "", "   a", "...."]
    whole, rows = language_id.codes(pa.array(texts))
    monkeypatch.setattr(language_id, "PIECE", piece)
    cut, own = language_id.codes(pa.array(texts))
    for k in range(len(texts)):
        assert whole[rows == k].tolist() == cut[own == k].tolist()


def test_no_learned_language(spark):
    none = language_id.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    row = language_id.classify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), none).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)


def test_a_pruned_model_still_tells_languages_apart(spark):
    random.seed(3)
    rows = [("en" if k % 2 else "de", sentence("en" if k % 2 else "de")) for k in range(60)]
    small = language_id.train(spark.createDataFrame(rows, "lang string, text string"), max_grams=40)
    assert all(len(keys) <= 80 for keys, _ in small.grams.values())
    _, entropies = small.entropies(pa.array([sentence("de"), sentence("en")]))
    assert small.languages == ["de", "en"] and entropies.argmin(axis=1).tolist() == [0, 1]


def plain_entropy(texts, text):
    """Kneser-Ney of all grams over one language's texts, written out."""
    levels = {4: {}}
    for code in language_id.codes(pa.array(texts))[0].tolist():
        levels[4][code] = levels[4].get(code, 0) + 1
    for k in (3, 2, 1):
        levels[k] = {}
        for code in levels[k + 1]:
            low = code & ((1 << 16 * k) - 1)
            levels[k][low] = levels[k].get(low, 0) + 1
    characters = len(levels[1])

    def p(code, k):
        if k == 0:
            return 1 / (characters + 1)
        code &= (1 << 16 * k) - 1
        n1, n2 = (sum(v == x for v in levels[k].values()) for x in (1, 2))
        d = min(max(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.1), 0.9)
        same = [v for c, v in levels[k].items() if c >> 16 == code >> 16]
        if not same:
            return p(code, k - 1)
        return max(levels[k].get(code, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p(code, k - 1)

    cost = [-np.log(p(code, 4)) for code in language_id.codes(pa.array([text]))[0].tolist()]
    return sum(cost) / len(cost)


@pytest.mark.parametrize("cells", [4_000_000, 30, 1])
def test_every_gram_counts_whatever_tasks_hold(spark, monkeypatch, cells):
    random.seed(4)
    monkeypatch.setattr(language_id, "HELD_CELLS", cells)
    seen = [sentence("en") for _ in range(20)] + ["qxv zzkw jjyx vvq"]
    texts = [sentence("en"), "qxv zzkw jjyx vvq", "zzkw never seen жук", "the qxv"]
    model = language_id.train(spark.createDataFrame([("en", t) for t in seen], "lang string, text string"), max_grams=cells)
    model.weight, model.means, model.spreads = 1.0, np.array([3.0]), np.array([3.0])
    table = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, *texts])], "doc_id long, text string")
    found = {r.doc_id: r.cross_entropy for r in language_id.classify(table, model).collect()}
    assert [found[k] for k in range(8)] == pytest.approx([plain_entropy(seen, t) for t in texts] * 2, rel=1e-9)
    assert model.entropies(pa.array(texts))[1][:, 0] == pytest.approx([found[k] for k in range(4)], rel=1e-9)


def test_calibration_rows_are_learned_too(spark):
    random.seed(5)
    folds = {k: zlib.crc32(str(k).encode()) % 4 for k in range(200)}
    rows = [(k, sentence("en"), "en") for k in folds] + [(k, sentence("de"), "de") for k, f in folds.items() if f == 3]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    used = [t for k, t, name in rows if name == "en" and folds[k] != 2]
    counted = {r.code for r in model.seen[4].where("p[1] IS NOT NULL").collect()}
    assert model.languages == ["de", "en"]
    assert counted == set(language_id.codes(pa.array(used))[0].view(np.int64).tolist())
    found = language_id.classify(spark.createDataFrame([(1, sentence("de"))], "doc_id long, text string"), model).first()
    assert (found.lang_pred, found.rejected) == ("de", False)


def test_a_wide_spread_of_few_rows_does_not_void_rejection(spark):
    random.seed(6)
    train = [("en" if k % 2 else "de", sentence("en" if k % 2 else "de")) for k in range(40)]
    odd = [("de", sentence("en", 40)) for _ in range(2)]
    own = [("de", sentence("de")) for _ in range(8)] + odd + [("en", sentence("en")) for _ in range(200)]
    model = language_id.train(spark.createDataFrame(train, "lang string, text string"))
    language_id.calibrate(model, spark.createDataFrame(own, "lang string, text string"))
    assert model.spreads[0] < 5.0
    model.spreads = np.array([50.0, 50.0])
    found = language_id.classify(spark.createDataFrame([(1, "жук идёт домой " * 10)], "doc_id long, text string"), model).first()
    assert found.rejected


def test_every_stage_acts_on_what_the_one_before_kept(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, folder))
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert {r.doc_id for r in after} <= set(before)
        if name in ("language_id", "near_dedup", "decontamination"):
            assert all(r.text == before[r.doc_id] for r in after)
        if name == "line_dedup":
            lines = [line for r in after for line in r.text.split("\n") if line.strip()]
            assert len(lines) == len(set(lines))
            assert {line for t in before.values() for line in t.split("\n") if line.strip()} >= set(lines)
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "near_dedup":
            left = near_dedup.near_duplicates(docs).documents
            assert left.where("doc_id <> class_id").count() == 0
        if name == "packing":
            assert {r.doc_id for r in after} == set(before)
            assert max(F.col and r.offset + r.length for r in after) <= packing.CAPACITY
            sizes = {r.doc_id: r.doc_tokens for r in after}
            assert sum(r.length for r in after) == sum(sizes.values())
    assert texts and items
