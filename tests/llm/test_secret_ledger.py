import re
from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillscope.llm.secret_ledger import BASE_RULES, RULES, SecretLedger, joined_spans, scan
from pyspark.sql import functions as F

KEY = "AKIA" + "A1B2C3D4E5F6G7H8"
PATTERNS = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24),
    "github": ("gh[oprsu]_[A-Za-z0-9]{36,}", 0, 1), "pem": ("-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
}
TEXTS = [
    None, "", "nothing", "password = hunter22", "PassWD:'abc'", "token=secret=abcdefgh", "token = token: abcdefgh", f"{KEY} {KEY[:-1]}",
    KEY + "0" * 30, "é" * 3 + "a" * 24 + "ü" + "0" * 23, "𝒳 api_key: \"AbC/+=.-_x\" tail 𝒳 apikey=123456", "x" + "f" * 50 + "g" + "f" * 24,
    "ghp_" + "a1" * 18 + "-----BEGIN RSA PRIVATE KEY-----", "toKen=abcdefgh ſecret=abcdefgh", "token=short secret='longer1'",
    "secret: " + "aB3" * 40000, " ".join(["token=abcdef"] * 3000), "token" + " " * 50000 + "x", "token=abcdef\ntoken=abcde",
]


def plain(text, kinds=tuple(PATTERNS)):
    spans = []
    for rank, kind in enumerate(kinds):
        pattern, group, least = PATTERNS[kind]
        spans += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
    return [(kind, a, b) for a, _, kind, b in sorted(spans)]


def found(ledger, rules=RULES):
    rows = ledger.by_path(rules).collect()
    return sorted(((r.path, [(s.kind, s.start, s.end) for s in r.spans]) for r in rows), key=repr)


@pytest.fixture
def ledger(spark, tmp_path):
    return SecretLedger(spark, str(tmp_path / "ledger"))


def table(spark, rows):
    """Extra columns have the names that results have."""
    return spark.createDataFrame([(k, t, "b", "x", 1) for k, t in rows], "doc_id long, text string, blob string, path string, start int")


def test_spans_equal_those_of_plain_matching(spark, ledger):
    rows = [*enumerate(TEXTS), (3, "another version token=abcdef"), (3, TEXTS[3]), (None, TEXTS[3])]
    ledger.record(table(spark, rows))
    assert found(ledger) == sorted([(k, plain(t)) for k, t in rows], key=repr)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["token", "Secret", "=", ":", " ", "'", "AKIA", "A9" * 8, "abcdef", "0f" * 6, "x.", "é", "\n"]), max_size=14).map("".join), min_size=30, max_size=30))
def test_any_text(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "blob long, text string").withColumn("todo", F.array(*[F.lit(r.name) for r in RULES]))
    got = sorted((r.blob, r.kind, r.start, r.end) for r in scan(rows, RULES).collect())
    assert got == sorted((k, *span) for k, t in enumerate(texts) for span in plain(t))


def test_only_unseen_pairs_are_scanned(spark, ledger):
    first = ledger.record(table(spark, [(1, "token=abcdef"), (2, "token=abcdef"), (3, "plain")]))
    assert sorted(len(r.todo) for r in first.collect()) == [5, 5]
    again = ledger.record(table(spark, [(9, "token=abcdef"), (1, "new secret=abcdef")]))
    assert again.count() == 1
    newer = (replace(RULES[0], version=2, least=3), *RULES[1:])
    bumped = ledger.record(table(spark, [(1, "token=abcdef"), (4, "token=abc")]), newer)
    assert sorted(sorted(r.todo) for r in bumped.collect()) == sorted([["assign@2"], sorted(r.name for r in newer)])
    assert ledger.record(table(spark, [(5, "plain")])).count() == 0
    paths = found(ledger)
    assert [p for p, spans in paths if spans] == [1, 1, 1, 2, 9]
    assert (4, [("assign", 0, 9)]) in found(ledger, newer)


def test_few_and_many_unseen_blobs_give_the_same(spark, ledger, tmp_path, monkeypatch):
    rows = list(enumerate(TEXTS))
    ledger.record(table(spark, rows))
    monkeypatch.setattr("tillscope.llm.secret_ledger.FEW_BLOBS", 0)
    other = SecretLedger(spark, str(tmp_path / "other"))
    other.record(table(spark, rows))
    assert found(other) == found(ledger)


def test_a_broken_off_batch_counts_for_nothing(spark, ledger, monkeypatch):
    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr("tillscope.llm.secret_ledger.scan", fail)
    with pytest.raises(RuntimeError):
        ledger.record(table(spark, [(1, "token=abcdef")]))
    monkeypatch.undo()
    assert found(ledger) == []
    assert ledger.record(table(spark, [(1, "token=abcdef")])).count() == 1
    assert len(found(ledger)) == 1


def test_empty_table_and_no_python(spark, ledger):
    assert ledger.record(table(spark, [(1, "x")]).limit(0)).count() == 0
    assert found(ledger) == []
    rows = table(spark, [(1, "token=abcdef")]).withColumn("todo", F.array(F.lit("assign@1")))
    plan = scan(rows, BASE_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("regexp_extract_all") <= 2 * len(BASE_RULES)


def test_joined_spans(spark, ledger):
    ledger.record(table(spark, [(1, f"{KEY} token=abcdef")]))
    assert ledger.by_path().select(joined_spans(F.col("spans")).alias("s")).first().s == "access:0:20,assign:21:33"
