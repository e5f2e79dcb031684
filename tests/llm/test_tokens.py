import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillscope.llm import packing, token_files
from tillscope.llm.tokens import TextEncoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ENCODERS = {f: TextEncoder(public_tokenizers.path(f)) for f in FILES}
PLAIN = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}
TEXTS = [
    "Plain words, with a few marks. It's fine!", "two  blanks", " ends ", "a\nb\n\nc", "tab\there", "ÉTÉ ΑΣ ΣΑΣ ﬁ É İ",
    "x<|endoftext|>y <|startoftext|> z", "\x1c sep \x1f", " no break em", "123 4,5;6", "don't can't 's", "\U0001d11e!? …", "a" * 5000,
]


@pytest.mark.parametrize("file", FILES)
def test_equals_the_library(file):
    for text in TEXTS * 2:
        assert list(ENCODERS[file].ids(text)) == PLAIN[file].encode(text, add_special_tokens=False).ids, text
    assert len(ENCODERS[file].ids(None)) == len(ENCODERS[file].ids("")) == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZé.,!?' \n\tΣ́<|>1中\x1d"), max_size=30), st.sampled_from(FILES))
def test_equals_the_library_on_any_text(text, file):
    assert list(ENCODERS[file].ids(text)) == PLAIN[file].encode(text, add_special_tokens=False).ids


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr("tillscope.llm.tokens.CACHE_CHUNKS", 3)
    small = TextEncoder(public_tokenizers.path(FILES[0]))
    for text in TEXTS:
        assert (small.ids(text) == ENCODERS[FILES[0]].ids(text)).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=40), st.integers(1, 12))
def test_differencing_parts_everything_evenly(sizes, ways):
    parts = packing.partition_evenly(sizes, ways)
    assert len(parts) == ways and sorted(i for p in parts for i in p) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) <= max(sizes, default=0)
    packed = packing.pack_block(sizes, 100)
    assert sorted(i for p in packed for i in p) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in p) <= 100 for p in packed)


def test_packing_places_every_id_once(documents):
    random.seed(4)
    texts = [None, "", "one", "one", *(" ".join(random.choice(["le", "chat", "noir"]) for _ in range(n)) for n in (5, 63, 64, 200, 700))]
    docs = documents(*texts, ids=[7, 7, 1, 1, 2, 3, 4, 5, None])
    rows = packing.pack(docs, public_tokenizers.path(FILES[1]), capacity=64, block=4).collect()
    want = sorted(tuple([*PLAIN[FILES[1]].encode(t or "", add_special_tokens=False).ids, 1]) for t in texts)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
        if r.doc_tokens > 64:
            pieces[r.doc_id].append((r.start, r.ids))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    found = [tuple(np.frombuffer(r.ids, "<u4")) for r in rows if r.doc_tokens <= 64]
    found += [tuple(np.frombuffer(b"".join(i for _, i in sorted(p)), "<u4")) for p in pieces.values()]
    assert sorted(found) == want
    assert packing.pack(docs.limit(0), public_tokenizers.path(FILES[1])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=200), st.integers(2, 5))
def test_grammar_round_trip(ids, least):
    cut = len(ids) // 3
    shard = token_files.compress(np.array(ids, np.uint32), np.array([0, cut, len(ids)]), least=least)
    shard = token_files.Shard.from_bytes(shard.to_bytes())
    assert shard.ids().tolist() == ids
    left, at = shard.symbols.tolist(), 0
    counts = {}
    while at < len(left) - 1:  # occurrences that do not overlap in a run
        pair = (left[at], left[at + 1])
        counts[pair] = counts.get(pair, 0) + 1
        at += 2 if pair[0] == pair[1] else 1
    assert all(n < least for n in counts.values())  # nothing frequent is left
    assert shard.document(0).tolist() == ids[:cut] and shard.document(1).tolist() == ids[cut:]


def test_grammar_shortens_repeats():
    shard = token_files.compress(np.array([1, 2, 3, 4] * 500, np.uint32), np.array([0, 2000]))
    assert len(shard.symbols) < 20 and shard.lengths.max() >= 256
    run = token_files.compress(np.zeros(65536, np.uint32), np.array([0, 65536]))
    assert len(run.symbols) < 8 and len(run.rules) < 16 and run.ids().tolist() == [0] * 65536
    assert (shard.sizes(shard.symbols).sum()) == 2000
    with pytest.raises(ValueError):
        token_files.Shard.from_bytes(b"x" * 40)


def test_files_round_trip_in_order(documents, spark):
    texts = [f"text number {k} " * (k % 7) for k in range(40)] + [None, "same", "same", "other"]
    ids = [(k * 17) % 40 for k in range(40)] + [None, 99, 99, 99]
    folder = token_files.write(documents(*texts, ids=ids), public_tokenizers.path(FILES[0]), shard_ids=50)
    rows = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, *range(40), 99, 99, 99]
    want = sorted((i if i is not None else -1, [*PLAIN[FILES[0]].encode(t or "", add_special_tokens=False).ids, 0]) for i, t in zip(ids, texts))
    found = sorted((r.doc_id if r.doc_id is not None else -1, np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert found == want
    at = 0
    for r in rows:
        assert r.start == at and 4 * r.n_tokens == len(r.ids)
        at += r.n_tokens
    assert spark.read.parquet(folder).count() > 3
    empty = token_files.write(documents("a").limit(0), public_tokenizers.path(FILES[0]))
    assert token_files.read(spark, empty).count() == 0


@pytest.mark.parametrize("file", FILES)
def test_a_chunk_in_use_is_made_once(file, monkeypatch):
    monkeypatch.setattr("tillscope.llm.tokens.CACHE_CHUNKS", 8)
    small, made = TextEncoder(public_tokenizers.path(file)), []
    make = small.known.make
    small.known.make = lambda chunk: made.append(chunk) or make(chunk)
    for k in range(20):
        text = f"and the{' the' * k} word{'x' * k}, one 12"
        assert list(small.ids(text)) == PLAIN[file].encode(text, add_special_tokens=False).ids
    assert len(made) == len(set(made)) == 24
