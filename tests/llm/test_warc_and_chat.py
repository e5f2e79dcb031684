import base64
import hashlib
import zlib
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillscope.llm import chat, warc

PAGES = [
    (3, "http://a/\r\nb%", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://c", None), (5, "u", ""), (5, "u", ""),
    (None, "n", "<p>é</p>"), (None, "m", "only without id"), (None, "m", "only without id"), (9, "w", "x" * 100_000),
    (10, "z", "a\r\n\r\nb\r\n\r\n"),
]


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, digest string, sha int")
    return warc.write(pages.repartition(3), str(tmp_path_factory.mktemp("warc") / "out"), file_bytes=400)


def test_records_come_back(spark, archives):
    rows = warc.read(archives).collect()
    firsts = {}
    for page, _, html in PAGES:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    want = []
    for page, url, html in PAGES:
        payload = (html or "").encode()
        first = firsts.get(html or "")
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((page, url, len(payload), digest, "revisit" if revisit else "response", first if revisit else None, None if revisit else payload))
    found = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_selected_ranges_and_standard_files(archives):
    chosen = archives.index.where("url IN ('w', 'z')")
    assert {r.page_id for r in warc.read(archives, chosen, gap=0, most=1).collect()} == {9, 10}
    for path in Path(archives.folder).glob("*.warc.gz"):
        assert zlib.decompressobj(wbits=31).decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")
    assert archives.index.count() == len(PAGES)
    assert archives.index.select("file").distinct().count() > 3


def test_reading_tasks_grow_with_the_bytes(archives):
    size = archives.index.agg(F.sum("length")).first()[0]
    for task_bytes in (size, size // 4, 1):
        tasks = warc.read(archives, task_bytes=task_bytes).rdd.getNumPartitions()
        assert tasks == min(-(-size // task_bytes), len(PAGES))
    few = warc.read(archives, task_bytes=size // 4)
    held = few.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) > 1 and sum(r["count"] for r in held) == len(PAGES)


def test_a_very_long_page(spark, tmp_path):
    html = "é<p>" * 2_000_000
    pages = spark.createDataFrame([(1, "u", html), (2, "u", html), (3, "u", html + ".")], "page_id long, url string, html string")
    rows = {r.page_id: r for r in warc.read(warc.write(pages, str(tmp_path / "long"))).collect()}
    assert bytes(rows[1].payload).decode() == html and rows[2].refers_to == 1 and rows[3].payload_bytes == len(html.encode()) + 1


def test_least_bytes_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in warc.read(warc.write(pages, str(tmp_path / "a"), least_bytes=3)).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.read(warc.write(pages.limit(0), str(tmp_path / "b"))).count() == 0


def test_damage_is_found():
    record = warc.record_bytes(1, "u", b"payload", warc.digest_of(b"payload"), None, False)
    assert warc.parse_record(record)["payload"] == b"payload"
    for bad in (record.replace(b"payload\r", b"pAyload\r"), record[:-1]):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


ANY = st.lists(st.sampled_from(["\\", "<", "|", "turn", "end", ">", "%", "%0A", "[", "INST", "]", "\n", "é"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "x", "\n", ">"]), max_size=8).map("".join), ANY)
def test_escapes_are_reversible_and_leave_no_control(text, role):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(control in hidden for control in chat.CONTROLS)
    formatted, begin, end, _ = chat.format_turn(role, [{"kind": "text", "text": text}])
    assert chat.parse_turn(formatted) == (role, text)
    loss = chat.format_turn("assistant", [{"kind": "text", "text": text}])
    assert chat.unescape(loss[0][loss[1] : loss[2]]) == text and (begin, end) == (0, 0) or role == "assistant"


def test_parts_become_placeholders_in_order():
    parts = [
        {"kind": "text", "text": "see <|image|>"}, {"kind": "image", "ref": "i1", "width": 29, "height": 14},
        {"kind": "audio", "ref": "a1", "seconds": 1.01}, {"kind": "document", "ref": "d1", "pages": 2}, {"kind": "text", "text": None},
    ]
    formatted, _, _, attached = chat.format_turn("user", parts)
    assert "<\\|image|><|image|><|audio|><|document|>\n" in formatted
    assert [(a["kind"], a["ref"], a["tokens"]) for a in attached] == [("image", "i1", 3), ("audio", "a1", 26), ("document", "d1", 2048)]
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"kind": "video", "ref": "v"}])


def test_conversations_read_back(spark):
    turns = [(1, 1, "assistant", "no </s>"), (1, 0, "user", "a\nb"), (1, 2, "assistant", None), (2, 0, None, "x"), (2, 0, "user", "y"),
             (None, None, "assistant", "é" * 3), (3, 5, "user\n%", "z")]
    table = spark.createDataFrame([(*t, "q") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    rows = {r.conv_id: r for r in chat.read_back(chat.format_turns(table.withColumn("parts", chat.text_parts(F.col("text"))))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert rows[1].turns_sha256 == sha("user\na\nb\nassistant\nno </s>\nassistant\n\n")
    assert (rows[1].n_turns, rows[1].loss_chars, rows[1].loss_sha256) == (3, 7, sha("no </s>"))
    assert rows[2].turns_sha256 in (sha("\nx\nuser\ny\n"), sha("user\ny\n\nx\n")) and rows[2].loss_chars == 0
    assert rows[None].loss_sha256 == sha("ééé") and rows[3].turns_sha256 == sha("user\n%\nz\n")
    assert chat.read_back(chat.format_turns(table.limit(0).withColumn("parts", chat.text_parts(F.col("text"))))).count() == 0
