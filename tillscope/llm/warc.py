"""WARC archives with an index: written first, then read only by byte ranges the index names.

Every record is a gzip member of its own. Each writing task puts its records in files named for the attempt, so a task
that runs again does not touch what another attempt wrote; the index, written through Spark, names the files that count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.stored import stored
from tillscope.llm.words import small_batches
from tillscope.sources.shared import fresh_folder

FILE_BYTES = 64 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
TASK_BYTES = 16 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6f0e2f0c-7d4c-4b6a-9f0e-3f7f5f1f2a10")

INDEX = (
    "file string, offset long, length long, url string, digest string, page_id long, record_type string"
)
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
)


@dataclass(frozen=True)
class Archives:
    """folder: where the files are. index: a row for each record."""

    folder: str
    index: DataFrame


def digest_of(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {digest}')}>"


def _one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response record, or a revisit record, which keeps the payload's length in its HTTP header but not the payload."""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        + (b"" if revisit else payload)
    )
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The parts of a record; raises ValueError where lengths or the digest do not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if lines[0] != "WARC/1.1" or end != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError("payload differs from its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": number("Page-ID"), "record_type": kind, "refers_to": number("Refers-To-Page-ID"), "payload_digest": digest,
        "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "payload_bytes": size, "payload": payload if kind == "response" else None,
    }


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _with_references(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, url, html, refers_to, revisit``. Only ids and digests are grouped and joined; texts move once, by id."""
    html = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    light = html.select("page_id", "sha", F.octet_length("html").alias("size")).where(F.col("size") >= least_bytes)
    firsts = stored(
        light.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL").drop("n")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))
    revisits = light.join(firsts, "sha").where(later).select(
        F.col("page_id").alias("_page_id"), F.col("sha").alias("_sha"), "refers_to", F.lit(True).alias("revisit")
    ).distinct()
    same = html["page_id"].eqNullSafe(revisits["_page_id"]) & (html["sha"] == revisits["_sha"])
    return html.join(revisits, same, "left").select("page_id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))


def write(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> Archives:
    """Archives of ``pages`` (``page_id, url, html``) in a folder that all executors reach, by default a new one.

    Of pages with equal payloads of at least ``least_bytes``, the one with the smallest id is a response and the others
    revisit it. Rows that share that id and payload are all responses. A null id is larger than any other; pages of which
    none has an id are all responses. A null html is an empty payload, a null url leaves its field out. An empty table
    gives no file and an empty index. Other columns are not carried.
    """
    folder = folder or f"{fresh_folder(pages.sparkSession)}-warc"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        task, serial, out, size, rows = TaskContext.get(), 0, None, 0, []

        def done() -> Iterator[pa.RecordBatch]:
            if out is not None:
                out.close()
            if rows:
                columns = zip(*rows)
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[
                    "file", "offset", "length", "url", "digest", "page_id", "record_type"])

        for batch in small_batches(batches, "html"):
            for page in batch.to_pylist():
                if out is None or size >= file_bytes:
                    yield from done()
                    name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{serial:04d}.warc.gz"
                    out, size, rows, serial = system.open_output_stream(f"{root}/{name}", compression=None), 0, [], serial + 1
                payload = page["html"].encode("utf-8", "surrogatepass")
                digest = digest_of(payload)
                member = gzip.compress(
                    record_bytes(page["page_id"], page["url"], payload, digest, page["refers_to"], page["revisit"]), LEVEL, mtime=0
                )
                out.write(member)
                kind = "revisit" if page["revisit"] else "response"
                rows.append((name, size, len(member), page["url"], digest, page["page_id"], kind))
                size += len(member)
        yield from done()

    ready = _with_references(pages.withColumn("page_id", F.col("page_id").cast("long")), least_bytes)
    return Archives(folder, stored(ready.mapInArrow(written, INDEX)))


def read(
    archives: Archives,
    selected: DataFrame | None = None,
    gap: int = GAP_BYTES,
    most: int = READ_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """The records of the index rows ``selected`` (all by default), as ``RECORDS``.

    Rows are sorted by file and offset; ranges up to ``gap`` bytes apart are read at once, ``most`` bytes at a time. There
    is a task for about every ``task_bytes`` of the selected records, however small their index is; the lengths are summed
    while the plan is built.
    """
    folder = archives.folder
    chosen = (archives.index if selected is None else selected).select("file", "offset", "length")
    tasks = max(1, -(-(chosen.agg(F.sum("length")).first()[0] or 0) // task_bytes))
    names = [part.split(" ")[0] for part in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        name, run = None, []
        for batch in batches:
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                near = run and file == name and offset - sum(run[-1]) <= gap and offset + length - run[0][0] <= most
                if run and not near:
                    yield name, run
                    run = []
                name = file
                run.append((offset, length))
        if run:
            yield name, run

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        opened: tuple[str | None, pa.NativeFile | None] = (None, None)
        for name, run in ranges(batches):
            if opened[0] != name:
                if opened[1] is not None:
                    opened[1].close()
                opened = name, system.open_input_file(f"{root}/{name}")
            begin = run[0][0]
            data = opened[1].read_at(sum(run[-1]) - begin, begin)
            found = [parse_record(zlib.decompress(data[a - begin : a - begin + n], wbits=31)) for a, n in run]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in zip(names, types)], names=names)

    ordered = chosen.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(records, RECORDS)
