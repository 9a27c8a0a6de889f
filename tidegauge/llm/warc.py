"""WARC archives: an index first, then coalesced reads of byte ranges.

``write_archives`` writes one record per page in files of the shared folder, each record a gzip member of its own, and
returns the index: file, offset, length, URL and digest per record.  ``read_records`` sorts selected index rows by file and
offset, joins ranges that lie close together and reads each run at once.  Payloads that an earlier page already has
become ``revisit`` records, which hold headers only.

A task writes to a file named after its attempt, and the index names only files of attempts that Spark committed, so
lost executors and repeated attempts leave nothing but files that no index row names.

Defined results: null html is an empty payload; a null url gives a record without a target; null ids are never referred to,
and records with a null id and rows that repeat the referred page's id are responses; an empty table gives an empty index
and result.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import scratch_folder, staged

INDEX = "record_id string, page_id bigint, url string, payload_digest string, record_type string, archive string, offset bigint, length bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def _storage(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + folder
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))


def _header(text: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", text or "")


def record_bytes(record_id: str, page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the response's headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(4, f"WARC-Target-URI: {_header(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers and HTTP headers by lower-case name, and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = lambda lines: {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    warc = named(head.decode().split("\r\n")[1:])
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, named(http.decode().split("\r\n")[1:]), payload


def _writer(folder: str, max_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, root = _storage(folder)
        out = name = None
        offset = 0
        try:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    if out is None or offset >= max_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = storage.open_output_stream(f"{root}/{name}", compression=None)
                    record_id = str(uuid.uuid4())
                    raw = record_bytes(record_id, r["page_id"], r["url"], r["payload"], r["payload_digest"], r["refers_to"])
                    packed = gzip.compress(raw, compresslevel=1, mtime=0)
                    out.write(packed)
                    kind = "response" if r["refers_to"] is None else "revisit"
                    rows.append((record_id, r["page_id"], r["url"], r["payload_digest"], kind, name, offset, len(packed)))
                    offset += len(packed)
                columns = list(zip(*rows)) or [[]] * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()])],
                    names=["record_id", "page_id", "url", "payload_digest", "record_type", "archive", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    return write


def write_archives(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = 100, max_bytes: int = 1 << 30
) -> tuple[DataFrame, str]:
    """Writes all pages; the index and the archives' folder.

    Of equal payloads of ``revisit_bytes`` or more, the one with the smallest id is the response.  The digests that occur
    more than once are found before writing, from digests alone.
    """
    folder = scratch_folder(pages.sparkSession, "warc")
    storage, root = _storage(folder)
    storage.create_dir(root, recursive=True)
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.octet_length("payload") >= revisit_bytes)
        .groupBy(F.col("payload_digest").alias("first_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    first = staged(first, "warc-first")
    rows = rows.join(first, F.col("payload_digest") == F.col("first_digest"), "left")
    rows = rows.withColumn("refers_to", F.when(F.col("page_id") != F.col("first_id"), F.col("first_id"))).drop("first_digest", "first_id")
    return staged(rows.mapInArrow(_writer(folder, max_bytes), INDEX), "warc-index"), folder


def _reader(folder: str, gap: int, run_bytes: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, root = _storage(folder)
        for batch in batches:
            wanted = batch.to_pydict()
            found = list(zip(wanted["archive"], wanted["offset"], wanted["length"], wanted["url"]))
            i = 0
            while i < len(found):
                archive, start, length, _ = found[i]
                j, stop = i + 1, start + length
                while j < len(found) and found[j][0] == archive and found[j][1] <= stop + gap and stop - start < run_bytes:
                    stop, j = max(stop, found[j][1] + found[j][2]), j + 1
                with storage.open_input_file(f"{root}/{archive}") as file:
                    data = file.read_at(stop - start, start)
                rows = []
                for _, offset, size, url in found[i:j]:
                    warc, http, payload = parsed_record(gzip.decompress(data[offset - start : offset - start + size]))
                    refers = warc.get("x-refers-to-page-id")
                    page = warc.get("x-page-id")
                    digest = hashlib.sha256(payload).hexdigest() if refers is None else warc["warc-payload-digest"].removeprefix("sha256:")
                    if refers is None and f"sha256:{digest}" != warc["warc-payload-digest"]:
                        raise ValueError(f"{archive}, offset {offset}: the payload does not match its digest")
                    rows.append(
                        (
                            None if page is None else int(page), url, warc["warc-type"], None if refers is None else int(refers),
                            digest, int(http["content-length"]), None if refers is not None else payload,
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, t)
                        for c, t in zip(zip(*rows), [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()])
                    ],
                    names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"],
                )
                i = j

    return read


def read_records(index: DataFrame, folder: str, *, gap: int = 64 << 10, run_bytes: int = 4 << 20, task_bytes: int = 32 << 20) -> DataFrame:
    """The records of the (selected) index rows, read by runs of ranges at most ``gap`` apart and about ``run_bytes`` long.

    Returns RECORD; a revisit's payload is null, its digest and size are those of the payload it refers to.
    """
    ranges = index.select("archive", "offset", "length", "url")
    # Index rows are small and what they name is not, so the bytes to read decide the number of tasks.
    total = index.agg(F.sum("length")).first()[0] or 0
    ranges = ranges.repartitionByRange(total // task_bytes + 1, "archive", "offset").sortWithinPartitions("archive", "offset")
    return ranges.mapInArrow(_reader(folder, gap, run_bytes), RECORD)
