"""WARC archives: a writer, and a sequential reader that keeps one record at a time.

The writer puts every record into a gzip member of its own and rolls to a new file after
``file_bytes``. Files get names that no other attempt of a task uses and are listed in a
manifest that Spark commits once, so a lost executor or a doubled task leaves files that
nobody lists. The reader inflates a file in small chunks through zlib, frames each record by
its Content-Length, hashes block and payload on the way and compares them with the digests in
the headers; it never holds a payload, let alone a file.

Of records with equal payloads of at least ``revisit_bytes`` the one with the greatest id is
the response and the others revisit it; which these are comes from one aggregation by digest,
reduced before its shuffle and joined back by digest.

Defined results: a null payload is empty; a null id stays null and is never the target of a
revisit (where all ids of equal payloads are null, all are responses); rows that repeat the
greatest id are all responses; a null url is written as an empty one, control characters and
blanks in it are percent-coded; an empty table gives an archive without records. The reader
raises ``ValueError`` at a truncated member, a wrong length or a wrong digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from effortlens.llm.storage import new_folder, written

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
CHUNK = 64 << 10

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"
_RECORD = (
    "record_id long, record_type string, uri string, refers_to long, "
    "payload_bytes long, payload_digest string"
)


def _base32(hexed: str) -> str:
    return base64.b32encode(bytes.fromhex(hexed)).decode()


def _hex(coded: str) -> str:
    return base64.b32decode(coded).hex()


def record_bytes(record_id, uri, payload: bytes, digest: str, refers_to) -> bytes:
    """One record, not compressed. A revisit has the HTTP head of its response, but no body."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if record_id is None else record_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {quote(uri or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).hexdigest())}",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class _Members:
    """The gzip members of a file, each as an iterator of inflated chunks."""

    def __init__(self, raw: BinaryIO):
        self.raw, self.ahead = raw, b""

    def __iter__(self) -> Iterator[Iterator[bytes]]:
        while True:
            self.ahead = self.ahead or self.raw.read(CHUNK)
            if not self.ahead:
                return
            yield self._inflate()

    def _inflate(self) -> Iterator[bytes]:
        z = zlib.decompressobj(31)
        while not z.eof:
            data = z.unconsumed_tail or self.ahead or self.raw.read(CHUNK)
            if not data:
                raise ValueError("a gzip member is cut short")
            self.ahead = b""
            if chunk := z.decompress(data, CHUNK):
                yield chunk
        self.ahead = z.unused_data


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _head(chunks: Iterator[bytes], have: bytes) -> tuple[bytes, bytes]:
    """Bytes up to the first empty line, and those that were read beyond it."""
    while (cut := have.find(b"\r\n\r\n")) < 0:
        more = next(chunks, None)
        if more is None:
            raise ValueError("a record head has no end")
        have += more
    return have[:cut], have[cut + 4 :]


def _record_number(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _read_record(chunks: Iterator[bytes]) -> tuple:
    head, have = _head(chunks, b"")
    fields = _fields(head)
    length = int(fields["content-length"])
    block, payload = hashlib.sha1(), hashlib.sha1()
    http, seen, body = b"", 0, -1  # body: payload bytes so far, -1 inside the HTTP head
    tail = b""
    while True:
        mine, over = have[: length - seen], have[length - seen :]
        seen += len(mine)
        tail += over
        block.update(mine)
        if body < 0:
            http += mine
            if (cut := http.find(b"\r\n\r\n")) >= 0:
                mine, http, body = http[cut + 4 :], http[:cut], 0
        if body >= 0:
            payload.update(mine)
            body += len(mine)
        have = next(chunks, None)
        if have is None:
            break
    if seen != length or tail != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')}: Content-Length does not fit")
    named = {k: _hex(fields[f"warc-{k}-digest"].partition(":")[2]) for k in ("block", "payload")}
    kind = fields["warc-type"]
    full = int(_fields(http)["content-length"])
    whole = kind == "revisit" or (payload.hexdigest() == named["payload"] and body == full)
    if block.hexdigest() != named["block"] or not whole:
        raise ValueError(f"record {fields.get('warc-record-id')}: digest does not fit")
    return (
        _record_number(fields["warc-record-id"]),
        kind,
        fields["warc-target-uri"],
        _record_number(fields["warc-refers-to"]) if kind == "revisit" else None,
        full,
        named["payload"],
    )


def read_records(raw: BinaryIO) -> Iterator[tuple]:
    """Records of one archive file, in file order; see ``_RECORD`` for the fields."""
    for member in _Members(raw):
        yield _read_record(member)


def revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``digest`` and ``target`` (the greatest id) of payloads that more than one row has."""
    return (
        pages.filter(F.octet_length("payload") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("target"), F.count("*").alias("n"))
        .filter("n > 1 and target is not null")
        .drop("n")
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    record_id: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write all rows below ``folder``; returns the committed manifest (``path``, ``records``)."""
    rows = pages.select(
        F.col(record_id).cast("long").alias("id"),
        F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    targets = written(revisits(rows, revisit_bytes), "revisit-targets")
    same = F.col("id").eqNullSafe(F.col("target"))
    roles = rows.join(targets, "digest", "left").select(
        "id", "uri", "payload", "digest", F.when(~same, F.col("target")).alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open_folder(f"{folder}/data")
        done, out, size = [], None, 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(5)), strict=True):
                i, u, p, d, r = (x.as_py() for x in row)
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                    store.create_dir(base, recursive=True)
                    done.append([f"{uuid.uuid4().hex}.warc.gz", 0])
                    out, size = store.open_output_stream(f"{base}/{done[-1][0]}", compression=None), 0
                member = gzip.compress(record_bytes(i, u, p, d, r), mtime=0)
                out.write(member)
                size += len(member)
                done[-1][1] += 1
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict(
            {"path": pa.array([x for x, _ in done], pa.string()),
             "records": pa.array([n for _, n in done], pa.int64())}
        )

    manifest = roles.mapInArrow(write, "path string, records long")
    manifest.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema("path string, records long").parquet(f"{folder}/manifest")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the files that the manifest lists, each file read by one task."""
    manifest = spark.read.schema("path string, records long").parquet(f"{folder}/manifest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open_folder(f"{folder}/data")
        names = [x.split()[0] for x in _RECORD.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

        def batch(rows):
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        for listed in batches:
            for path in listed.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{path}", compression=None) as raw:
                    rows = []
                    for record in read_records(raw):
                        rows.append(record)
                        if len(rows) == 5000:
                            yield batch(rows)
                            rows = []
                    yield batch(rows)

    # A stated number: without one, adaptive execution merges partitions by the size of the paths.
    files = manifest.select("path").repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(read, _RECORD)


def archive(pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read its records back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_warc(pages, folder, **how)
    return read_warc(pages.sparkSession, folder)
