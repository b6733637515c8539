"""WARC archives: write whole-file gzip streams, normalise them to one member a record with an offset
index, and read records back by that index."""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from caskline.llm.common import filesystem, make_folder, new_folder, open_shared, staged, written_shared

#: Bytes read, inflated or deflated at a time.
PIECE = 1 << 20
#: Most record payload in one archive file, unless one record alone is larger.
ARCHIVE_BYTES = 64 << 20
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = "archive string, offset long, length long, record_key string, record_type string"


def base32_sha1(digest_hex: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 given in hexadecimal: four letters for each five digits."""
    letters = [
        F.substr(F.lit(_BASE32), (F.shiftright(group, shift).bitwiseAND(31) + 1).cast("int"), F.lit(1))
        for k in range(0, 40, 5)
        for group in [F.conv(F.substring(digest_hex, k + 1, 5), 16, 10).cast("int")]
        for shift in (15, 10, 5, 0)
    ]
    return F.concat(*letters)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Decide for every page whether its record is a response or revisits an equal payload.

    Of equal payloads (SHA-1) of ``least_bytes`` or more, the one with the largest id answers; rows
    that repeat its id answer too. Null payloads are empty ones. A null id counts as the smallest.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.length(payload).cast("long").alias("n"),
        F.sha1(payload).alias("sha1"),
    )
    winners = (
        rows.where(F.col("n") >= least_bytes)
        .groupBy("sha1")
        .agg(F.max("id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("sha1", "first")
    )
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")) & (F.col("n") >= least_bytes)
    return rows.join(winners, "sha1", "left").select(
        "id",
        "url",
        base32_sha1(F.col("sha1")).alias("digest"),
        "n",
        F.when(revisit, F.col("first")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _head(kind: str, key: str, url: str | None, length: int, more: list[tuple[str, str]]) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{key}>")]
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    lines = [f"{k}: {v}" for k, v in [*fields, *more, ("Content-Length", str(length))]]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def _one_line(url: str | None) -> str | None:
    return None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")


def _record(key: str, url: str | None, digest: str, n: int, refers_to: str | None, payload: bytes | None) -> Iterator[bytes]:
    more = [
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(n)),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n
    body = b"" if payload is None else payload
    if payload is None:
        more += [
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    yield _head("revisit" if payload is None else "response", key, _one_line(url), len(http) + len(body), more) + http
    yield body
    yield b"\r\n\r\n"


def write_monolithic(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records to archives of one gzip stream each; returns their paths (written on action).

    One archive after another in each task, a record at a time. A row's key is its id, or ``null``.
    """
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = (row for batch in batches for row in zip(*(c for c in batch.columns), strict=True))
        part, row = 0, next(rows, None)
        while row is not None:
            path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{part:05d}.warc.gz"
            size = 0
            with written_shared(path) as out:
                stream = zlib.compressobj(6, zlib.DEFLATED, 31)
                while row is not None and (not size or size < archive_bytes):
                    key, url, digest, n, refers_to, payload = (x.as_py() for x in row)
                    for piece in _record(str(key), url, digest, n, refers_to, payload):
                        out.write(stream.compress(piece))
                        size += len(piece)
                    row = next(rows, None)
                out.write(stream.flush())
            part += 1
            yield pa.RecordBatch.from_pydict({"archive": [path]})

    columns = records.select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("key"),
        "url",
        "digest",
        "n",
        F.col("refers_to").cast("string"),
        "payload",
    )
    return columns.mapInArrow(write, "archive string")


class _Inflated:
    """The text of a gzip file, member after member, as a stream read by lines and by lengths."""

    def __init__(self, source: BinaryIO):
        self.source, self.engine, self.held, self.ended = source, zlib.decompressobj(31), bytearray(), False

    def _more(self) -> bool:
        while not self.ended:
            data = self.engine.unconsumed_tail
            if self.engine.eof:
                data = self.engine.unused_data
                self.engine = zlib.decompressobj(31)
            data = data or self.source.read(PIECE)
            if not data:
                self.ended = True
                break
            text = self.engine.decompress(data, PIECE)
            if text:
                self.held += text
                return True
        return False

    def line(self) -> bytes:
        while (at := self.held.find(b"\n")) < 0 and self._more():
            pass
        at = len(self.held) if at < 0 else at + 1
        out = bytes(self.held[:at])
        del self.held[:at]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise ValueError("the archive ends inside a record")
            out = bytes(self.held[:n])
            del self.held[: len(out)]
            n -= len(out)
            yield out


def _records(stream: _Inflated) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Header fields, header bytes and block length of each record; the caller takes the block."""
    while True:
        line = stream.line()
        while line in (b"\r\n", b"\n"):
            line = stream.line()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts at {line[:40]!r}")
        head, fields = bytearray(line), {}
        while (line := stream.line()) not in (b"\r\n", b"\n", b""):
            head += line
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, bytes(head) + b"\r\n", int(fields["content-length"])


def _key(field: str) -> str:
    return field.removeprefix("<urn:page:").removesuffix(">")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Inflate each archive once and write every record as a gzip member of its own, with an index.

    ``archives`` has one path a row. For each archive an equally named one appears in ``folder``, and
    beside it ``<name>.idx`` with a line of offset, length, key and type for every record. Memory is
    one piece of text, whatever the length of a record or file. Returns the index rows.
    """
    make_folder(folder)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target, rows, at = f"{folder}/{os.path.basename(path)}", [], 0
                source_fs, source = filesystem(path)
                with source_fs.open_input_stream(source, compression=None) as raw, written_shared(target) as out:
                    stream = _Inflated(raw)
                    for fields, head, length in _records(stream):
                        member, begun = zlib.compressobj(6, zlib.DEFLATED, 31), at
                        out.write(member.compress(head))
                        for piece in stream.take(length):
                            out.write(member.compress(piece))
                        out.write(member.compress(b"\r\n\r\n") + member.flush())
                        at = out.tell()
                        rows.append((target, begun, at - begun, _key(fields["warc-record-id"]), fields["warc-type"]))
                with written_shared(f"{target}.idx") as out:
                    out.write("".join(f"{o} {n} {key} {kind}\n" for _, o, n, key, kind in rows).encode())
                for k in range(0, len(rows), 10_000):
                    part = list(zip(*rows[k : k + 10_000], strict=True))
                    yield pa.RecordBatch.from_pydict(dict(zip(("archive", "offset", "length", "record_key", "record_type"), map(list, part), strict=True)))

    return archives.mapInArrow(rewrite, INDEX)


#: Payload bytes that a task holds before it passes records on.
READ_BYTES = 4 << 20


def read_records(index: DataFrame) -> DataFrame:
    """Read records by archive, offset and length, each without inflating another.

    Returns id, url, payload_bytes, payload_digest, record_type, refers_to, payload. For a response
    length and digest are those of the payload read; a payload that belies its header stops the job.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        rows: list[tuple] = []
        held = 0

        def ready() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ.types, strict=True)], schema=_READ)
            rows.clear()
            return out

        for batch in batches:
            for path, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if path != name:
                    if handle:
                        handle.close()
                    name, handle = path, open_shared(path)
                handle.seek(offset)
                raw = zlib.decompress(handle.read(length), 31)
                head, _, rest = raw.partition(b"\r\n\r\n")
                fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
                _, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
                digest, n = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["warc-payload-length"])
                if fields["warc-type"] == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if (found, len(payload)) != (digest, n):
                        raise ValueError(f"record {fields['warc-record-id']} in {path} does not hold the payload it names")
                key, to = _key(fields["warc-record-id"]), fields.get("warc-refers-to")
                rows.append(
                    (
                        None if key == "null" else int(key),
                        fields.get("warc-target-uri"),
                        n,
                        digest,
                        fields["warc-type"],
                        None if to is None else int(_key(to)),
                        payload if fields["warc-type"] == "response" else None,
                    )
                )
                # By bytes, not by records: one large payload, or some small ones, at a time.
                held += len(payload) + 200
                if held >= READ_BYTES:
                    yield ready()
                    held = 0
        if rows:
            yield ready()
        if handle:
            handle.close()

    return index.select("archive", "offset", "length").mapInArrow(
        read,
        "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


_READ = pa.schema(
    [
        ("id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def archive_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, **names) -> DataFrame:
    """Write every page as a WARC record, normalise the archives, and give what reading them returns.

    ``folder`` (default: a new one in the shared folder) gets ``raw/`` with whole-file gzip archives
    and ``records/`` with one member a record and the offset indexes. A null URL leaves its field out.
    Null and empty pages are records without payload; repeated rows are records each; no pages, no archives.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    records = plan_records(pages, least_bytes=least_bytes, **names)
    archives = staged(write_monolithic(records, f"{folder}/raw"), "warc-archives")
    index = staged(normalise(archives.repartition(4 * spark.sparkContext.defaultParallelism), f"{folder}/records"), "warc-index")
    return read_records(index)
