"""WARC records in ZIP packages: a writer with payload deduplication and a range reader.

A package is a ZIP file whose members are stored without compression: archive
members, each a run of gzip members of one record, and an index member with
one line for each record.  The reader finds members through the central
directory, with its 64-bit extension where there is one, and reads single
records by their range.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from uuid import UUID

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import open_folder, put_file, slices, text_of
from sluice.session import scratch_path, stage

#: payloads of fewer bytes are never replaced by revisits
MIN_BYTES = 0
#: bytes after which a writer begins its next package; of an archive member
PACKAGE_BYTES, MEMBER_BYTES = 1 << 26, 1 << 24
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: fixed values of the ZIP format
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
ALL32, ALL16 = 0xFFFFFFFF, 0xFFFF
#: date of all records: archives of the same pages are the same bytes
DATE = "2024-01-01T00:00:00Z"


def record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{UUID(bytes=hashlib.md5(f'{page}|{digest}'.encode()).digest())}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, gone: bool) -> bytes:
    """A response record, or a revisit record of page ``first`` if ``gone``.

    The HTTP header of a revisit tells the length of the payload it leaves out.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if gone else 'response'}",
        f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        # percent-escaped, so that no character of it can end the line
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    if gone:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Page: {first}"]
    block = http if gone else http + payload
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record; field names in lower case."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")

    def fields(text: bytes) -> dict[str, str]:
        pairs = (line.split(":", 1) for line in text.decode().split("\r\n")[1:] if ":" in line)
        return {k.strip().lower(): v.strip() for k, v in pairs}

    warc = fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, fields(http), payload


class Package:
    """Members of a ZIP file found through its directories, read by range."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        tail_at = max(0, size - 22 - ALL16)
        tail = file.read_at(size - tail_at, tail_at)
        end = tail.rfind(END)
        if end < 0:
            raise ValueError("no ZIP file")
        entries, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
        if ALL32 in (length, start) or entries == ALL16:
            locator = file.read_at(20, tail_at + end - 20)
            if locator[:4] == LOCATOR:
                at = struct.unpack("<Q", locator[8:16])[0]
                end64 = file.read_at(56, at)
                if end64[:4] != END64:
                    raise ValueError("no 64-bit directory where its locator says")
                entries, length, start = struct.unpack("<QQQ", end64[32:56])
        self.members: dict[str, tuple[int, int]] = {}
        directory = file.read_at(length, start)
        at = 0
        for _ in range(entries):
            if directory[at : at + 4] != ENTRY:
                raise ValueError("damaged ZIP directory")
            method, = struct.unpack_from("<H", directory, at + 10)
            packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
            place, = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46 : at + 46 + n_name].decode()
            extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
            packed, place = self._wide(extra, plain, packed, place)
            if method != 0:
                raise ValueError(f"member {name} is not stored")
            self.members[name] = (place, packed)
            at += 46 + n_name + n_extra + n_comment

    @staticmethod
    def _wide(extra: bytes, plain: int, packed: int, place: int) -> tuple[int, int]:
        """Sizes and places too large for 32 bits are in the extra field, in this order."""
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
                if plain == ALL32:
                    next(wide)
                packed = next(wide) if packed == ALL32 else packed
                place = next(wide) if place == ALL32 else place
            at += 4 + n
        return packed, place

    def data_start(self, name: str) -> int:
        place, _ = self.members[name]
        head = self.file.read_at(30, place)
        if head[:4] != LOCAL:
            raise ValueError("no member where the directory says")
        n_name, n_extra = struct.unpack("<HH", head[26:30])
        return place + 30 + n_name + n_extra

    def read(self, name: str, first: int = 0, size: int | None = None) -> bytes:
        """Bytes of a member, from ``first`` on."""
        length = self.members[name][1]
        size = length - first if size is None else min(size, length - first)
        return self.file.read_at(size, self.data_start(name) + first)


def package(archives: dict[str, bytes], index: list[dict]) -> bytes:
    """The bytes of a package; dates are fixed so that they depend on the records only."""
    import io

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        lines = "".join(json.dumps(x) + "\n" for x in index).encode()
        for name, data in [*archives.items(), ("indexes/index.jsonl", lines)]:
            z.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), data)
    return out.getvalue()


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decisions(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, sha, first): for pages whose payload a page with a smaller id has.

    Equal payloads meet as one row per task and digest, so a payload that a
    third of all pages have is no hot group.  Null ids are after all others.
    """
    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.sha1(F.encode(text_of("html"), "UTF-8")).alias("sha"),
        F.octet_length(text_of("html")).alias("size"),
    )
    slim = stage(slim, "digests")
    firsts = (
        slim.where(F.col("size") >= min_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
    )
    return firsts.select("sha", "first")


def write_packages(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write a record per row into packages below ``folder``; returns the table of packages."""
    spark = pages.sparkSession
    firsts = stage(decisions(pages, min_bytes), "first-pages")
    html = text_of("html")
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha1(F.encode(html, "UTF-8")).alias("sha"),
    ).join(firsts, "sha", "left")
    first_seen = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    full = full.withColumn("gone", ~first_seen).select("page_id", "url", "html", "first", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        archives: dict[str, list[bytes]] = {}
        index: list[dict] = []
        size = at = 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/packages/{part:06d}-{number:06d}.wacz"
            put_file(path, [package({k: b"".join(v) for k, v in archives.items()}, index)])
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(index)], pa.int64())], ["path", "n"])

        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                payload = row["html"].encode()
                digest = digest_of(payload)
                data = record(row["page_id"], row["url"], payload, digest, row["first"], row["gone"])
                press = zlib.compressobj(4, zlib.DEFLATED, 31)
                data = press.compress(data) + press.flush()
                if not archives or at >= MEMBER_BYTES:
                    archives[f"archive/{len(archives):04d}.warc.gz"] = []
                    at = 0
                name = next(reversed(archives))
                archives[name].append(data)
                index.append({"page_id": row["page_id"], "url": row["url"], "digest": digest, "filename": name, "offset": at, "length": len(data)})
                at += len(data)
                size += len(data)
                if size >= PACKAGE_BYTES:
                    yield close()
                    archives, index, size, at, number = {}, [], 0, 0, number + 1
        if index:
            yield close()

    table = full.mapInArrow(run, "path string, n long")
    table.write.parquet(f"{folder}/table")
    return spark.read.parquet(f"{folder}/table")


def read_packages(table: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the packages, each read by its range.

    Columns: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, if asked for, payload (null for revisits).
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, place = open_folder(path)
                with fs.open_input_file(place) as file:
                    found = Package(file)
                    starts = {n: found.data_start(n) for n in found.members}
                    lines = found.read("indexes/index.jsonl").decode().split("\n")[:-1]
                    for a in range(0, len(lines), 1000):
                        rows = [row(file, starts, json.loads(x)) for x in lines[a : a + 1000]]
                        columns = zip(*rows)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)][: len(names)], names)

    def row(file: pa.NativeFile, starts: dict[str, int], entry: dict) -> tuple:
        data = file.read_at(entry["length"], starts[entry["filename"]] + entry["offset"])
        warc, http, payload = parse(zlib.decompress(data, 31))
        gone = warc["warc-type"] == "revisit"
        if gone:
            size, digest = int(http["content-length"]), warc["warc-payload-digest"].split(":", 1)[1]
        else:
            size, digest = len(payload), digest_of(payload)
        if digest != entry["digest"]:
            raise ValueError(f"digest of page {entry['page_id']} is not that of the index")
        page, first = warc.get("x-page-id"), warc.get("x-refers-to-page")
        return (
            None if page is None else int(page), entry["url"], size, digest, warc["warc-type"],
            int(first) if gone else None, None if gone else payload,
        )

    # a set number of tasks: by the size of their paths, all archives would be read in one
    tasks = max(1, table.sparkSession.sparkContext.defaultParallelism * 4)
    return table.select("path").repartition(tasks, "path").mapInArrow(run, schema + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write all rows and read them back.

    A null html is an empty payload.  Of rows with one page_id and equal
    payloads each is a response; a row without page_id is never one that
    others refer to, and is a revisit if another has its payload.
    """
    folder = scratch_path(pages.sparkSession, "packages")
    return read_packages(write_packages(pages, folder, min_bytes))
