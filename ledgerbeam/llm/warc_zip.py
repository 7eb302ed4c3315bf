"""Web archives packed in ZIP files, read by byte range.

``write`` puts WARC records in archives.  Each archive is a ZIP file whose
members are stored, not deflated: ``archive/data.warc.gz``, one gzip member per
record, and ``indexes/index.cdxj``, a line per record with its offset and
length within the data.  A reader opens the file, finds the end record and, if
there, the ZIP64 end record, walks the central directory, locates both members
and their data, and range-reads the records it wants and their part of the
index.  Nothing is unpacked to disk and no member is read whole.

Records with equal payloads of at least ``least`` bytes: the one with the
largest page_id is the response, the others are revisits that refer to it.
Payload digests are bare upper-case base32 SHA-1.  Rows that share that largest
page_id and the payload are all responses.

Archives are written under another name and then renamed, and only archives in
the manifest that the writing tasks return are read, so tasks that fail or run
twice leave no trace in results.  The folder may be any that pyarrow can open:
local, HDFS, object stores.

Nulls: a null html is an empty payload; null page_ids come before all others
and are kept; a null url is written as an empty target.  Empty tables give
empty results.  Extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: An archive is closed at this many bytes of data or records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 256 << 20, 50_000
#: Records that one reading task takes at most.
READ_RECORDS = 5_000
#: Bytes that one range read covers at most, unless one record is larger.
RANGE = 4 << 20
MAX32, MAX16 = 0xFFFFFFFF, 0xFFFF
DATE = "1970-01-01T00:00:00Z"
RECORD_SCHEMA = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary, archive string, offset bigint, length bigint"


def open_store(uri: str):
    """The file system of uri and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# ZIP ---------------------------------------------------------------------------------------------------------------


class ZipWriter:
    """Stored members one after another; the sizes follow in the central directory, with ZIP64 fields where they need them."""

    def __init__(self, out, force64: bool = False):
        self.out, self.at, self.members, self.force64 = out, 0, [], force64

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        # sizes and checksum come after the data (flag bit 3); version 45 for ZIP64
        self._put(struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0x808, 0, 0, 33, 0, MAX32, MAX32, len(raw), 20) + raw + struct.pack("<2H2Q", 1, 16, 0, 0))

    def data(self, data: bytes) -> None:
        m = self.members[-1]
        m[2], m[3] = zlib.crc32(data, m[2]), m[3] + len(data)
        self._put(data)

    def end(self) -> None:
        _, _, crc, size = self.members[-1]
        self._put(struct.pack("<4sI2Q", b"PK\7\x08", crc, size, size))

    def close(self) -> None:
        start = self.at
        for name, at, crc, size in self.members:
            big = self.force64 or size >= MAX32 or at >= MAX32
            extra = struct.pack("<2H3Q", 1, 24, size, size, at) if big else b""
            sizes = (MAX32, MAX32) if big else (size, size)
            self._put(struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0x808, 0, 0, 33, crc, *sizes, len(name), len(extra), 0, 0, 0, 0, MAX32 if big else at) + name + extra)
        n, length = len(self.members), self.at - start
        if self.force64 or n >= MAX16 or length >= MAX32 or start >= MAX32:
            end = self.at
            self._put(struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, length, start))
            self._put(struct.pack("<4sIQI", b"PK\6\7", 0, end, 1))
            n, length, start = MAX16, MAX32, MAX32
        self._put(struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, n, n, length, start, 0))


def directory(file, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset of the data, length) of the stored members; file has seek and read."""

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return bytes(file.read(n))

    tail_at = max(0, size - 22 - MAX16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\5\6")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP file, or cut off")
    n, length, start = struct.unpack("<H2I", tail[at + 10 : at + 20])
    if MAX16 == n or MAX32 in (length, start):
        where = tail_at + at - 20
        if where >= 0 and (locator := read(where, 20)).startswith(b"PK\6\7"):
            record = read(struct.unpack("<Q", locator[8:16])[0], 56)
            if not record.startswith(b"PK\6\6"):
                raise ValueError("damaged ZIP64 end record")
            n, length, start = struct.unpack("<3Q", record[32:56])
    central, at, out = read(start, length), 0, {}
    for _ in range(n):
        if central[at : at + 4] != b"PK\1\2":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack("<2H", central[at + 8 : at + 12])
        packed, full, name_len, extra_len, comment_len = struct.unpack("<2I3H", central[at + 20 : at + 34])
        local = struct.unpack("<I", central[at + 42 : at + 46])[0]
        name = central[at + 46 : at + 46 + name_len].decode("utf-8" if flags & 0x800 else "cp437")
        extra, k = central[at + 46 + name_len : at + 46 + name_len + extra_len], 0
        while k + 4 <= len(extra):
            kind, count = struct.unpack("<2H", extra[k : k + 4])
            if kind == 1:
                field = k + 4
                for which in ("full", "packed", "local"):
                    if {"full": full, "packed": packed, "local": local}[which] == MAX32:
                        value = struct.unpack("<Q", extra[field : field + 8])[0]
                        field += 8
                        full, packed, local = (value if which == "full" else full), (value if which == "packed" else packed), (value if which == "local" else local)
            k += 4 + count
        at += 46 + name_len + extra_len + comment_len
        if method == 0:
            head = read(local, 30)
            if not head.startswith(b"PK\3\4"):
                raise ValueError("damaged local header")
            out[name] = (local + 30 + sum(struct.unpack("<2H", head[26:30])), packed)
    return out


# WARC --------------------------------------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    return None if not name or (x := re.fullmatch(r"<urn:page:(.*)>", name)[1]) == "null" else int(x)


def to_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, as its own gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or '')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _headers(raw: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in raw.decode("utf-8", "replace").split("\r\n")[1:])}


def from_record(raw: bytes) -> dict:
    """The fields of one gzip member that holds a record."""
    whole = zlib.decompress(raw, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    revisit = warc["warc-type"] == "revisit"
    stated = warc["warc-payload-digest"].removeprefix("sha1:")
    size = int(_headers(http)["content-length"])
    if not revisit and (len(body) != size or digest(body) != stated):
        raise ValueError(f"damaged record {warc['warc-record-id']}")
    return {
        "page_id": page_of(warc["warc-record-id"]), "url": warc["warc-target-uri"], "record_type": warc["warc-type"], "payload_bytes": size,
        "payload_digest": stated, "refers_to": page_of(warc.get("warc-refers-to")), "payload": None if revisit else body,
    }


# Operators -----------------------------------------------------------------------------------------------------------


def write(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write the archives and return their manifest: archive, records, bytes and marks (where in the index each READ_RECORDS records start, and its end)."""
    rows = pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.length("payload"))
    # stored: the join then has plain exchanges on both sides, and Spark splits a payload that very many pages share
    first = cut(rows.groupBy("sha", "size").agg(F.max("page_id").alias("response")))
    rows = rows.join(first, ["sha", "size"])
    revisit = (F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = rows.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("body"), F.when(revisit, F.col("payload")).alias("same"), "response", revisit.alias("revisit"))
    # ids travel as text: pandas would turn numbers with nulls among them to floats
    rows = rows.withColumns({"page_id": F.col("page_id").cast("string"), "response": F.col("response").cast("string")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = open_store(folder)
        store.create_dir(top, recursive=True)
        task, made, state = TaskContext.get(), 0, None

        def begin():
            nonlocal made
            name = f"{top}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}-{uuid.uuid4().hex[:8]}"
            made += 1
            out = store.open_output_stream(f"{name}.open")
            z = ZipWriter(out)
            z.begin(DATA)
            return {"name": name, "out": out, "zip": z, "index": [], "size": 0}

        def finish(s) -> pd.DataFrame:
            z = s["zip"]
            z.end()
            z.begin(INDEX)
            lines = [x.encode() for x in s["index"]]
            z.data(b"".join(lines))
            z.end()
            ends = np.cumsum([0, *map(len, lines)])
            marks = [*ends[:-1:READ_RECORDS].tolist(), int(ends[-1])]
            z.close()
            s["out"].close()
            store.move(f"{s['name']}.open", f"{s['name']}.wacz")
            return pd.DataFrame({"archive": [f"{s['name']}.wacz"], "records": [len(s["index"])], "bytes": [z.at], "marks": [marks]})

        for pdf in batches:
            for page, url, body, same, response, again in zip(pdf["page_id"], pdf["url"], pdf["body"], pdf["same"], pdf["response"], pdf["revisit"], strict=True):
                state = state or begin()
                page = int(page) if isinstance(page, str) else None
                raw = to_record(page, url if isinstance(url, str) else None, bytes(same if again else body), int(response) if isinstance(response, str) else None, bool(again))
                state["index"].append(json.dumps({"page": page, "type": "revisit" if again else "response", "offset": state["size"], "length": len(raw)}) + "\n")
                state["zip"].data(raw)
                state["size"] += len(raw)
                if state["size"] >= ARCHIVE_BYTES or len(state["index"]) >= ARCHIVE_RECORDS:
                    yield finish(state)
                    state = None
        if state:
            yield finish(state)

    return cut(rows.mapInPandas(run, "archive string, records bigint, bytes bigint, marks array<bigint>"))


def index_of(file, size: int, begin: int = 0, end: int | None = None) -> tuple[int, list[dict]]:
    """Where the data member starts, and the entries in bytes begin to end of the index member."""
    members = directory(file, size)
    at, length = members[INDEX]
    file.seek(at + begin)
    return members[DATA][0], [json.loads(x) for x in bytes(file.read((length if end is None else end) - begin)).decode().splitlines()]


def read_range(archive, begin: int, end: int) -> Iterator[dict]:
    """Records of an archive, (store, path), whose entries lie in bytes begin to end of the index."""
    store, path = archive
    with store.open_input_file(path) as file:
        start, entries = index_of(file, file.size(), begin, end)
        at = 0
        while at < len(entries):
            end = at + 1
            while end < len(entries) and entries[end]["offset"] + entries[end]["length"] - entries[at]["offset"] <= RANGE:
                end += 1
            base = entries[at]["offset"]
            file.seek(start + base)
            block = bytes(file.read(entries[end - 1]["offset"] + entries[end - 1]["length"] - base))
            for e in entries[at:end]:
                yield from_record(block[e["offset"] - base : e["offset"] - base + e["length"]]) | {"offset": e["offset"], "length": e["length"]}
            at = end


def read(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record of the manifest's archives; revisits have a null payload."""
    parts = manifest.select("archive", "marks", F.explode(F.sequence(F.lit(1), F.size("marks") - 1)).alias("k"))
    parts = cut(parts.select("archive", F.element_at("marks", F.col("k")).alias("begin"), F.element_at("marks", F.col("k") + 1).alias("end")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_store(folder)
        names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

        def frame(rows: list[dict]) -> pd.DataFrame:
            return pd.DataFrame({c: pd.array([r[c] for r in rows], "Int64") if c in ("page_id", "refers_to") else [r[c] for r in rows] for c in names})

        for pdf in batches:
            for archive, begin, end in zip(pdf["archive"], pdf["begin"], pdf["end"], strict=True):
                rows, held = [], 0
                for r in read_range((store, archive), int(begin), int(end)):
                    if not payloads:
                        r["payload"] = None
                    rows.append(r | {"archive": archive})
                    held += len(r["payload"] or b"") + 200
                    if held >= RANGE:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    # a task for each part: by a stated number, which Spark doesn't lower for such small rows
    return parts.repartition(max(1, parts.count())).mapInPandas(run, RECORD_SCHEMA)
