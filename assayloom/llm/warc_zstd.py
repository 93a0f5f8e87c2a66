"""WARC archives in Zstandard form: one frame per record, the dictionary in a leading skippable frame.

`write_archives` writes `.warc.zst` files from the tasks into a shared folder; a file belongs to one partition and has a
fixed name, so a task that runs again replaces what a lost one left. `read_archives` loads the dictionary of each file,
decodes frame by frame and checks headers and lengths.

Defined results: a null payload is empty, a null url is written as urn:none, a null page_id as the record id urn:page:none
(such a row is always a response), repeated rows are records of their own, an empty table gives an empty folder.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = 0x184D2A5D
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class WarcError(ValueError):
    """An archive that breaks the format."""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit has the response's HTTP head, its Content-Length that of the full payload, and no payload."""
    block = HTTP + str(len(payload)).encode() + b"\r\n\r\n" + (payload if refers_to is None else b"")
    name = lambda x: f"<urn:page:{'none' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {urllib.parse.quote(url or 'urn:none', safe=SAFE)}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Characters of a URI that stay as they are.
SAFE = "%/:?#[]@!$&'()*+,;=-._~"


def dictionary(records: list[bytes], size: int) -> bytes:
    """A dictionary trained on these records; with too few of them, their first bytes as raw content."""
    try:
        return zstandard.train_dictionary(size, records, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:size]


def archive_bytes(records: list[bytes], size: int = 32_768, sample: int = 400) -> bytes:
    """A whole archive. The dictionary is fitted on `sample` records spread over the archive: it changes the size only."""
    if not records:
        return b""
    trained = dictionary(records[:: max(1, len(records) // sample)], size)
    made = zstandard.ZstdCompressionDict(trained)
    press = zstandard.ZstdCompressor(level=3, dict_data=made, write_checksum=True)
    return b"".join([struct.pack("<II", MAGIC, len(trained)), trained, *map(press.compress, records)])


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, with the dictionary of its leading skippable frame if it has one."""
    view, at, known = memoryview(data), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == MAGIC:
        n = struct.unpack_from("<I", data, 4)[0]
        if 8 + n > len(data):
            raise WarcError("the dictionary frame is cut off")
        raw = bytes(view[8 : 8 + n])
        if raw[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
        known, at = zstandard.ZstdCompressionDict(raw), 8 + n
    opener = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0] if at + 8 <= len(data) else 0
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            if at > len(data):
                raise WarcError("a skippable frame is cut off")
            continue
        one, parts = opener.decompressobj(), []
        try:
            while not one.eof and at < len(data):
                step = view[at : at + 16_384]
                parts.append(one.decompress(step))
                at += len(step) - len(one.unused_data)
        except zstandard.ZstdError as e:
            raise WarcError(f"a frame can't be decoded: {e}") from e
        if not one.eof:
            raise WarcError("the last frame is cut off")
        yield b"".join(parts)


def parse(data: bytes) -> dict:
    """A record's fields; WarcError where version, named fields, lengths or the digest don't hold."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError("no WARC version line")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"not a named field: {line[:80]!r}")
        fields[key.strip().lower().decode()] = value.strip().decode()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing or not fields["content-length"].isdigit():
        raise WarcError(f"fields missing or wrong: {sorted(missing) or 'content-length'}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length is {n}; the block has {len(rest) - 4} bytes")
    http, mark, payload = rest[:n].partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not mark or not length:
        raise WarcError("no HTTP head with a length")
    kind, digest = fields["warc-type"], base64.b32decode(fields.get("warc-payload-digest", "sha1:").removeprefix("sha1:")).hex()
    page = lambda x: None if (v := re.fullmatch(r"<urn:page:(-?\d+|none)>", x)) is None or v[1] == "none" else int(v[1])
    if kind == "response":
        if len(payload) != int(length[1]) or hashlib.sha1(payload).hexdigest() != digest:
            raise WarcError("the payload's length or digest differs from its head")
    elif kind != "revisit" or payload or page(fields.get("warc-refers-to", "")) is None:
        raise WarcError(f"not a record this reader takes: {kind}")
    return {
        "page_id": page(fields["warc-record-id"]), "url": urllib.parse.unquote(fields.get("warc-target-uri", "")), "payload_bytes": int(length[1]), "payload_digest": digest,
        "record_type": kind, "refers_to": page(fields.get("warc-refers-to", "")), "payload": payload if kind == "response" else None,
    }


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload of at least `least` bytes a page with a larger id also has.

    Works on ids and digests only; payloads that occur once end at the first aggregation, and a payload that a third of
    all pages share is one row after the map-side part of it.
    """
    seen = pages.filter(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least)).select("page_id", "digest")
    last = seen.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first")).filter("first < last").select("digest", "last")
    return seen.join(last, "digest").filter("page_id < last").select("page_id", "digest", F.col("last").alias("refers_to")).distinct()


def with_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(page_id, url, html) -> page_id, url, payload, digest, refers_to (null: a response)."""
    shaped = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    return shaped.join(revisits(shaped, least), ["page_id", "digest"], "left")


def write_archives(rows: DataFrame, folder: str, roll_bytes: int = 32 << 20) -> None:
    """Write `with_records` rows to `folder`, an archive for each `roll_bytes` of records of a partition."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        where.create_dir(root, recursive=True)

        def flush() -> int:
            name = f"{root}/part-{part:05d}-{number:05d}.warc.zst"
            own = f"{root}/_{part:05d}-{number:05d}-{TaskContext.get().taskAttemptId()}"
            with where.open_output_stream(own) as f:
                f.write(archive_bytes(held))
            where.move(own, name)
            return len(held)

        total = 0
        for b in batches:
            for page, url, payload, digest, refers in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                held.append(record(page, url, payload, digest, refers))
                size += len(held[-1])
                if size >= roll_bytes:
                    total += flush()
                    number, held, size = number + 1, [], 0
        if held:
            total += flush()
        yield pa.RecordBatch.from_pydict({"records": pa.array([total], pa.int64())})

    ordered = rows.select("page_id", "url", "payload", "digest", "refers_to").sortWithinPartitions("page_id", "digest")
    ordered.mapInArrow(put, "records long").write.format("noop").mode("overwrite").save()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """READ_SCHEMA rows of all archives in `folder`; WarcError where one breaks the format."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            for data in b.column("content"):
                rows = []
                for frame in frames(data.as_py()):
                    rows.append(parse(frame))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=types)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=types)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return files.select("content").mapInArrow(get, READ_SCHEMA)
