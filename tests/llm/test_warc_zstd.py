import hashlib

import pytest
import zstandard

from assayloom.llm import warc_zstd as w
from assayloom.llm.common import shared_path

PAGES = [(1, "http://a/ä b", "<p>" + "x" * 2000), (2, None, "<p>" + "x" * 2000), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "u", "<p>" + "x" * 2000), (None, "u", "<p>" + "x" * 2000), (7, "u", "<p>" + "x" * 2000)]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    folder = shared_path(spark, "warc-test")
    w.write_archives(w.with_records(pages), folder, roll_bytes=3000)
    back = w.read_archives(spark, folder).collect()
    kind = lambda i, h: ("revisit", 7) if i in (1, 2) else ("response", None)
    want = sorted((i or -1, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), *kind(i, h)) for i, _, h in PAGES)
    assert sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back) == want
    assert {r["url"] for r in back} == {"http://a/ä b", "urn:none", "u"}
    assert all(bytes(r["payload"]).decode() in {h or "" for _, _, h in PAGES} for r in back if r["record_type"] == "response")


def test_empty(spark):
    folder = shared_path(spark, "warc-empty")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    w.write_archives(w.with_records(pages), folder)
    import os

    os.makedirs(folder, exist_ok=True)
    assert w.read_archives(spark, folder).count() == 0


def records(n=50):
    return [w.record(i, f"u{i}", (f"page {i} " * 40).encode(), hashlib.sha1((f"page {i} " * 40).encode()).hexdigest(), None) for i in range(n)]


def test_frames_and_dictionary():
    data = w.archive_bytes(records())
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert list(w.frames(data)) == records()
    plain = b"".join(zstandard.ZstdCompressor().compress(r) for r in records(3))
    assert list(w.frames(plain)) == records(3)
    n = int.from_bytes(data[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + n])  # the dictionary itself compressed
    assert list(w.frames(data[:4] + len(packed).to_bytes(4, "little") + packed + data[8 + n :])) == records()


@pytest.mark.parametrize("change", [lambda r: r.replace(b"WARC/1.1", b"WARC/9.1"), lambda r: r[:-5], lambda r: r.replace(b"WARC-Date", b"X-Date"), lambda r: r.replace(b"page 1", b"pave 1", 1), lambda r: r.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9")])
def test_broken_records(change):
    with pytest.raises(w.WarcError):
        w.parse(change(records(2)[1]))


def test_cut_archive():
    data = w.archive_bytes(records())
    with pytest.raises(w.WarcError):
        list(w.frames(data[:-3]))
    with pytest.raises(w.WarcError):
        list(w.frames(data[:20]))


def test_cut_skippable_frame():
    import struct

    whole = w.archive_bytes([b"one record"])
    inner = whole + struct.pack("<II", 0x184D2A51, 4) + b"abcd"
    assert list(w.frames(inner)) == [b"one record"]
    with pytest.raises(w.WarcError):
        list(w.frames(inner[:-1]))
