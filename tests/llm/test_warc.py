from __future__ import annotations

import base64
import hashlib

import pytest
import zstandard

from yearpanel.llm import warc
from yearpanel.sources.scratch import scratch_path

PAGES = "page_id long, url string, html string, record_type string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://x.example/{k}", f"<p>page {k % 40} {'text ' * 30}</p>", "z") for k in range(120)]
    rows += [
        (200, None, None, None),
        (201, "http://x.example/a b\r\nX: y", "", None),
        (202, "http://é.example/ü", "ü🙂\r\n\r\n" * 3, None),
        (203, "u", "long " * 300_000, None),
        (5, "http://x.example/5", rows[5][2], "z"),
        (None, "no id", rows[7][2], None),
    ]
    return spark.createDataFrame(rows, PAGES).repartition(3)


def expected(rows):
    payloads = [(r.html or "").encode() for r in rows]
    first = {}
    for r, p in zip(rows, payloads):
        if r.page_id is not None:
            first[p] = min(first.get(p, r.page_id), r.page_id)
    out = []
    for r, p in zip(rows, payloads):
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        own = first.get(p, r.page_id) == r.page_id
        out.append(
            (r.page_id, len(p), digest, "response" if own else "revisit", None if own else first[p])
        )
    return sorted(out, key=str)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_pages_come_back(spark, pages):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_archives(warc.planned(pages), folder, archive_bytes=4000)
    assert manifest.agg({"records": "sum"}).first()[0] == pages.count()
    found = warc.read_archives(spark, folder)
    assert sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str) == expected(pages.collect())
    texts = {r.page_id: r.html or "" for r in pages.collect()}
    urls = {r.page_id: r.url for r in pages.collect()}
    for r in found.collect():
        assert (r.url or None) == urls[r.page_id]
        assert r.payload is None if r.record_type == "revisit" else r.payload.decode() == texts[r.page_id]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    assert warc.read_files(files).count() == pages.count()


def test_no_pages(spark):
    folder = scratch_path(spark, "warc")
    warc.write_archives(warc.planned(spark.createDataFrame([], PAGES)), folder)
    assert warc.read_archives(spark, folder).count() == 0


def test_small_payloads_may_be_left_alone(spark, pages):
    plan = warc.planned(pages, min_bytes=10**6).collect()
    assert all(r.refers_to is None for r in plan)


def made(n):
    digest = hashlib.sha1(b"p" * 50).hexdigest()
    return [warc.record(k, f"http://x/{k}", b"p" * 50, digest, None, None) for k in range(n)]


def test_the_dictionary_stands_first_and_frames_are_found():
    bodies = [f"<html>{k} and some shared text of pages {k * 7}</html>".encode() * 3 for k in range(500)]
    records = [
        warc.record(k, "u", b, hashlib.sha1(b).hexdigest(), None, None) for k, b in enumerate(bodies)
    ]
    ((content, n),) = warc.archive(iter(records))
    assert n == 500 and int.from_bytes(content[:4], "little") == warc.DICTIONARY_MAGIC
    assert list(warc.frames(content)) == records
    assert [warc.parsed(f)[6] for f in warc.frames(content)] == bodies
    size = int.from_bytes(content[4:8], "little")
    packed = zstandard.ZstdCompressor().compress(content[8 : 8 + size])
    again = content[:4] + len(packed).to_bytes(4, "little") + packed + content[8 + size :]
    assert list(warc.frames(again)) == records  # a compressed dictionary


def test_few_records_need_no_dictionary():
    ((content, n),) = warc.archive(iter(made(2)))
    assert n == 2 and content[:4] == warc.FRAME_MAGIC and list(warc.frames(content)) == made(2)
    assert list(warc.archive(iter([]))) == []


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"WARC/9.9"),
        (b"WARC-Type: response", b"WARC-Type: revisit"),
        (b"WARC-Date", b"WARC Date"),
        (b"WARC-Date", b"WARC-Other"),
        (b"Content-Length: 50", b"Content-Length: 51"),
        (b"ppp\r\n\r\n", b"ppp\r\n"),
        (b"pppp", b"qppp"),
        (b"<urn:page:0>", b"<urn:other>"),
    ],
)
def test_broken_records_are_found(old, new):
    (good,) = made(1)
    warc.parsed(good)
    with pytest.raises(warc.InvalidArchive):
        warc.parsed(good.replace(old, new, 1))


def test_broken_archives_are_found():
    ((content, _),) = warc.archive(iter(made(3)))
    for bad in (content[:-3], content[:7], b"x" + content, content + warc.DICTIONARY_MAGIC.to_bytes(4, "little") + bytes(4)):
        with pytest.raises(warc.InvalidArchive):
            list(warc.frames(bad))
