"""WARC archives in Zstandard: a dictionary in a leading skippable frame, one frame per record.

The writer trains a dictionary for each archive on its first records, puts it in front in a
skippable frame and compresses every record by itself with it. The reader loads the dictionary
from that frame, finds the end of each frame from its block headers, decodes one record per frame
and checks headers, lengths and digests. Archives have a bounded size. Their names are kept in a
manifest that Spark commits, so that what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
DATE = "2000-01-01T00:00:00Z"

#: An archive is closed beyond this many compressed bytes.
ARCHIVE_BYTES = 16 << 20
#: Bound of the records that a dictionary is trained on, and its size.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 2 << 20, 16 << 10

MANIFEST = "archive string, records long, bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


class InvalidArchive(ValueError):
    """An archive that breaks the format."""


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pyarrow.fs.FileSystem.from_uri(uri)


def planned(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, sha1 (hex), refers_to, refers_url: what is to be written.

    Of pages with an equal payload of at least ``min_bytes`` bytes the one with the smallest
    page_id is a response, and the others refer to it. Whole rows that repeat share their page_id,
    so all of them are responses. Only payloads that occur more than once take part in the join.
    """
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    large = F.octet_length("payload") >= min_bytes
    firsts = (
        page.filter(large & F.col("page_id").isNotNull())
        .groupBy("sha1")
        .agg(
            F.min("page_id").alias("first_id"),
            F.max("page_id").alias("last_id"),
            F.min(F.struct("page_id", "url"))["url"].alias("first_url"),
        )
    )
    anonymous = page.filter(large & F.col("page_id").isNull()).select("sha1").distinct()
    repeated = firsts.join(anonymous.withColumn("more", F.lit(True)), "sha1", "left").filter(
        (F.col("first_id") < F.col("last_id")) | F.col("more")
    )
    revisit = large & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return page.join(repeated, "sha1", "left").select(
        "page_id",
        "url",
        "payload",
        "sha1",
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        F.when(revisit, F.col("first_url")).alias("refers_url"),
    )


def _uri(url: str | None, page_id: int | None) -> str:
    return quote(url, safe=":/?#[]@!$&'()*+,;=~%") if url else f"{ID_PREFIX}{_id(page_id)}"


def _id(page_id: int | None) -> str:
    return "none" if page_id is None else str(page_id)


def record(page_id, url, payload: bytes, sha1: str, refers_to, refers_url) -> bytes:
    """One WARC record. A revisit holds the HTTP header of its page without the payload."""
    revisit = refers_to is not None
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID_PREFIX}{_id(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: <{ID_PREFIX}{_id(refers_to)}>",
            f"WARC-Refers-To-Target-URI: {_uri(refers_url, refers_to)}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained(samples: list[bytes], most: int) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of an eighth of an archive at most, or none where the samples or that are too
    little for one."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, most // 8), samples, k=256, d=8)
    except (zstandard.ZstdError, ValueError):
        return None


def archive(records: Iterator[bytes], most: int = ARCHIVE_BYTES) -> Iterator[tuple[bytes, int]]:
    """Archives and their numbers of records. An archive ends with the record that fills it.

    Archives that a sample fills by itself share its dictionary.
    """
    records = iter(records)
    while held := _sample(records):
        dictionary = trained(held, most)
        pack = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        head = b""
        if dictionary:
            raw = dictionary.as_bytes()
            head = struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
        out, n, left = bytearray(head), 0, len(held)
        for item in itertools.chain(held, records):
            out += pack.compress(item)
            n, left = n + 1, left - 1
            if len(out) >= most:
                yield bytes(out), n
                out, n = bytearray(head), 0
                if left <= 0:
                    break
        if n:
            yield bytes(out), n


def _sample(records: Iterator[bytes]) -> list[bytes]:
    held: list[bytes] = []
    size = 0
    while len(held) < SAMPLE_RECORDS and size < SAMPLE_BYTES:
        item = next(records, None)
        if item is None:
            break
        held.append(item)
        size += len(item)
    return held


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives of ``planned`` pages below ``folder``, which all executors share.

    Returns the manifest (archive, records, bytes), itself written to the folder.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _open(folder)
        files.create_dir(base, recursive=True)

        def made() -> Iterator[bytes]:
            for batch in batches:
                for row in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                    number = None if row.page_id is None else int(row.page_id)
                    other = None if row.refers_to is None else int(row.refers_to)
                    yield record(number, row.url, row.payload, row.sha1, other, row.refers_url)

        for content, n in archive(made(), archive_bytes):
            name = f"{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(posixpath.join(base, name), compression=None) as out:
                out.write(content)
            yield pd.DataFrame({"archive": [name], "records": [n], "bytes": [len(content)]})

    manifest = f"{folder.rstrip('/')}/manifest"
    plan.mapInPandas(run, MANIFEST).write.parquet(manifest)
    return plan.sparkSession.read.schema(MANIFEST).parquet(manifest)


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its header and block headers."""
    try:
        end = at + zstandard.frame_header_size(data[at : at + 18])
        checksum = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
    except zstandard.ZstdError as e:
        raise InvalidArchive(f"byte {at}: {e}") from e
    while True:
        if end + 3 > len(data):
            raise InvalidArchive(f"byte {at}: the frame is cut off")
        block = int.from_bytes(data[end : end + 3], "little")
        end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)  # a run is one byte
        if block & 1:
            end += 4 * checksum
            if end > len(data):
                raise InvalidArchive(f"byte {at}: the frame is cut off")
            return end


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, one for each record."""
    at, unpack = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic in SKIPPABLE_MAGICS:
            size = int.from_bytes(data[at + 4 : at + 8], "little")
            raw = data[at + 8 : at + 8 + size]
            if len(raw) < size or at + 8 > len(data):
                raise InvalidArchive(f"byte {at}: the skippable frame is cut off")
            if magic == DICTIONARY_MAGIC:
                if at:
                    raise InvalidArchive(f"byte {at}: the dictionary isn't the first frame")
                if raw[:4] == FRAME_MAGIC:
                    raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
            at += 8 + size
            continue
        end = frame_end(data, at)
        try:
            yield unpack.decompressobj().decompress(data[at:end])
        except zstandard.ZstdError as e:
            raise InvalidArchive(f"byte {at}: {e}") from e
        at = end


def _fields(head: bytes, first: bytes) -> dict[str, str]:
    start, *lines = head.split(b"\r\n")
    if not start.startswith(first):
        raise InvalidArchive(f"the first line is {start[:40]!r}")
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!-~]+", name):
            raise InvalidArchive(f"the header line {line[:40]!r} has no name")
        out[name.decode().lower()] = value.strip().decode()
    return out


def _page(value: str) -> int | None:
    found = re.fullmatch(rf"<{ID_PREFIX}(none|-?\d+)>", value)
    if not found:
        raise InvalidArchive(f"{value[:60]} is no record id")
    return None if found[1] == "none" else int(found[1])


def parsed(data: bytes) -> tuple:
    """A record as a row of RECORDS, once its headers, lengths and digest are found to be right."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise InvalidArchive("the header doesn't end")
    fields = _fields(head, VERSION)
    need = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"}
    if lacking := need - set(fields):
        raise InvalidArchive(f"it lacks {', '.join(sorted(lacking))}")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit") or kind == "revisit" and "warc-refers-to" not in fields:
        raise InvalidArchive(f"a record of type {kind} without what it needs")
    size = fields["content-length"]
    if not size.isdecimal() or len(rest) != int(size) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise InvalidArchive(f"the block has {len(rest) - 4} bytes, not {size}")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    if not gap:
        raise InvalidArchive("the HTTP header doesn't end")
    length = _fields(http, b"HTTP/1.").get("content-length", "")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if length != str(len(payload)):
            raise InvalidArchive(f"the payload has {len(payload)} bytes, not {length}")
        if digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
            raise InvalidArchive("the payload has another digest")
    elif payload or not length.isdecimal():
        raise InvalidArchive("a revisit with a payload, or without its length")
    page_id = _page(fields["warc-record-id"])
    url = unquote(fields.get("warc-target-uri", ""))
    return (
        page_id,
        None if url.startswith(ID_PREFIX) else url,
        kind,
        _page(fields["warc-refers-to"]) if kind == "revisit" else None,
        int(length),
        digest,
        payload if kind == "response" else None,
    )


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in a folder's manifest, one row each (see RECORDS).

    An archive that breaks the format, or lacks records, fails the job. ``payloads`` False leaves
    the payload null once it is checked.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _open(folder)
        for batch in batches:
            for name, records in zip(batch["archive"], batch["records"]):
                with files.open_input_stream(posixpath.join(base, name), compression=None) as source:
                    data = source.read()
                n = 0
                held: list[tuple] = []
                for frame in frames(data):
                    row = parsed(frame)
                    held.append(row if payloads else (*row[:-1], None))
                    n += 1
                    if len(held) == 200:
                        yield _rows(held)
                        held = []
                if held:
                    yield _rows(held)
                if n != records:
                    raise InvalidArchive(f"{name} has {n} records, not {records}")

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    # A stated number is not coalesced, however few bytes the manifest has.
    parts = max(1, manifest.count())
    return manifest.repartition(parts, F.col("archive")).mapInPandas(run, RECORDS)


def _rows(held: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    out = pd.DataFrame(held, columns=names)
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_files(files: DataFrame) -> DataFrame:
    """path and the records of archives that Spark's ``binaryFile`` reader has read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                rows = [parsed(frame) for frame in frames(data)]
                if rows:
                    out = _rows(rows)
                    out.insert(0, "path", name)
                    yield out

    return files.select("path", "content").mapInPandas(run, f"path string, {RECORDS}")
