"""Operator 11, web archives (WARC 1.1) with a Zstandard dictionary in each file.

Payloads are told apart by their SHA-256.  One aggregation finds the payloads
that occur more than once, with their number and largest page; of equal
payloads of at least ``min_bytes`` that page is a response record, the others
are revisit records that refer to it and hold no payload.  A payload that
makes up more than a thousandth of all rows (so there are fewer than a
thousand such) is looked up in a broadcast table, and its revisits lose their
payload before anything is shuffled; all others are joined on the digest.

Each task gathers records up to ``archive_bytes``, trains a dictionary on
them, writes it in a leading skippable frame (magic 0x184D2A5D) and each
record as a frame of its own behind it.  An archive thus depends on no other
file, and a record can be read by its offset.  An archive too small to train
on has no dictionary frame.  Files are named by task attempt; the index, one
row a record, is written by Spark's committer and names the files of
successful attempts only, so that a lost executor leaves at most files that
nothing reads.  Folder and index lie where ``spark.checkpoint.dir`` says.

``read_archives`` reads whole archives record by record, checks every payload
against its digest and takes lengths and references of revisits from their
headers.

Defined results: a null or empty html is a payload of no bytes, like any
other; a long one is a record (and, above ``archive_bytes``, an archive) of
its own.  Rows with a null page id have a random record id and read back with
a null page id; they are revisits if a page with an id has their payload, and
responses otherwise.  Rows that share a page id share a record id; if that is
the largest of their payload, each of them is a response.  A null url gives
no target line; line breaks in one are percent-encoded.  An empty table gives
no archive and no rows.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize
from .common import ROWS_AT_ONCE, ship, slices

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"

#: Bytes of records in an archive, and of its dictionary (at most a hundredth of the records).
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 112_640
LEVEL = 3
INDEX = "path string, offset long, length long, record_type string, page_id long"
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


# ------------------------------------------------------------- records --
def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: str) -> str:
    return f"{name}: {value}".replace("\r", "%0D").replace("\n", "%0A") + "\r\n"


def record(kind: str, page_id: int | None, url: str | None, block: bytes, date: str, more: list[tuple[str, str]]) -> bytes:
    """A whole WARC record."""
    name = f"{PAGE_URN}{page_id}" if page_id is not None else uuid.uuid4().urn
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date)]
    if url is not None:
        lines.append(("WARC-Target-URI", url))
    lines += [*more, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(_line(n, v) for n, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _http(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def response(page_id: int | None, url: str | None, payload: bytes, date: str) -> bytes:
    return record("response", page_id, url, _http(len(payload)) + payload, date,
                  [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http; msgtype=response")])


def revisit(page_id: int | None, url: str | None, payload_bytes: int, payload_digest: str, of_page: int, of_url: str | None, date: str) -> bytes:
    """The block holds the headers of the answer, whose length stays known, and no payload."""
    more = [("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{of_page}>"),
            ("WARC-Refers-To-Date", date)]
    if of_url is not None:
        more.append(("WARC-Refers-To-Target-URI", of_url))
    return record("revisit", page_id, url, _http(payload_bytes), date, [*more, ("Content-Type", "application/http; msgtype=response")])


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a decompressed stream."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield headers, block


# ------------------------------------------------------------ archives --
def train(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Dictionary of these records; None if there is too little to train on."""
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 100)
    try:
        return zstandard.train_dictionary(size, records, k=512, d=8, level=LEVEL) if size >= 512 else None
    except zstandard.ZstdError:
        return None


def pack(records: list[bytes]) -> tuple[list[bytes], bytes]:
    """One frame a record, and what leads the file."""
    trained = train(records)
    if trained is None:
        press, lead = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True), b""
    else:
        trained.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        inner = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        lead = struct.pack("<II", DICTIONARY_MAGIC, len(inner)) + inner
    return [press.compress(r) for r in records], lead


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file that every executor reaches."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _open(file) -> tuple[zstandard.ZstdDecompressor, int]:
    """Decompressor with the dictionary of an archive, and where its records begin."""
    head = file.read(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", head[4:])[0]
        inner = file.read(size)
        if inner.startswith(ZSTD_MAGIC):
            inner = zstandard.ZstdDecompressor().decompress(inner)
        return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(inner)), 8 + size
    return zstandard.ZstdDecompressor(), 0


def records_of(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    store, path = _store(uri)
    with store.open_input_file(path) as file:
        press, start = _open(file)
        file.seek(start)
        yield from parse(io.BufferedReader(press.stream_reader(file, read_across_frames=True), 1 << 20))


def record_at(uri: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record of an archive, by its place in the index."""
    store, path = _store(uri)
    with store.open_input_file(path) as file:
        press, _ = _open(file)
        file.seek(offset)
        return next(parse(io.BytesIO(press.decompress(file.read(length)))))


# ------------------------------------------------------------- writing --
def _write(folder: str, archive_bytes: int, date: str):
    """Arrow helper: writes a task's records to archives, yields their index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        waiting, size, written = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting, size, written
            name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{written:05d}.warc.zst"
            info = record("warcinfo", None, None, b"format: WARC File Format 1.1\r\n", date,
                          [("WARC-Filename", name), ("Content-Type", "application/warc-fields")])
            kinds, ids, records = zip(("warcinfo", None, info), *waiting)
            frames, lead = pack(list(records))
            offsets, at = [], len(lead)
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(lead)
                for frame in frames:
                    offsets.append(at)
                    out.write(frame)
                    at += len(frame)
            waiting, size, written = [], 0, written + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"] * len(ids)), pa.array(offsets, pa.int64()), pa.array(map(len, frames), pa.int64()),
                 pa.array(kinds), pa.array(ids, pa.int64())], names=["path", "offset", "length", "record_type", "page_id"])

        for batch in batches:
            for part in slices([batch], ROWS_AT_ONCE):
                for row in part.to_pylist():
                    if row["of_page"] is None:
                        kind, made = "response", response(row["page_id"], row["url"], row["payload"], date)
                    else:
                        kind, made = "revisit", revisit(row["page_id"], row["url"], row["payload_bytes"],
                                                        base64.b32encode(bytes.fromhex(row["sha1"])).decode(), row["of_page"], row["of_url"], date)
                    waiting.append((kind, row["page_id"], made))
                    size += len(made)
                    if size >= archive_bytes:
                        yield flush()
        if waiting:
            yield flush()

    return run


def decided(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, sha1, of_page, of_url``: pages with the page they revisit.

    Revisits carry no payload.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")) \
                .withColumn("digest", F.unhex(F.sha2("payload", 256)))
    groups = (base.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url")).alias("best"))
              .filter((F.col("n") > 1) & F.col("best.page_id").isNotNull()))
    groups, _ = materialize(groups, "payloads")
    often = F.col("n") > pages.count() / 1000
    hot = groups.filter(often).select("digest", F.col("best").alias("hot"))
    cold = groups.filter(~often).select(F.col("digest").alias("_d"), F.col("best").alias("cold"))

    def revisits(best: str):
        later = F.col(f"{best}.page_id")
        return later.isNotNull() & F.coalesce(F.col("page_id") < later, F.lit(True))

    rows = base.join(F.broadcast(hot), "digest", "left")
    # rows that were looked up look for nothing in the second join, each under a key of its own
    done = F.concat("digest", F.coalesce(F.col("page_id").cast("string"), F.col("url"), F.lit("-")).cast("binary"))
    rows = rows.select("page_id", "url", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"), "hot",
                       F.when(~revisits("hot"), F.col("payload")).alias("payload"),
                       F.when(F.col("hot").isNull(), F.col("digest")).otherwise(done).alias("_k"))
    rows = rows.join(cold, F.col("_k") == F.col("_d"), "left")
    of = F.when(revisits("hot"), F.col("hot")).when(revisits("cold"), F.col("cold"))
    return rows.select("page_id", "url", F.when(~revisits("cold"), F.col("payload")).alias("payload"), "payload_bytes", "sha1",
                       of["page_id"].alias("of_page"), of["url"].alias("of_url"))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``page_id, url, html`` rows as archives in ``folder``; index of all records.

    ``date`` is the capture date of every record, as the pages have none.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/kinlink-warc-{uuid.uuid4().hex}"
    index, _ = materialize(decided(pages, min_bytes).mapInArrow(_write(folder, archive_bytes, date), INDEX), "index")
    return index


# ------------------------------------------------------------- reading --
def _page(name: str | None) -> int | None:
    found = re.fullmatch(rf"<{PAGE_URN}(-?\d+)>", name or "")
    return int(found[1]) if found else None


def page_row(headers: dict[str, str], block: bytes) -> tuple | None:
    """A record as a row of ``PAGES``; None for records of no page."""
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)\r\nContent-Length: *(\d+)", http)[1])
    said = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload), digest(payload)) != (length, said):
        raise ValueError(f"record {headers['warc-record-id']} does not hold what its header says")
    return _page(headers["warc-record-id"]), length, said, kind, _page(headers.get("warc-refers-to"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PAGES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            rows = []
            for headers, block in records_of(uri):
                if (row := page_row(headers, block)) is not None:
                    rows.append(row)
                if len(rows) == 4096:
                    yield made(rows)
                    rows = []
            if rows:
                yield made(rows)


def read_archives(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """Rows of ``PAGES`` for all records of the archives that the first column of ``paths`` names."""
    ship(spark)
    n = paths.count()
    return paths.repartition(max(1, n), paths.columns[0]).mapInArrow(_read, PAGES)


def archive_pages(pages: DataFrame, **how) -> DataFrame:
    """Write the pages as archives, then read all of them back."""
    index = write_archives(pages, **how)
    return read_archives(pages.sparkSession, index.filter(F.col("record_type") == "warcinfo").select("path"))


def duckdb_sql() -> str:
    """The same rows from the pages alone; base32 from each 20 bits of the digest."""
    return """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    g AS (SELECT payload, max(page_id) AS best FROM p GROUP BY payload)
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
           list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(sha1(payload), CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT) >> s) & 31), 1)),
               'string_agg', '')), 'string_agg', '') AS payload_digest,
           CASE WHEN page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < best THEN best END AS refers_to
    FROM p JOIN g USING (payload)
    """
