"""Archives: what is read back against brute force, and the files themselves."""
import base64
import hashlib
import io
import random
import struct
from collections import Counter

import duckdb
import pytest
import zstandard
from cases import SF, words
from kinlink.llm import warc_zstd as W

SCHEMA = "page_id long, url string, html string, payload string, digest string, hot string, n long, _k string, of_page string"


def frame(spark, rows):
    return spark.createDataFrame([(i, f"https://example.org/{i}", t, "x", "x", "x", 1, "x", "x") for i, t in rows], SCHEMA)


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, min_bytes=0):
    payloads = [(i, (t or "").encode()) for i, t in rows]
    best = {}
    for i, p in payloads:
        if i is not None and len(p) >= min_bytes:
            best[p] = max(i, best.get(p, i))
    out = Counter()
    for i, p in payloads:
        of = best.get(p)
        again = of is not None and (i is None or i < of)
        out[(i, len(p), b32(p), "revisit" if again else "response", of if again else None)] += 1
    return out


def rows_of(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def awkward():
    base = "<html>" + words(60, 3) + "</html>"
    rows = [(1, base), (2, base), (9, base), (3, None), (4, ""), (5, " "), (6, "été 日本 \U0001f600"), (7, words(90_000, 5)), (8, "\r\n\r\n"),
            (None, base), (None, "alone"), (None, "alone"), (None, None), (10, "WARC/1.1\r\n\r\n"), (12, "twice"), (12, "twice"), (11, "twice"),
            (12, "other"), (-5, "negative"), (-7, "negative")]
    return rows + [(100 + i, "hot" if i % 3 else f"page {i} " + words(20, i)) for i in range(600)]


@pytest.mark.parametrize("limit", [W.ARCHIVE_BYTES, 20_000, 1])
def test_awkward_rows(spark, limit):
    rows = awkward()
    if limit == 1:
        rows = rows[:60]
    assert rows_of(W.archive_pages(frame(spark, rows).repartition(3), archive_bytes=limit)) == expected(rows)


def test_least_bytes(spark):
    rows = awkward()
    assert rows_of(W.archive_pages(frame(spark, rows), min_bytes=5)) == expected(rows, 5)


def test_cold_and_hot_copies(spark):
    """Thousands of rows: payloads below and above a thousandth of all rows, both ways to their page."""
    rows = [(i, f"pair {i // 2}" if i % 3 else "hot") for i in range(6000)]
    assert rows_of(W.archive_pages(frame(spark, rows).repartition(4))) == expected(rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows_of(W.archive_pages(frame(spark, rows).repartition(4))) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty(spark):
    got = W.archive_pages(frame(spark, []))
    assert got.count() == 0 and got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_table_and_sql(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = rows_of(W.archive_pages(pages))
    assert got == expected([(r.page_id, r.html) for r in pages.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    assert Counter(con.execute(W.duckdb_sql()).fetchall()) == got


def test_files(spark, tmp_path):
    """A dictionary leads the file, each record is a frame, all found by the index and readable by any decoder."""
    rows = [(i, f"<html><head><title>{i}</title></head><body>{words(120, i)}</body></html>") for i in range(400)] + [(1000, None)]
    texts = dict(rows)
    index = W.write_archives(frame(spark, rows).coalesce(2), folder=f"file://{tmp_path}/archives", archive_bytes=150_000).collect()
    paths = {r.path for r in index}
    plain = 0
    assert len(paths) > 2 and sum(r.record_type == "warcinfo" for r in index) == len(paths)
    for path in paths:
        data = open(path.removeprefix("file://"), "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        words_ = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
        assert words_[:4] == bytes.fromhex("37a430ec")
        open_ = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words_))
        mine = sorted((r.offset, r.length, r.record_type, r.page_id) for r in index if r.path == path)
        at = 8 + size
        for offset, length, kind, page in mine:
            assert offset == at
            at += length
            text = open_.decompress(data[offset:at])
            plain += len(zstandard.ZstdCompressor(level=3).compress(text))
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and text.endswith(b"\r\n\r\n")
            headers, block = W.record_at(path, offset, length)
            assert kind == "warcinfo" or block.split(b"\r\n\r\n", 1)[1].decode() == (texts[page] or "")
        assert at == len(data)
        assert len(list(W.records_of(path))) == len(mine)
    assert sum(r.length for r in index) < 0.8 * plain                       # the dictionary pays


def test_headers():
    made = W.revisit(4, "https://a.org/\r\nX-Evil: 1", 17, "ABC", 9, None, "2020-01-01T00:00:00Z")
    (headers, block), = W.parse(io.BytesIO(made))
    assert headers["warc-target-uri"] == "https://a.org/%0D%0AX-Evil: 1" and "x-evil" not in headers
    assert headers["warc-refers-to"] == "<urn:page:9>" and W.page_row(headers, block) == (4, 17, "ABC", "revisit", 9)


def test_damage_is_found():
    made = W.response(1, None, b"some payload", "2020-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        W.page_row(*next(W.parse(io.BytesIO(made.replace(b"some", b"sume")))))
    with pytest.raises(ValueError):
        list(W.parse(io.BytesIO(made[:-6])))


def test_training_refuses_little():
    assert W.train([b"x"]) is None and W.train([]) is None
    noise = random.Random(1)
    assert W.pack([noise.randbytes(10)])[1] == b""
