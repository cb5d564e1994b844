"""Archives: round trip, revisits, segmentation, delimiters inside payloads, odd rows."""

import base64
import hashlib

import pytest

from strata.llm import warc

D = warc._DELIMITER


def brute(rows):
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    seen = {}
    for p, b in payloads:
        ids = [q for q, c in payloads if c == b]
        top = max((q for q in ids if q is not None), default=None)
        first = p == top and not seen.get((p, b))
        seen[(p, b)] = True
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit",
                    None if first else top))
    return sorted(map(repr, out))


def back(spark, rows, scratch, limit):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_archives(spark, warc.write_archives(pages, scratch + "/w", limit))
    return sorted(map(repr, [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()]))


@pytest.mark.parametrize("limit", [3, 64, 1 << 20])
def test_round_trip(spark, scratch, limit):
    nasty = ["", None, "a", D, D * 3, "WARC/1.0\r\nx", "x\r\n\r\nWARC/1.0", "\r\n", "\r\n\r\n", "é" * 50, "日本🙂" * 30, "x" * 500,
             "Content-Length: 0\r\n\r\n", "\r\n\r\n\r\nWARC/1.0\r\n\r\n"]
    rows = [(i, f"http://x/{i}\r\n", h) for i, h in enumerate(nasty)]
    rows += [(100, None, "a"), (101, "u", "a"), (101, "u", "a"), (None, "u", "a"), (None, None, "lone"), (7, "u", "same id")]
    assert back(spark, rows, scratch, limit) == brute(rows)


def test_empty_table_and_clashing_columns(spark, scratch):
    assert back(spark, [], scratch, 10) == []
    pages = spark.createDataFrame([(1, "u", "h", "x", 5)], "page_id long, url string, html string, record string, digest int")
    assert warc.read_archives(spark, warc.write_archives(pages, scratch + "/c")).count() == 1


def test_no_slice_forms_the_delimiter():
    for payload in (D.encode() * 5, b"WARC/1.0\r\n", b"ab" + D.encode()[:-2], ("é" + D).encode() * 3):
        for limit in (1, 2, 5, 7, 100):
            parts = list(warc.cut(memoryview(payload), limit))
            assert b"".join(parts) == payload
            for p in parts:
                assert D.encode() not in b"\r\n\r\n" + bytes(p) + b"\r\n\r\n"
                bytes(p).decode()


def test_digests_run_along_the_chunks(spark):
    pages = spark.createDataFrame([(1, "u", "abcdefgh")], "page_id long, url string, html string")
    got = warc.chunk_records(pages, 3).orderBy("chunk_no").collect()
    assert [(r.data, r.bytes_so_far, r.is_last) for r in got] == [("abc", 3, False), ("def", 6, False), ("gh", 8, True)]
    assert got[1].digest_so_far == base64.b32encode(hashlib.sha1(b"abcdef").digest()).decode()


def test_damage_is_noticed(spark, scratch):
    with pytest.raises(ValueError):
        list(warc._parse(b"WARC/1.0\r\nWARC-Record-ID: <x>\r\nContent-Length: 9\r\n\r\nabc"))
