import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stackweave import session
from stackweave.llm import warc

SCHEMA = "page_id long, url string, html string"
NASTY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nb"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        kept = first.get(html or "")
        kind = "response" if page == kept else "revisit"
        out.append((page, len((html or "").encode()), sha1(html), kind, None if kind == "response" else kept))
    return sorted(out, key=repr)


def pages():
    dice = random.Random(6)
    rows = [(1, "http://x/ a\r\nb", NASTY), (2, None, None), (3, "u", ""), (4, "u", "é" * 30_000), (5, "u", "é" * 30_000), (6, "u", "\r\n\r\n" * 9)]
    rows += [(k, f"http://x/{k}", "".join(dice.choices("aé\r\n<>", k=dice.randrange(300)))) for k in range(10, 60)]
    rows += [(100 + k, "u", "copy") for k in range(30)] + [(None, "u", "copy"), (None, "u", "alone"), (200, "u", "again"), (200, "u", "again")]
    return rows


def test_digest(spark):
    df = spark.createDataFrame([("",), ("abc",), (NASTY,)], "t string")
    assert [r[0] for r in df.select(warc.digest(F.col("t").cast("binary"))).collect()] == [sha1(""), sha1("abc"), sha1(NASTY)]


@pytest.mark.parametrize("segment", [warc.SEGMENT, 64])
def test_round_trip(spark, segment, monkeypatch):
    rows = pages()
    path = session.new_folder(spark, "warc-test")
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path, segment=segment)
    back = warc.read(spark, path)
    assert back.where("not intact").count() == 0
    found = {r.record_id: bytes(r.payload).decode() for r in back.where("record_type = 'response'").collect()}
    want = {f"<urn:page:{page}>": html or "" for page, _, html in rows if (page, html or "") in {(p, h or "") for p, _, h in rows}}
    assert all(want[k] == v for k, v in found.items()) and len(found) == len({r[0] for r in plain(rows) if r[3] == "response"})


def test_pages_equal_brute_force(spark):
    rows = [row for row in pages() if row[2] != "alone"]
    found = warc.round_trip(spark.createDataFrame(rows, SCHEMA))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=repr) == plain(rows)
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_short_payloads_are_never_revisits(spark):
    path = session.new_folder(spark, "warc-test")
    warc.write(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], SCHEMA), path, least=3)
    assert {r.record_id: r.record_type for r in warc.read(spark, path).collect()} == {
        "<urn:page:1>": "response", "<urn:page:2>": "response", "<urn:page:3>": "response", "<urn:page:4>": "revisit"
    }


def test_segments_in_any_order_and_broken_ones():
    whole = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc._chunked(b"x" * 20_000)
    parts = [(k + 1, len(whole) if (k + 1) * 1000 >= len(whole) else None, whole[k * 1000 : (k + 1) * 1000]) for k in range(-(-len(whole) // 1000))]
    random.Random(1).shuffle(parts)
    assert warc.payload(parts) == b"x" * 20_000
    assert warc.payload(parts[1:]) is None
    assert warc.payload(parts + parts[:1]) is None
    assert warc.payload([(n, None if t is None else t + 1, b) for n, t, b in parts]) is None
    assert warc.payload([(1, None, b"HTTP/1.1 200 OK\r\n\r\nplain")]) == b"plain"
    assert warc.payload([(1, None, b"no header")]) is None


@pytest.mark.parametrize("framed, body", [
    (b"3\r\nabc\r\n0\r\n\r\n", b"abc"), (b"3;x=y\r\nabc\r\nA\r\n0123456789\r\n0\r\nT: 1\r\n\r\n", b"abc0123456789"), (b"0\r\n\r\n", b""),
    (b"3\r\nab", None), (b"zz\r\nabc\r\n", None), (b"-1\r\n", None), (b"", None), (b"3\r\nabcd\r\n0\r\n\r\n", None),
])
def test_chunked_framing(framed, body):
    assert warc.unchunk(framed) == body


def test_the_reader_goes_on_after_a_broken_record():
    good = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>")], b"block\r\n\r\nmore")
    short = good.replace(b"Content-Length: 13", b"Content-Length: 99")
    stream = b"junk\r\n\r\n" + short + b"\r\n\r\n" + good + b"\r\n\r\n" + good.replace(b"Content-Length: 13", b"Content-Length: x") + b"\r\n\r\n" + good
    rows = list(warc.records(iter(stream.split(b"\r\n\r\n"))))
    assert [(r[0], r[-1]) for r in rows] == [("<urn:page:1>", b"block\r\n\r\nmore")] * 2


def test_one_id_with_several_payloads(spark):
    long = ["".join(random.Random(k).choices("ab<>", k=90_000)) for k in range(3)]
    rows = [(1, "u", long[0]), (1, "u", long[1]), (1, "u", "short"), (2, "u", long[1]), (2, "u", "short"), (2, "u", "own"), (None, "u", long[2]), (None, "u", "x"), (None, "u", long[0])]
    found = warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.where("not intact or payload_bytes is null").count() == 0
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=repr) == sorted(
        ((*row[:4], None if row[3] == "response" else row[4]) for row in _expected(rows)), key=repr
    )


def _expected(rows):
    """As plain(), but a payload that only pages without an id have is carried by one of them."""
    first = {}
    for page, _, html in rows:
        first[html] = page if first.get(html) is None else min(page or first[html], first[html])
    return [(page, len(html), sha1(html), "response" if page == first[html] else "revisit", first[html]) for page, _, html in rows]
