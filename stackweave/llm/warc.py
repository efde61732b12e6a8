"""WARC archives: writing pages, reading records back, reassembling segments.

Writing: each page becomes an HTTP response with a chunked body in a ``response`` record. Of pages
with equal payloads only the one with the smallest id carries it, the others are ``revisit``
records that refer to it. A block over ``SEGMENT`` bytes is split into a first record and
``continuation`` records. Spark's text writer puts the records into gzip files: what ends a line
there is the two line breaks that end a record.

Reading: the text reader cuts the archive at the same double breaks, and a task puts the pieces of
its files together again by the records' lengths. Segments are grouped by the id of their first
record, ordered by number, and their total length is verified; then the chunked framing is undone.
Unsegmented records never move. One record, as in the page it came from, must fit in memory.

Defined cases: a null payload is empty; a null url is left out; a null page_id sorts last and reads
back as null. Rows that repeat a page_id and its payload are stored once with their number and read
back as often. Broken records (no header, wrong length, missing or repeated segments, bad framing)
read back with ``intact`` false and a null payload, or not at all if they have no id; the reader
goes on at the next record. Pages that share a page_id (or have none) and differ in payload are
records of their own: one has the bare id, the ids of the others end with the payload's digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave import session
from stackweave.llm import common

SEGMENT = 32 << 10
CHUNK = 8 << 10
DATE = "1970-01-01T00:00:00Z"  # pages carry no time; a fixed one keeps archives reproducible
LEAST_REVISIT = 0  # payload bytes from which equal payloads are stored once
MOST = 1 << 31  # bytes of a block; a header that says more is taken as broken
_BREAK = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Base 32 digits of Java's number formatting, and of RFC 4648.
_PLAIN, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are four times 40, which are eight digits."""
    hexadecimal = F.sha1(payload)
    quarters = [F.lpad(F.conv(F.substring(hexadecimal, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*quarters), _PLAIN, _BASE32)


def _chunked(body: bytes) -> bytes:
    parts = []
    for at in range(0, len(body), CHUNK):
        piece = body[at : at + CHUNK]
        parts += [f"{len(piece):x}\r\n".encode(), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunk(framed: bytes) -> bytes | None:
    """The body of chunked framing; None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        size = framed[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or size.strip(b"0123456789abcdefABCDEF"):
            return None
        count = int(size, 16)
        if not count:
            return b"".join(parts)  # trailers are not part of the body
        at = end + 2 + count
        if framed[at : at + 2] != b"\r\n":
            return None
        parts.append(framed[end + 2 : at])
        at += 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _BREAK.encode() + block


def page_records(urn: str, url: str | None, sha1: str, rows: int, refers: str, revisit: bool, html: str | None, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page, each without the double break that ends it."""
    own = f"<{urn}>"
    shared: list[tuple[str, object]] = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("X-Rows", rows), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    if url is not None:
        shared.append(("WARC-Target-URI", "".join(url.split())))
    kind = ("Content-Type", "application/http; msgtype=response")
    if revisit:
        headers = [("WARC-Type", "revisit"), ("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers}>"), *shared, kind]
        return [_record(headers, b"HTTP/1.1 200 OK\r\n\r\n")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + _chunked((html or "").encode())
    headers = [("WARC-Type", "response"), *shared, kind]
    if len(block) <= segment:
        return [_record(headers, block)]
    out = []
    for number, at in enumerate(range(0, len(block), segment), 1):
        if number > 1:
            headers = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{urn}:{number}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", own)]
        last = [("WARC-Segment-Total-Length", len(block))] if at + segment >= len(block) else []
        out.append(_record([*headers, ("WARC-Segment-Number", number), *last], block[at : at + segment]))
    return out


def write(pages: DataFrame, path: str, least: int = LEAST_REVISIT, segment: int = SEGMENT) -> None:
    """Write pages (page_id, url, html) as gzip archives under a new folder."""
    body = F.coalesce("html", F.lit(""))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    hashed = pages.select("page_id", key.alias("key"), "url", "html", digest(body.cast("binary")).alias("sha1"))
    # Payloads are shuffled once: the join finds them dealt out by its own key.
    stored = hashed.groupBy("key", "sha1").agg(
        F.first("page_id").alias("page_id"), F.first("url").alias("url"), F.first("html").alias("html"), F.count("*").alias("rows")
    )
    first = hashed.groupBy("sha1").agg(F.min("page_id").alias("first"))
    # The hash of a payload that is in every third row is a skewed key of narrow rows here.
    again = (F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    sized = hashed.select("key", "page_id", "sha1", F.octet_length(F.coalesce("html", F.lit(""))).alias("size")).distinct()
    named = common.WorkTable(sized.join(first, "sha1").select("key", "page_id", "sha1", "first", again.alias("revisit")), "pages")
    # Of the payloads of one id a carried one has the bare record id.
    bare = named.df.groupBy("key").agg(F.min(F.struct("revisit", "sha1")).getField("sha1").alias("bare"))
    urn = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("None")), F.when(F.col("sha1") == F.col("bare"), "").otherwise(F.concat(F.lit(":"), "sha1")))
    called = named.df.join(bare, "key").withColumn("urn", urn)
    carried = called.where(F.col("page_id").eqNullSafe(F.col("first"))).select("sha1", F.col("urn").alias("refers"))
    names = called.join(carried, "sha1").select("key", "sha1", "urn", "refers", "revisit")
    rows = stored.join(names, ["key", "sha1"]).select("urn", "url", "sha1", "rows", "refers", "revisit", "html")

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records: list[bytes] = []
            for page in zip(*(batch.column(k) for k in range(batch.num_columns)), strict=True):
                records += page_records(*(value.as_py() for value in page), segment=segment)
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    # Bytes as they are: a segment may end within a character.
    text = rows.mapInArrow(lay_out, "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", _BREAK).option("compression", "gzip").text(path)
    named.drop()


_PARSED = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()),
    ("digest", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("rows", pa.int64()), ("block", pa.binary()),
])
_TYPES = "record_id string, record_type string, origin string, segment long, total long, digest string, refers_to string, target_uri string, rows long, block binary"


def _number(headers: dict[str, str], name: str) -> int | None:
    value = headers.get(name, "")
    return int(value) if value.isascii() and value.isdigit() else None


class _Stream:
    """Takes records off the bytes of an archive as they come."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.need = 0

    def add(self, piece: bytes) -> Iterator[tuple]:
        self.held += piece
        self.held += _BREAK.encode()
        if len(self.held) >= self.need:
            yield from self.take(last=False)

    def take(self, last: bool) -> Iterator[tuple]:
        """Whole records. ``last``: nothing follows, so what is not whole by now is broken."""
        held, at = self.held, 0
        while True:
            while at < len(held) and held[at] in b"\r\n":
                at += 1
            end = held.find(_BREAK.encode(), at) if held.startswith(b"WARC/1.", at) else -1
            if at == len(held):
                break
            if end >= 0:
                lines = held[at:end].decode("utf-8", "replace").split("\r\n")[1:]
                headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
                length = _number(headers, "content-length")
                stop = end + len(_BREAK) + (length or 0)
                if length is not None and length <= MOST and len(held) < stop + len(_BREAK) and not last:
                    self.need = stop + len(_BREAK) - at
                    break
                if length is not None and held[stop : stop + len(_BREAK)] == _BREAK.encode():
                    yield _row(headers, bytes(held[end + len(_BREAK) : stop]))
                    at = stop + len(_BREAK)
                    continue
            # No header here, or a length that does not fit: on to the next header.
            following = held.find(b"\nWARC/1.", at + 1)
            if following < 0:
                at = len(held)
                break
            at = following + 1
        if at:
            del held[:at]
        if not held:
            self.need = 0


def records(pieces: Iterator[bytes]) -> Iterator[tuple]:
    """Records from what lies between double breaks, in file order.

    A block may hold double breaks, or end with half of one, so only the lengths in the headers
    say where records end.
    """
    stream = _Stream()
    for piece in pieces:
        yield from stream.add(piece)
    yield from stream.take(last=True)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    get = headers.get
    sha1 = get("warc-payload-digest", "").removeprefix("sha1:") or None
    return (
        get("warc-record-id"), get("warc-type"), get("warc-segment-origin-id"), _number(headers, "warc-segment-number"),
        _number(headers, "warc-segment-total-length"), sha1, get("warc-refers-to"), get("warc-target-uri"), _number(headers, "x-rows") or 1, block,
    )


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = (piece.as_py() for batch in batches for piece in batch.column(0))
    held: list[tuple] = []
    size = 0
    for row in records(pieces):
        held.append(row)
        size += len(row[-1])
        if size > 4 << 20:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PARSED, strict=True)], schema=_PARSED)


def payload(blocks: list[tuple[int, int | None, bytes]]) -> bytes | None:
    """The body in the segments (number, total length, block) of a record; None if it is broken."""
    ordered = sorted(blocks, key=lambda b: b[0])
    whole = b"".join(block for _, _, block in ordered)
    totals = {total for _, total, _ in ordered if total is not None}
    if [number for number, _, _ in ordered] != list(range(1, len(ordered) + 1)):
        return None
    if totals != ({len(whole)} if len(ordered) > 1 else totals & {len(whole)}):
        return None
    head, found, body = whole.partition(_BREAK.encode())
    if not found:
        return None
    return unchunk(body) if b"transfer-encoding: chunked" in head.lower() else body


def read(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, digest, refers_to, target_uri, rows, payload and intact of the archives in a folder."""
    pieces = spark.read.option("lineSep", _BREAK).text(path).select(F.col("value").cast("binary"))
    found = pieces.mapInArrow(_parse, _TYPES).where("record_id is not null or origin is not null")
    facts = ("record_type", "digest", "refers_to", "target_uri", "rows")
    part = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "total", "block")
    # The archive is read once for the records that are whole and once for those in segments.
    single = found.where("segment is null and origin is null").select("record_id", *facts, F.array(part).alias("parts"))
    is_first = F.col("origin").isNull()
    grouped = (
        found.where("segment is not null").withColumn("record_id", F.coalesce("origin", "record_id")).groupBy("record_id")
        .agg(*(F.max(F.when(is_first, F.col(name))).alias(name) for name in facts), F.collect_list(part).alias("parts"))
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for parts, kind in zip(batch.column("parts"), batch.column("record_type"), strict=True):
                known = [(p["segment"].as_py(), p["total"].as_py(), p["block"].as_py()) for p in parts]
                bodies.append(payload(known) if kind.as_py() == "response" else None)
            names = ["record_id", *facts]
            arrays = [*(batch.column(name) for name in names), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "payload"])

    shape = single.select("record_id", *facts).schema.add("payload", "binary")
    whole = single.unionByName(grouped).mapInArrow(assemble, shape)
    intact = F.when(F.col("record_type") == "response", F.coalesce(digest(F.col("payload")) == F.col("digest"), F.lit(False))).otherwise(True)
    return whole.withColumn("intact", intact)


def page_of(record_id: Column) -> Column:
    """The page_id in a record id this module wrote."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)(?::[A-Z2-7]{32})?>$", 1).try_cast("long")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write pages to archives, read them back, and say of each page what its record was.

    page_id, payload_bytes, payload_digest, record_type, refers_to and intact; a revisit gets the
    length of the payload from the record it refers to.
    """
    spark = pages.sparkSession
    path = path or session.new_folder(spark, "warc")
    write(pages, path)
    back = read(spark, path)
    facts = back.select("record_id", "record_type", "digest", "refers_to", "rows", "intact", F.octet_length("payload").cast("long").alias("payload_bytes"))
    # Without payloads, for the revisits to find what they refer to.
    slim = common.WorkTable(facts, "records").df
    sizes = slim.where("record_type = 'response'").select(F.col("record_id").alias("_of"), F.col("payload_bytes").alias("_bytes"))
    joined = slim.join(sizes, slim.refers_to == sizes["_of"], "left")
    rows = joined.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return rows.select(
        page_of(F.col("record_id")).alias("page_id"), F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", page_of(F.col("refers_to")).alias("refers_to"), "intact",
    )
