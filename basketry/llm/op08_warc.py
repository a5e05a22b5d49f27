"""WARC archives: writing, streaming reading, segment reassembly, chunked transfer decoding.

Writing. A page becomes a ``response`` record whose block is an HTTP response in
chunked transfer framing, or, when a page with a larger id has the same payload
of at least ``REVISIT_BYTES`` bytes, a ``revisit`` record that refers to it.
Blocks longer than ``SEGMENT_BYTES`` are cut into segments: the record itself
and ``continuation`` records with origin id, segment number and, in the last
one, the total length. The archives are gzip files written by Spark's text
writer with the record end (two line breaks) as separator.

Reading. Spark's text reader splits the files at that separator, in file order;
each task puts the bytes together again and cuts them by ``Content-Length``, so a
task holds one record at a time. Segments are grouped by their origin id, ordered by
number, checked against the total length and joined; then the chunked framing is
taken off and the payload compared with its recorded digest.

Defined results: NULL html is an empty payload; pages below the length limit are
never revisits; of pages with equal payload those with the largest page_id are
responses (repeated rows of it all of them), a NULL page_id ranks lowest; an
empty table gives an empty result; line breaks in a url are percent-encoded, a
NULL url writes no target; other columns are ignored. A record that is short of
segments, has a wrong total length, a broken framing or a wrong digest carries
the reason in ``problem`` and no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, materialize, table
from basketry.session import scratch_path

REVISIT_BYTES = 1000
SEGMENT_BYTES = 1 << 14     # of a block in one record
CHUNK_BYTES = 1 << 12       # of a payload in one transfer chunk
RECORDS_PER_FILE = 20_000
DATE = "2024-01-01T00:00:00Z"
BREAK = b"\r\n"
GAP = b"\r\n\r\n"           # ends a header, and ends a record
HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n")
PAGE = "urn:x-page:"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        parts += [b"%x\r\n" % len(part), part, BREAK]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(BREAK, at)
        if end < 0:
            raise ValueError("chunk size without end")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != BREAK:
            raise ValueError("chunk without end")
        parts.append(body[at:at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, found, body = block.partition(GAP)
    if not found:
        raise ValueError("HTTP header without end")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _header(fields: list[tuple[str, str]]) -> bytes:
    return BREAK.join([b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields)]) + GAP


def _clean(url: str) -> str:
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in url or "\n" in url else url


def page_records(page_id, url, payload: bytes, refers_to, unique: str, segment: int = SEGMENT_BYTES) -> list[bytes]:
    """The WARC records of one page, without their closing gap."""
    name = f"<{PAGE}{page_id}:{unique}>"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        block = HTTP.replace(b"Transfer-Encoding: chunked\r\n", b"")
        fields += [("WARC-Refers-To", f"<{PAGE}{refers_to}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        return [_header([*fields, ("Content-Length", str(len(block)))]) + block]
    block = HTTP + chunked(payload)
    if len(block) <= segment:
        return [_header([*fields, ("Content-Length", str(len(block)))]) + block]
    out = []
    for number, at in enumerate(range(0, len(block), segment), 1):
        part = block[at:at + segment]
        if number == 1:
            mine = [*fields, ("WARC-Segment-Number", "1")]
        else:
            mine = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{PAGE}{page_id}:{unique}:{number}>"),
                    ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number))]
            if at + segment >= len(block):
                mine.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_header([*mine, ("Content-Length", str(len(part)))]) + part)
    return out


def _record_batches(batches):
    place, n = TaskContext.get().partitionId(), 0
    for b in batches:
        records = []
        for page, url, html, refers in zip(b["page_id"], b["url"], b["html"], b["refers_to"], strict=True):
            n += 1
            records += page_records(page, url, (html or "").encode("utf-8", "surrogatepass"), refers, f"{place}-{n}")
            if len(records) >= 256:
                yield {"record": records}
                records = []
        yield {"record": records}


def planned_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is the response's page_id for revisits, else NULL."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sized = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"),
                         F.octet_length(payload).alias("bytes"))
    shared = sized.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select(
        F.col("digest").alias("__digest"), "first_id")
    other = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return sized.join(shared, F.col("digest") == F.col("__digest"), "left").select(
        "page_id", "url", "html", F.when(other, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the pages' WARC records as gzip archives under ``path``."""
    records = map_batches(planned_records(pages), ["page_id", "url", "html", "refers_to"], "record binary",
                          _record_batches)
    # the cast keeps the bytes as they are; the writer adds the gap after each record
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", GAP.decode()).option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path, compression="gzip")


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC header")
    pairs = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _page_id(name: str):
    """The page id in a record name, NULL if it has none."""
    text = name.strip("<>").removeprefix(PAGE).split(":")[0]
    return int(text) if text.lstrip("-").isdigit() else None


def _unframed(block: bytes, digest: str | None) -> tuple[bytes | None, str | None]:
    """(payload, problem) of a complete response block."""
    try:
        payload = payload_of(block)
    except ValueError as e:
        return None, str(e)
    if digest and digest != "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode():
        return None, "wrong payload digest"
    return payload, None


PARSED = ("page_id long, record_type string, refers_to long, origin string, segment long, total long, digest string, "
          "block binary, payload binary, problem string")


class _Stream:
    """The bytes of one archive file, put together again from the reader's pieces, cut into records."""

    def __init__(self):
        self.data = bytearray()
        self.started = False

    def feed(self, piece: bytes):
        """Records that are complete now that another piece (after a gap) is known."""
        if self.started:
            self.data += GAP
        self.started = True
        self.data += piece
        yield from self._cut(len(GAP))

    def _cut(self, after: int):
        while True:
            head = self.data.find(GAP)
            if head < 0:
                return
            fields = _fields(bytes(self.data[:head]))
            end = head + len(GAP) + int(fields["content-length"])
            if len(self.data) < end + after:
                return
            block = bytes(self.data[head + len(GAP):end])
            whole = self.data[end:end + after] == GAP[:after]
            del self.data[:end + after]
            yield _record(fields, block, whole)

    def finish(self):
        """The last record: the reader swallows the gap at the end of a file."""
        # a record without a block ends where its header's gap would begin
        if self.data and GAP not in self.data:
            self.data += GAP
        yield from self._cut(0)
        if self.data:
            yield (None, "broken", *[None] * 7, "file ends in a record")


def _parse_batches(batches):
    """Records of archive pieces in file order; unsegmented responses are unframed at once."""
    columns = [c.split()[0] for c in PARSED.split(", ")]
    file, stream = None, _Stream()

    def told(rows):
        return {c: [r[i] for r in rows] for i, c in enumerate(columns)}

    for b in batches:
        rows: list[tuple] = []
        for name, piece in zip(b["file"], b["piece"], strict=True):
            if name != file:
                rows += stream.finish()
                file, stream = name, _Stream()
            rows += stream.feed(piece)
        yield told(rows)
    yield told(list(stream.finish()))


def _record(fields: dict[str, str], block: bytes, whole: bool) -> tuple:
    kind, name = fields["warc-type"], fields["warc-record-id"]
    segment = fields.get("warc-segment-number")
    total = fields.get("warc-segment-total-length")
    origin = fields.get("warc-segment-origin-id", name)
    refers = fields.get("warc-refers-to")
    digest = fields.get("warc-payload-digest")
    problem = None if whole else "wrong content length"
    payload = None
    if kind == "response" and segment is None and whole:
        payload, problem = _unframed(block, digest)
    return (_page_id(name), kind, _page_id(refers) if refers else None, origin, int(segment) if segment else None,
            int(total) if total else None, digest, block if segment else None, payload, problem)


def _join_batches(batches):
    for b in batches:
        out = {"page_id": b["page_id"], "payload": [], "problem": []}
        for parts, total, digest in zip(b["parts"], b["total"], b["digest"], strict=True):
            block = b"".join(p["block"] for p in parts)
            numbers = [p["segment"] for p in parts]
            payload = None
            if numbers != list(range(1, len(parts) + 1)) or total is None:
                problem = "segments are missing"
            elif len(block) != total:
                problem = "wrong total length"
            else:
                payload, problem = _unframed(block, digest)
            out["payload"].append(payload)
            out["problem"].append(problem)
        yield out


def reassembled(records: DataFrame) -> DataFrame:
    """(page_id, payload, problem) of segmented records: grouped by origin, ordered by segment number."""
    joined = records.where("segment is not null").groupBy("origin").agg(
        F.max(F.when(F.col("segment") == 1, F.col("page_id"))).alias("page_id"),
        F.max("total").alias("total"), F.max("digest").alias("digest"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    return map_batches(joined, ["page_id", "total", "digest", "parts"], "page_id long, payload binary, problem string",
                       _join_batches)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path`` (columns of ``PARSED``)."""
    pieces = spark.read.option("lineSep", GAP.decode()).text(path).select(
        F.input_file_name().alias("file"), F.col("value").cast("binary").alias("piece"))
    return map_batches(pieces, ["file", "piece"], PARSED, _parse_batches)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload, problem) of every page; revisits have no payload of their own."""
    records = read_records(spark, path)
    whole = records.where("segment is null").select("page_id", "record_type", "refers_to", "payload", "problem")
    parts = reassembled(records).select("page_id", F.lit("response").alias("record_type"),
                                        F.lit(None).cast("long").alias("refers_to"), "payload", "problem")
    return whole.unionByName(parts)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: write all pages as archives, read them back, and report every page."""
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archives(table(spark, sf_dir, "pages"), path)
    pages = materialize(read_pages(spark, path).select(
        "page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "problem"), "warc_pages")
    stored = pages.where("refers_to is null").select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                     "refers_to")
    # written, so that the join below has plain shuffles on both sides and a page with very many revisits is split
    referred = materialize(pages.where("record_type = 'response'").groupBy(F.col("page_id").alias("__page")).agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")), "warc_stored")
    revisits = pages.where("refers_to is not null").select("page_id", "record_type", "refers_to").join(
        referred, F.col("refers_to") == F.col("__page"), "left")
    return stored.unionByName(revisits.select(stored.columns))


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top > page_id THEN top END AS refers_to FROM w
"""
