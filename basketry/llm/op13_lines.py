"""Removal of lines that many documents share, by two Bloom filters.

A line's key is the line stripped of blanks and the control characters 9 to 13,
with A-Z lowered. One pass over the texts writes the 128-bit SHA-256 prefixes of
each row's distinct keys to the shared folder (``row keys``); no line leaves its
task. Over these a once-seen and a twice-seen Bloom filter are built: a key that
the once-seen filter already holds goes into the twice-seen one. The filters are
cut by hash into slices of fixed size (``SLICE_KEYS`` keys, 16 bits a key, two
bits of one 512-bit block each), as many as the counted keys need. Tasks send
their sparse parts of the filters (bit places, each at most once a chunk,
whatever number of documents repeats a line), and each slice is put together by
one task, so no filter is ever larger than a slice there.

Only keys that the twice-seen filter holds are suspected repeats; they alone are
shuffled, pre-aggregated, and counted exactly by their digests. Up to
``SENT_SLICES`` slices (64 MB) the filter is broadcast to the row keys; a larger
one stays dealt by slice and the digests go to it instead.

The common keys that come out are sent to the texts if they are frequent enough:
a key in at least 1 / ``KEYS_SENT`` of all counted occurrences is one of at most
``KEYS_SENT`` such keys, whatever the corpus. The other keys, each in few rows,
are joined with the suspected rows by shuffle and reach the texts as a list per
row, keyed by doc_id and text digest.

Defined results: NULL and empty texts have one empty line; a document counts once
for a key however often it holds the line; each row is a document, also when rows
repeat; a text all of whose lines go becomes empty; a carriage return is stripped
from the key and stays in a kept line; an empty table gives an empty result; other
columns are ignored. With ``keep_first`` the line stays in the document with the
smallest doc_id that holds its key (NULL ids rank last, repeated rows with that id
all keep it), at its first place there.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, materialize, table

MIN_DOCS = 10
MIN_CHARS = 1
BLANKS = b" \t\n\x0b\x0c\r"
WIDTH = 16                 # bytes of a key's digest

BLOCK_BITS = 9             # a key's two bits lie in one block of 512
SLICE_BITS = 23            # bits of a slice of a filter: 1 MB packed
SLICE_KEYS = 1 << 19       # counted keys for each slice: 16 bits a key
CHUNK_KEYS = 1 << 20       # keys that a task folds into sparse filters at once
SENT_SLICES = 64           # slices broadcast at most (64 MB)
KEYS_SENT = 1 << 18        # common keys sent to the texts at most


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def key_digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:WIDTH]


def _long_enough(key: bytes, min_chars: int) -> bool:
    if min_chars <= 1:
        return len(key) >= min_chars
    return len(key.decode("utf-8", "replace")) >= min_chars


def _bodies(docs: DataFrame) -> DataFrame:
    """doc_id, the text's bytes, and a digest that names the row's text."""
    body = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", body.alias("body"), F.unhex(F.substring(F.sha2(body, 256), 1, 2 * WIDTH)).alias("mark"))


def row_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Per row: doc_id, mark and the digests of its distinct keys (concatenated), written to the shared folder."""
    def work(batches):
        for b in batches:
            keys = []
            for body in b["body"]:
                distinct = dict.fromkeys(map(line_key, body.split(b"\n")))
                keys.append(b"".join(key_digest(k) for k in distinct if _long_enough(k, min_chars)))
            yield {"doc_id": b["doc_id"], "mark": b["mark"], "keys": keys}
    return materialize(map_batches(_bodies(docs), ["doc_id", "mark", "body"], "doc_id long, mark binary, keys binary", work),
                       "line_keys")


def _hashes(keys: bytes) -> np.ndarray:
    return np.frombuffer(keys, "<u8")[::2]


def places(hashes: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """The slice of each hash, and its 32-bit probe: block, bit, bit."""
    return ((hashes >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32), hashes.astype(np.uint32)


def probe_bits(probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each probe inside its slice."""
    low = np.uint32((1 << BLOCK_BITS) - 1)
    block = (probes >> np.uint32(2 * BLOCK_BITS)) << np.uint32(BLOCK_BITS)
    return block | ((probes >> np.uint32(BLOCK_BITS)) & low), block | (probes & low)


def sparse_filters(hashes: np.ndarray, slices: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(slice, probes seen, whether seen twice) of one chunk of keys."""
    part, probe = places(hashes, slices)
    both, n = np.unique((part << np.uint64(32)) | probe, return_counts=True)
    part = (both >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(both)], strict=True):
        yield int(part[start]), both[start:end].astype(np.uint32).tobytes(), (n[start:end] > 1).tobytes()


class SliceFilters:
    """The once-seen and the twice-seen filter of one slice."""

    def __init__(self):
        self.once = np.zeros(1 << SLICE_BITS, bool)
        self.twice = np.zeros(1 << SLICE_BITS, bool)

    def add(self, probes: bytes, again: bytes) -> None:
        one, two = probe_bits(np.frombuffer(probes, np.uint32))
        repeated = (self.once[one] & self.once[two]) | np.frombuffer(again, bool)
        self.twice[one[repeated]] = True
        self.twice[two[repeated]] = True
        self.once[one] = True
        self.once[two] = True

    def packed(self) -> bytes:
        return zlib.compress(np.packbits(self.twice, bitorder="little").tobytes(), 1)


def _open(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def holds(bits: np.ndarray, probes: np.ndarray, offset=np.uint64(0)) -> np.ndarray:
    """Whether both bits of each probe are set in the packed bits, which start ``offset`` bits before the slice."""
    one, two = (p.astype(np.uint64) + offset for p in probe_bits(probes))
    hit = np.uint8(1)
    return ((bits[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8)) &
            (bits[two >> np.uint64(3)] >> (two & np.uint64(7)).astype(np.uint8)) & hit).astype(bool)


def twice_seen(rows: DataFrame, slices: int) -> DataFrame:
    """(slice, packed twice-seen filter) over all row keys, written to the shared folder."""
    def fold(batches):
        held, size = [], 0

        def flush():
            found = list(sparse_filters(np.concatenate(held), slices)) if size else []
            return {"slice": [f[0] for f in found], "probes": [f[1] for f in found], "again": [f[2] for f in found]}
        for b in batches:
            for keys in b["keys"]:
                held.append(_hashes(keys))
                size += len(held[-1])
                if size >= CHUNK_KEYS:
                    yield flush()
                    held, size = [], 0
        yield flush()

    def merge(batches):
        at, filters = None, None
        for b in batches:
            for part, probes, again in zip(b["slice"], b["probes"], b["again"], strict=True):
                if part != at:
                    if filters:
                        yield {"slice": [at], "bits": [filters.packed()]}
                    at, filters = part, SliceFilters()
                filters.add(probes, again)
        if filters:
            yield {"slice": [at], "bits": [filters.packed()]}

    sparse = map_batches(rows, ["keys"], "slice long, probes binary, again binary", fold)
    dealt = sparse.repartition("slice").sortWithinPartitions("slice")
    return materialize(map_batches(dealt, ["slice", "probes", "again"], "slice long, bits binary", merge), "line_filters")


SUSPECT = "doc_id long, mark binary, key binary"


def suspected_by_broadcast(rows: DataFrame, filters: DataFrame, slices: int) -> DataFrame:
    """The row keys that the twice-seen filter holds; the filter is at most ``SENT_SLICES`` MB."""
    shared = rows.sparkSession.sparkContext.broadcast([(r.slice, bytes(r.bits)) for r in filters.collect()])

    def work(batches):
        bits = np.zeros(slices << (SLICE_BITS - 3), np.uint8)
        for part, packed in shared.value:
            bits[part << (SLICE_BITS - 3):(part + 1) << (SLICE_BITS - 3)] = _open(packed)
        for b in batches:
            out = {"doc_id": [], "mark": [], "key": []}
            for doc, mark, keys in zip(b["doc_id"], b["mark"], b["keys"], strict=True):
                part, probes = places(_hashes(keys), slices)
                found = np.flatnonzero(holds(bits, probes, part << np.uint64(SLICE_BITS))).tolist()
                out["key"] += [keys[WIDTH * i:WIDTH * i + WIDTH] for i in found]
                out["doc_id"] += [doc] * len(found)
                out["mark"] += [mark] * len(found)
            yield out
    return map_batches(rows, ["doc_id", "mark", "keys"], SUSPECT, work)


def suspected_by_slice(rows: DataFrame, filters: DataFrame, slices: int) -> DataFrame:
    """The same for a filter of any size: digests are dealt to the slices, each of which is read first by its task."""
    def deal(batches):
        for b in batches:
            out = {"slice": [], "kind": [], "doc_id": [], "mark": [], "data": []}
            for doc, mark, keys in zip(b["doc_id"], b["mark"], b["keys"], strict=True):
                part, _ = places(_hashes(keys), slices)
                for p in np.unique(part).tolist():
                    out["slice"].append(p)
                    out["data"].append(b"".join(keys[WIDTH * i:WIDTH * i + WIDTH]
                                                for i in np.flatnonzero(part == np.uint64(p)).tolist()))
                    out["kind"].append(1)
                    out["doc_id"].append(doc)
                    out["mark"].append(mark)
            yield out

    def test(batches):
        at, bits = None, None
        for b in batches:
            out = {"doc_id": [], "mark": [], "key": []}
            for part, kind, doc, mark, data in zip(b["slice"], b["kind"], b["doc_id"], b["mark"], b["data"], strict=True):
                if not kind:
                    at, bits = part, _open(data)
                elif part == at:
                    _, probes = places(_hashes(data), slices)
                    for i in np.flatnonzero(holds(bits, probes)).tolist():
                        out["doc_id"].append(doc)
                        out["mark"].append(mark)
                        out["key"].append(data[WIDTH * i:WIDTH * i + WIDTH])
            yield out

    names = ["slice", "kind", "doc_id", "mark", "data"]
    lists = map_batches(rows, ["doc_id", "mark", "keys"], "slice long, kind int, doc_id long, mark binary, data binary", deal)
    first = filters.select("slice", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
                           F.lit(None).cast("binary").alias("mark"), F.col("bits").alias("data"))
    dealt = first.unionByName(lists).repartition("slice").sortWithinPartitions("slice", "kind")
    return map_batches(dealt, names, SUSPECT, test)


def common_keys(docs: DataFrame, min_docs: int, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """(suspected row keys, common keys with n documents and the smallest doc_id), both written."""
    rows = row_keys(docs, min_chars)
    total = rows.agg(F.sum(F.length("keys"))).first()[0] or 0
    slices = max(1, math.ceil(total / WIDTH / SLICE_KEYS))
    filters = twice_seen(rows, slices)
    suspected = suspected_by_broadcast if slices <= SENT_SLICES else suspected_by_slice
    suspects = materialize(suspected(rows, filters, slices), "line_suspects")
    counted = suspects.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    return suspects, materialize(counted.where(F.col("n") >= min_docs), "line_common")


def _clean(body: bytes, drop, doc, keep_first: bool, min_chars: int) -> tuple[int, int, bytes]:
    """(lines, dropped lines, text that is left); ``drop`` gives (found, smallest doc_id) for a key's digest."""
    lines = body.split(b"\n")
    left, held = [], set()
    for line in lines:
        key = line_key(line)
        if _long_enough(key, min_chars):
            digest = key_digest(key)
            found, first = drop(digest)
            if found and (not keep_first or first != doc or digest in held):
                continue
            held.add(digest)
        left.append(line)
    return len(lines), len(lines) - len(left), b"\n".join(left)


def clean_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                keep_first: bool = False) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the text without the lines that ``min_docs`` documents share."""
    if min_docs < 2:
        raise ValueError("a repeated line is in at least two documents")
    suspects, common = common_keys(docs, min_docs, min_chars)
    total = common.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") * KEYS_SENT >= total
    sent = common.where(frequent).select("key", "first").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(sent.column(0).to_pylist(), sent.column(1).to_pylist(),
                                                              strict=True)))
    rare = common.where(~frequent).select("key", "first")
    bodies = _bodies(docs)
    if rare.isEmpty():
        bodies = bodies.withColumn("also", F.lit(None).cast("array<struct<key:binary,first:bigint>>"))
    else:
        lists = (suspects.join(rare, "key").select("doc_id", "mark", F.struct("key", "first").alias("pair")).distinct()
                 .groupBy(F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark")).agg(F.collect_list("pair").alias("also")))
        bodies = bodies.join(lists, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("mark") == F.col("__mark")), "left")

    def work(batches):
        sent = shared.value
        for b in batches:
            out = {"doc_id": b["doc_id"], "n_lines": [], "n_dropped": [], "kept": []}
            for doc, body, also in zip(b["doc_id"], b["body"], b["also"], strict=True):
                own = {p["key"]: p["first"] for p in also} if also else {}

                def drop(digest, own=own):
                    return (True, sent[digest]) if digest in sent else (digest in own, own.get(digest))
                n, dropped, kept = _clean(body, drop, doc, keep_first, min_chars)
                out["n_lines"].append(n)
                out["n_dropped"].append(dropped)
                out["kept"].append(kept)
            yield out
    cleaned = map_batches(bodies, ["doc_id", "body", "also"], "doc_id long, n_lines long, n_dropped long, kept binary", work)
    return cleaned.withColumn("kept", F.col("kept").cast("string"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: per document the counts and the digest of the text that is left."""
    rows = clean_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
                        FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS MATERIALIZED (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON c.key = k.key GROUP BY r, doc_id
"""
