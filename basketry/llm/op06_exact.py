"""Exact duplicates through a cuckoo-filter index of text digests.

Texts are equal when identical after lower-casing A-Z only; a NULL text counts
as empty. Each row's SHA-256 is written once to the shared folder. The rows of
a partition then pass through a bounded combiner: a cuckoo filter of 16-bit
fingerprints whose slots hold the full digest, so a fingerprint hit is verified
against the stored content before it counts. When the combiner holds its limit
of live digests the oldest one is deleted from the filter and sent on as a
partial group, so one huge group of copies is a handful of partial rows when it
reaches the shuffle. The partial groups are dealt out by digest, and one
growing index per task merges them; a failed insertion (too many evictions)
doubles the bucket table and refills it from the stored keys.

Defined results: NULL and empty texts form one group; of equal texts the row
with the largest doc_id stays (NULL ids rank lowest), and of repeated rows with
that id exactly one; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import LOWER, UPPER, few_enough, map_batches, materialize, table

SLOTS = 4              # entries of a bucket
MAX_KICKS = 200        # evictions tried before the table is doubled
LIVE_DIGESTS = 1 << 17  # digests that the map-side combiner holds at once
GROUPS_SENT = 1 << 18    # groups of copies (16 MB) up to which the stage sends them to the scan
NO_ID = -(1 << 63)     # rank of a NULL doc_id


class CuckooIndex:
    """Cuckoo filter with stored keys: insert, find, delete, doubling on overflow."""

    def __init__(self, buckets: int = 1 << 10):
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = [0] * (buckets * SLOTS)
        self.keys: list = [None] * (buckets * SLOTS)
        self.values: list = [None] * (buckets * SLOTS)
        self.size = 0
        self.turn = 0

    def _places(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_64_intdigest(key)
        mark = (h >> 48) or 1
        one = h & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def _slot(self, key: bytes) -> int:
        mark, one, two = self._places(key)
        for bucket in (one, two):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                # a fingerprint hit counts only if the bucket's stored key is the same
                if self.prints[s] == mark and self.keys[s] == key:
                    return s
        return -1

    def find(self, key: bytes):
        s = self._slot(key)
        return None if s < 0 else self.values[s]

    def delete(self, key: bytes):
        """Take the live key out; returns its value, or None if it is not there."""
        s = self._slot(key)
        if s < 0:
            return None
        value = self.values[s]
        self.prints[s], self.keys[s], self.values[s] = 0, None, None
        self.size -= 1
        return value

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not in the index."""
        if value is None:
            raise ValueError("a live key needs a value")
        entry = self._place(key, value)
        while entry is not None:
            entry = self._grow(entry)

    def _place(self, key: bytes, value):
        mark, one, two = self._places(key)
        for bucket in (one, two):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[s]:
                    self.prints[s], self.keys[s], self.values[s] = mark, key, value
                    self.size += 1
                    return None
        bucket = two
        for _ in range(MAX_KICKS):
            self.turn += 1
            s = bucket * SLOTS + self.turn % SLOTS
            self.prints[s], mark = mark, self.prints[s]
            self.keys[s], key = key, self.keys[s]
            self.values[s], value = value, self.values[s]
            bucket = self._other(bucket, mark)
            for t in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[t]:
                    self.prints[t], self.keys[t], self.values[t] = mark, key, value
                    self.size += 1
                    return None
        return key, value

    def _grow(self, homeless):
        stored = [*self.items(), homeless]
        self._clear(2 * (self.mask + 1))
        for i, (key, value) in enumerate(stored):
            left = self._place(key, value)
            if left is not None:
                # the bigger table overflowed too: hand every entry to the next doubling
                rest = [*self.items(), left, *stored[i + 1:]]
                self._clear(2 * (self.mask + 1))
                for k, v in rest[:-1]:
                    self.insert(k, v)
                return rest[-1]
        return None

    def items(self) -> Iterator[tuple[bytes, object]]:
        for mark, key, value in zip(self.prints, self.keys, self.values, strict=True):
            if mark:
                yield key, value


def text_key(text: str | None) -> bytes:
    """SHA-256 of the text after lower-casing A-Z (bytes.lower touches ASCII letters only)."""
    return hashlib.sha256((text or "").encode("utf-8", "surrogatepass").lower()).digest()


def _digest_batches(batches):
    for b in batches:
        yield {"row_id": b["__row"], "doc_id": b["doc_id"], "digest": [text_key(t) for t in b["text"]]}


GROUP = "digest binary, n long, doc_id long, row_id long, n_keep long"


def _merge(old, new):
    """Groups are [rows, largest doc_id, row that stays, rows with that doc_id]."""
    if new[1] != old[1]:
        best, n_best = (new, new[3]) if new[1] > old[1] else (old, old[3])
    else:
        best, n_best = (new if new[2] < old[2] else old), old[3] + new[3]
    old[:] = [old[0] + new[0], best[1], best[2], n_best]


def _batch(groups):
    return {"digest": [k for k, _ in groups], "n": [v[0] for _, v in groups],
            "doc_id": [None if v[1] == NO_ID else v[1] for _, v in groups],
            "row_id": [v[2] for _, v in groups], "n_keep": [v[3] for _, v in groups]}


def _combine_batches(batches, limit: int = LIVE_DIGESTS):
    """Partial groups of one partition; at most ``limit`` digests live at once."""
    index, order, out = CuckooIndex(), deque(), []
    for b in batches:
        for row, doc, key in zip(b["row_id"], b["doc_id"], b["digest"], strict=True):
            new = [1, NO_ID if doc is None else doc, row, 1]
            old = index.find(key)
            if old is not None:
                _merge(old, new)
                continue
            if index.size >= limit:
                oldest = order.popleft()
                out.append((oldest, index.delete(oldest)))
            index.insert(key, new)
            order.append(key)
            if len(out) >= 8192:
                yield _batch(out)
                out = []
    out.extend(index.items())
    if out:
        yield _batch(out)


def _merge_batches(batches):
    index = CuckooIndex()
    for b in batches:
        for key, n, doc, row, n_keep in zip(b["digest"], b["n"], b["doc_id"], b["row_id"], b["n_keep"], strict=True):
            new = [n, NO_ID if doc is None else doc, row, n_keep]
            old = index.find(key)
            if old is None:
                index.insert(key, new)
            else:
                _merge(old, new)
    out = []
    for item in index.items():
        out.append(item)
        if len(out) >= 8192:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def digest_table(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, digest) of every row, written to the shared folder."""
    rows = docs.select("doc_id", "text").withColumn("__row", F.monotonically_increasing_id())
    return materialize(map_batches(rows, ["__row", "doc_id", "text"], "row_id long, doc_id long, digest binary",
                                   _digest_batches), "exact_digests")


def digest_groups(digests: DataFrame) -> DataFrame:
    """One row per distinct digest: n rows, the doc_id and row that stay, rows with that doc_id."""
    partial = map_batches(digests, ["row_id", "doc_id", "digest"], GROUP, _combine_batches)
    return map_batches(partial.repartition("digest"), ["digest", "n", "doc_id", "row_id", "n_keep"], GROUP,
                       _merge_batches)


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, digest."""
    digests = digest_table(docs)
    groups = digest_groups(digests).select("digest", F.col("n").alias("group_size"), F.col("doc_id").alias("keep_id"),
                                           F.col("row_id").alias("keep_row"))
    return digests.join(groups, "digest", "left").select(
        "doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), "digest")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row of each group of equal texts."""
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    key = F.unhex(F.sha2(lowered.cast("binary"), 256))
    groups = materialize(digest_groups(digest_table(docs)), "exact_groups")
    shared = few_enough(groups.where("n > 1").select(
        F.col("digest").alias("__digest"), F.col("doc_id").alias("__keep"), F.col("n_keep").alias("__same")), GROUPS_SENT)
    joined = docs.withColumn("__digest", key).join(shared, "__digest", "left")
    stays = joined.where("__same is null or doc_id <=> __keep")
    if groups.where("n_keep > 1").isEmpty():
        return stays.select(*docs.columns)
    # repeated rows: several rows hold the id that stays, one of them is kept
    once = stays.where("coalesce(__same, 1) = 1").select(*docs.columns)
    several = stays.where("__same > 1").dropDuplicates(["__digest"]).select(*docs.columns)
    return once.unionByName(several)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: one row per document with its group's keep_id, size and digest."""
    rows = exact_groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
