"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so whole-document signatures would be
dominated by the rest of the document. Items are therefore partitioned by the
size of their shingle sets (powers of two). For a partition with items of up to
``u`` shingles a document is read in windows of ``2 u`` shingles that step by
``u``, so each passage of ``u`` shingles lies whole in some window, and each
window gets one minimum for each of 64 hash functions (the minima of a size are
made from those of the size below). A window that agrees with an item in any
function makes the item a candidate: at the containment threshold a window has a
similarity of at least 0.17 with the item, so all 64 functions miss it with a
probability below 1e-5. Candidates are confirmed on the full sets: the share of
the item's distinct shingles that the whole document holds.

The items are the stated query set. They are handled in blocks whose shingles
and signatures have a fixed bound (``BLOCK_SHINGLES``, ``BLOCK_ITEMS``; an item
is never cut); each block is broadcast and meets all documents. No document
leaves its task and nothing is grouped by item.

Defined results: an item without words is found nowhere; an item or document of
fewer than five words is one shingle, so it only matches an equally short text;
NULL texts count as empty; items with equal texts are all reported; repeated
rows are judged one by one; an empty benchmark finds nothing, an empty document
table gives an empty result; other columns are ignored (or passed through by
:func:`drop_contaminated`).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, materialize, ship_package, table
from basketry.llm.shingles import shingle_sequence, shingle_set

FUNCTIONS = 64
CONTAINED = 75               # percent of an item's shingles
BLOCK_SHINGLES = 1 << 20     # shingles of the items broadcast at once (8 MB)
BLOCK_ITEMS = 1 << 14        # items broadcast at once (their signatures: 8 MB)
FILTER_BITS = 20

_rng = np.random.default_rng(77)
_TURN = _rng.integers(1 << 63, size=FUNCTIONS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_FLIP = _rng.integers(1 << 63, size=FUNCTIONS, dtype=np.uint64)
_MASK = np.uint64((1 << FILTER_BITS) - 1)
_DROP = np.uint64(24)
_CHUNK = 1 << 14             # shingles of a very long document hashed at once


def _hashed(shingles: np.ndarray) -> np.ndarray:
    return (shingles[:, None] ^ _FLIP[None, :]) * _TURN[None, :]


@dataclass
class Partition:
    """Items of one size partition and the sorted signature values that lead to them."""

    upper: int
    values: np.ndarray     # sorted
    owners: np.ndarray     # item of each value
    seen: np.ndarray       # bit table over part of the value's bits


class ItemIndex:
    """Search index over one block of items."""

    def __init__(self, item_ids: list, sets: list[np.ndarray]):
        self.item_ids = item_ids
        self.sets = sets
        by_size: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            if len(s):
                by_size.setdefault(1 << (len(s) - 1).bit_length(), []).append(i)
        self.partitions = []
        for upper in sorted(by_size):
            members = by_size[upper]
            values = np.concatenate([_hashed(sets[i]).min(axis=0) for i in members])
            owners = np.repeat(np.array(members), FUNCTIONS)
            order = np.argsort(values, kind="stable")
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[(values >> _DROP) & _MASK] = True
            self.partitions.append(Partition(upper, values[order], owners[order], seen))

    def candidates(self, sequence: np.ndarray) -> set[int]:
        """Items that agree with some window of the shingle sequence in some function."""
        found: set[int] = set()
        if not self.partitions:
            return found
        largest = self.partitions[-1].upper
        step = max(_CHUNK, 2 * largest)
        for start in range(0, len(sequence), step):
            # pieces overlap by the largest window, so no passage is cut
            piece = sequence[start:start + step + 2 * largest]
            minima, size = _hashed(piece), 1
            for part in self.partitions:
                while size < part.upper:
                    odd = minima[-1:] if len(minima) % 2 else minima[:0]
                    even = minima[:len(minima) - len(odd)]
                    minima = np.concatenate([np.minimum(even[0::2], even[1::2]), odd])
                    size *= 2
                windows = np.minimum(minima[:-1], minima[1:]) if len(minima) > 1 else minima
                hits = windows[part.seen[(windows >> _DROP) & _MASK]]
                if len(hits):
                    low = np.searchsorted(part.values, hits, "left")
                    high = np.searchsorted(part.values, hits, "right")
                    for a, b in {(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True) if a < b}:
                        found.update(part.owners[a:b].tolist())
        return found

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, shared shingles, item's shingles) of the items that the whole text contains."""
        sequence = shingle_sequence(text)
        candidates = self.candidates(sequence)
        if not candidates:
            return []
        whole = np.unique(sequence)
        out = []
        for i in sorted(candidates):
            item = self.sets[i]
            at = np.searchsorted(whole, item)
            shared = int((whole[np.minimum(at, len(whole) - 1)] == item).sum())
            if 100 * shared >= CONTAINED * len(item):
                out.append((i, shared, len(item)))
        return out


def _item_batches(batches):
    for b in batches:
        yield {"item_id": b["item_id"], "shingles": [shingle_set(t).view(np.int64) for t in b["text"]]}


def item_blocks(items: DataFrame):
    """Broadcast :class:`ItemIndex` data of each block of items: (ids, sets), bounded as stated above."""
    spark = items.sparkSession
    sets = materialize(map_batches(items, ["item_id", "text"], "item_id long, shingles array<long>", _item_batches),
                       "benchmark_items")
    n, total = sets.select(F.count("*"), F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil(total / BLOCK_SHINGLES))
    dealt = sets.withColumn("block", F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)))
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("item_id", "shingles").toArrow()
        ids = rows.column(0).to_pylist()
        arrays = [np.array(x.values.to_numpy(zero_copy_only=False)).view(np.uint64) for x in rows.column(1)]
        yield spark.sparkContext.broadcast((ids, arrays))


FOUND = "row_id long, doc_id long, item_ids array<long>, shared array<long>, sizes array<long>"


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id and the contained items with their shared and total shingles."""
    rows = docs.select("doc_id", "text").withColumn("__row", F.monotonically_increasing_id())
    passes = []
    for shared in item_blocks(items):
        def work(batches, shared=shared):
            index = ItemIndex(*shared.value)
            for b in batches:
                found = [index.find(t) for t in b["text"]]
                yield {"row_id": b["__row"], "doc_id": b["doc_id"],
                       "item_ids": [[index.item_ids[i] for i, _, _ in f] for f in found],
                       "shared": [[s for _, s, _ in f] for f in found],
                       "sizes": [[n for _, _, n in f] for f in found]}
        passes.append(map_batches(rows, ["__row", "doc_id", "text"], FOUND, work))
    if len(passes) == 1:
        return passes[0].drop("row_id")
    both = passes[0]
    for more in passes[1:]:
        both = both.unionByName(more)
    joined = [F.flatten(F.collect_list(c)).alias(c) for c in ("item_ids", "shared", "sizes")]
    return both.groupBy("row_id", "doc_id").agg(*joined).drop("row_id")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item; filtered in place, block after block, without a shuffle."""
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")
    for shared in item_blocks(items):
        def keep(batches, shared=shared):
            index = ItemIndex(*shared.value)
            for b in batches:
                yield b.filter(pa.array([not index.find(t) for t in b.column(at).to_pylist()], pa.bool_()))
        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: how many benchmark items it contains, which, the largest share, and kept."""
    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    shares = F.transform(F.arrays_zip("shared", "sizes"), lambda x: x["shared"] / x["sizes"])
    return found.select("doc_id", F.size("item_ids").cast("long").alias("n_items"),
                        F.array_join(F.transform(F.array_sort("item_ids"), lambda i: i.cast("string")), ",")
                        .alias("item_ids"),
                        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("containment"),
                        (F.size("item_ids") == 0).alias("kept"))


ORACLE = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents
           UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM t),
s AS (SELECT kind, id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
      FROM w),
e AS (SELECT kind, id, unnest(sh) AS x FROM s),
p AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS k FROM e d JOIN e i ON d.x = i.x
      AND d.kind = 'd' AND i.kind = 'i' GROUP BY 1, 2),
f AS (SELECT doc_id, item_id, CAST(k AS DOUBLE) / len(sh) AS share FROM p JOIN s ON s.kind = 'i' AND s.id = item_id
      WHERE 100 * k >= 75 * len(sh)),
g AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS ids,
      max(share) AS share FROM f GROUP BY 1)
SELECT documents.doc_id, coalesce(n, 0) AS n_items, coalesce(ids, '') AS item_ids,
       coalesce(share, 0.0) AS containment, n IS NULL AS kept
FROM documents LEFT JOIN g ON g.doc_id = documents.doc_id
"""
