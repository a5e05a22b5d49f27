"""Ranked lexical search by the Best Position Algorithm.

The items are the stated query set, taken in blocks of a bounded number of terms;
the documents never leave their tasks. One pass over the texts writes, for each
chunk of documents, an inverted index of the block's terms (term, document,
frequency) and the document lengths to the shared folder. The corpus statistics
are sums over the chunks: documents, terms, and the documents that hold a term.

A second pass over the chunks ranks: each term has an impact list, its documents
by descending impact. The lists of an item are read downwards in steps; each
document met is looked up in all of the item's lists (direct access), which gives
its whole score and marks its position in every list as seen. A list's best
position is the end of its run of seen positions from the top; what is unseen can
score at most the sum of the impacts just below the best positions. Reading stops
when that bound is strictly below the score at rank k, so equal scores are never
missed. The k best of an item are kept from chunk to chunk of a task, so later
chunks stop earlier; a task gives back at most k rows an item, which are merged
in two steps.

Defined results: terms are runs of digits, ASCII letters (lowered) and all
characters beyond ASCII; a NULL text or item has none; documents without terms
count nowhere; an item without terms, or one whose terms no document holds, has no
row; each item row is ranked for itself, also when ids repeat; each document row
is ranked, repeated rows too; equal scores go by ascending doc_id, NULL ids last;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, materialize, table

K = 20
BLOCK_TERMS = 1 << 18      # terms of the items handled at once
CHUNK_DOCS = 1 << 14       # documents of an index chunk
CHUNK_HITS = 1 << 21       # query terms found in the documents of a chunk, with repeats
PIECE = 1 << 22            # bytes of a very long text split at once
STEP = 32                  # positions read of each list at first; doubled from step to step
MERGE = 64                 # groups of tasks whose results are merged first

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def text_terms(body: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    folded = body.translate(_FOLD)
    start = 0
    while len(folded) - start > PIECE:
        cut = folded.rfind(b" ", start, start + PIECE)
        if cut < 0:
            cut = folded.find(b" ", start + PIECE)
            if cut < 0:
                break
        yield folded[start:cut].split()
        start = cut + 1
    yield folded[start:].split()


def _bodies(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))


def item_terms(items: DataFrame) -> DataFrame:
    """Per item row: its number, id and terms with repeats, written to the shared folder."""
    def work(batches):
        for b in batches:
            yield {"row": b["row"], "item_id": b["id"],
                   "terms": [[t for part in text_terms(body) for t in part] for body in b["body"]]}
    rows = _bodies(items, "item_id").withColumn("row", F.monotonically_increasing_id())
    return materialize(map_batches(rows, ["row", "id", "body"], "row long, item_id long, terms array<binary>", work),
                       "search_items")


CHUNK = ("n_docs long, n_terms long, terms array<int>, dfs array<long>, doc_ids array<long>, "
         "lengths binary, docs binary, tfs binary")


class ChunkBuilder:
    """Inverted index of the query terms over some documents."""

    def __init__(self):
        self.doc_ids, self.lengths, self.found, self.hits = [], [], [], array("i")

    def add(self, doc_id, body: bytes, vocabulary: dict[bytes, int]) -> None:
        length, before = 0, len(self.hits)
        for part in text_terms(body):
            length += len(part)
            self.hits.extend(filter(None, map(vocabulary.get, part)))
        if length:
            self.doc_ids.append(doc_id)
            self.lengths.append(length)
            self.found.append(len(self.hits) - before)

    def full(self) -> bool:
        return len(self.doc_ids) >= CHUNK_DOCS or len(self.hits) >= CHUNK_HITS

    def row(self) -> dict[str, list]:
        n = max(1, len(self.doc_ids))
        owner = np.repeat(np.arange(len(self.doc_ids)), self.found)
        keys, tfs = np.unique(np.array(self.hits, np.int64) * n + owner, return_counts=True)
        terms, dfs = np.unique(keys // n, return_counts=True)
        return {"n_docs": [len(self.doc_ids)], "n_terms": [sum(self.lengths)], "terms": [terms.tolist()],
                "dfs": [dfs.tolist()], "doc_ids": [self.doc_ids], "lengths": [np.array(self.lengths, np.int64).tobytes()],
                "docs": [(keys % n).astype(np.int32).tobytes()], "tfs": [tfs.astype(np.int64).tobytes()]}


def index_chunks(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Chunk rows over all documents; a term is known by its place in ``terms``, from 1."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def work(batches):
        vocabulary = {t: i for i, t in enumerate(shared.value, 1)}
        chunk = ChunkBuilder()
        for b in batches:
            for doc_id, body in zip(b["id"], b["body"], strict=True):
                chunk.add(doc_id, body, vocabulary)
                if chunk.full():
                    yield chunk.row()
                    chunk = ChunkBuilder()
        if chunk.doc_ids:
            yield chunk.row()
    return materialize(map_batches(_bodies(docs, "doc_id"), ["id", "body"], CHUNK, work), "search_index")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class ImpactList:
    """The documents of a term in a chunk, by descending impact, with direct access by document."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray):
        order = np.argsort(-impacts, kind="stable")
        self.docs, self.impacts = docs[order], impacts[order]
        self.by_doc, self.place = docs, np.empty(len(docs), np.int64)
        self.place[order] = np.arange(len(docs))

    def positions(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the documents are in the list, their positions)."""
        at = np.minimum(np.searchsorted(self.by_doc, docs), len(self.by_doc) - 1)
        inside = np.flatnonzero(self.by_doc[at] == docs)
        return inside, self.place[at[inside]]


class ChunkIndex:
    """Impact lists of one chunk."""

    def __init__(self, chunk: dict, weights: dict[int, int], n_docs: int, n_terms: int):
        lengths = np.frombuffer(chunk["lengths"], np.int64)
        self.doc_ids, self.weights = chunk["doc_ids"], weights
        self.scale = 100 - 25 + (25 * lengths * n_docs) // n_terms
        self.docs, self.tfs = np.frombuffer(chunk["docs"], np.int32), np.frombuffer(chunk["tfs"], np.int64)
        ends = np.cumsum(chunk["dfs"]).tolist()
        self.spans = {t: (e - d, e) for t, d, e in zip(chunk["terms"], chunk["dfs"], ends, strict=True)}
        self.lists: dict[int, ImpactList | None] = {}

    def impact_list(self, term: int) -> ImpactList | None:
        """None if no document of the chunk holds the term, or its weight is zero."""
        if term not in self.lists:
            span, weight = self.spans.get(term), self.weights.get(term, 0)
            if span is None or not weight:
                self.lists[term] = None
            else:
                docs, tf = self.docs[span[0]:span[1]], self.tfs[span[0]:span[1]]
                self.lists[term] = ImpactList(docs, weight * ((1000000000 * tf) // (1000 * tf + 12 * self.scale[docs])))
        return self.lists[term]


def best_positions(lists: list[tuple[ImpactList, int]], n_docs: int, k: int, top: list, doc_ids: list) -> tuple[list, int]:
    """The k best of ``top`` and the chunk's documents, and the number of positions read.

    ``lists`` are (impact list, repeats of the term in the item); ``top`` holds
    sort keys (-score, id is NULL, id).
    """
    seen = [np.zeros(len(ls.docs) + 1, bool) for ls, _ in lists]   # a last position that stays unseen ends every run
    best = [0] * len(lists)
    scored = np.zeros(n_docs, bool)
    depth, step = 0, STEP
    while lists:
        met = np.concatenate([ls.docs[depth:depth + step] for ls, _ in lists])
        fresh = np.unique(met[~scored[met]])
        scored[fresh] = True
        scores = np.zeros(len(fresh), np.int64)
        for (ls, repeats), marks in zip(lists, seen, strict=True):
            inside, at = ls.positions(fresh)
            scores[inside] += repeats * ls.impacts[at]
            marks[at] = True
        kth = -top[k - 1][0] if len(top) >= k else 0
        good = np.flatnonzero((scores >= kth) & (scores > 0))
        if len(good) > k:
            good = good[scores[good] >= np.partition(scores[good], -k)[-k]]
        ids = [doc_ids[d] for d in fresh[good].tolist()]
        top = sorted([*top, *((-s, i is None, i or 0) for s, i in zip(scores[good].tolist(), ids, strict=True))])[:k]
        depth, step = depth + step, 2 * step
        bound = 0
        for j, ((ls, repeats), marks) in enumerate(zip(lists, seen, strict=True)):
            best[j] += int(np.argmin(marks[best[j]:]))
            if best[j] < len(ls.docs):
                bound += repeats * int(ls.impacts[best[j]])
        if bound == 0 or (len(top) >= k and bound < -top[k - 1][0]):
            break
    return top, depth


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item row."""
    spark = docs.sparkSession
    queries = item_terms(items)
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_TERMS))
    found = [_search_block(docs, queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block), k)
             for block in range(blocks)]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in (["row", "part"], ["row"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return rows.select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = [(r.row, r.item_id, [bytes(t) for t in r.terms]) for r in queries.collect()]
    terms = sorted({t for _, _, ts in rows for t in ts})
    known = {t: i for i, t in enumerate(terms, 1)}
    chunks = index_chunks(docs, terms)
    n_docs, n_terms = chunks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    counts = chunks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("p")).groupBy("p.terms").agg(F.sum("p.dfs")).collect()
    weights = {t: term_weight(n_docs, df) for t, df in counts}
    plans = []
    for row, item_id, ts in rows:
        repeats: dict[int, int] = {}
        for t in ts:
            repeats[known[t]] = repeats.get(known[t], 0) + 1
        plans.append((row, item_id, sorted(repeats.items())))
    shared = spark.sparkContext.broadcast((plans, weights, n_docs, n_terms))

    def work(batches):
        plans, weights, n_docs, n_terms = shared.value
        tops: list[list] = [[] for _ in plans]
        for b in batches:
            for i in range(len(b["doc_ids"])):
                index = ChunkIndex({name: b[name][i] for name in b}, weights, n_docs, n_terms)
                for j, (_, _, repeats) in enumerate(plans):
                    lists = [(ls, n) for t, n in repeats if (ls := index.impact_list(t)) is not None]
                    tops[j], _ = best_positions(lists, len(index.doc_ids), k, tops[j], index.doc_ids)
        for (row, item_id, _), top in zip(plans, tops, strict=True):
            yield {"row": [row] * len(top), "item_id": [item_id] * len(top),
                   "doc_id": [None if null else i for _, null, i in top], "score": [-s for s, _, _ in top]}
    names = ["terms", "dfs", "doc_ids", "lengths", "docs", "tfs"]
    ranked = map_batches(chunks, names, "row long, item_id long, doc_id long, score long", work)
    return ranked.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE)))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the 20 best documents of each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
o AS (SELECT r, unnest(ts) AS term FROM d),
p AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM o GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM p, c GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 100 - 25 + ((25 * len(ts) * n_docs) // n_terms) AS scale FROM d, c WHERE len(ts) > 0),
b AS MATERIALIZED (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
i AS (SELECT q, item_id, unnest(ts) AS term FROM b),
j AS (SELECT q, item_id, term, count(*) AS n FROM i GROUP BY q, item_id, term),
s AS (SELECT q, item_id, doc_id, r,
             CAST(sum(n * weight * ((1000000000 * tf) // (1000 * tf + 12 * scale))) AS BIGINT) AS score
      FROM j JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY q, item_id, doc_id, r),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""
