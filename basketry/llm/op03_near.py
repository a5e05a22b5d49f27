"""Near-duplicate components by a chosen-path similarity join.

1. A text's set is its distinct 5-word shingles. Texts with equal sets form one
   class (a partial aggregation, so a huge group of copies costs one row a task).
2. Each class gets 64 minwise tokens, one for each of 64 hash functions; two
   sets agree on a token with probability equal to their similarity. One bit of
   each token makes a 64-bit sketch, four bits of each a 256-bit one.
3. Twelve independent trees start from one minwise token each: classes with the
   same token meet in a node. Every class is compared with its node's pivot, the
   same one in nodes of the same classes; sizes and sketches weed out pairs far
   below the threshold. The candidates are confirmed on the full shingle sets,
   and the links join classes to components.
4. Nodes of up to ``SMALL`` classes that hold several components are compared
   exhaustively by a join, each class with those of other components.
5. A large node whose classes are all connected by now is done, and so is one
   whose members all lie in a larger one that is compared exhaustively. What is left
   open is compared exhaustively, block against block: first on the sketches, which
   name the classes that have a possible partner in another component, then those
   classes on the full sets. A task gets two blocks of bounded size and returns
   only ids or the links that join components, never the pairs. Nodes above
   ``BRANCH`` classes branch first: a class goes on to a child node for each of
   two further tokens that the node's hash selects, until the nodes are small
   enough or ``MAX_DEPTH`` is reached; the blocks take nodes of any size. A node
   inside a branching one stays, because branching can part a pair.

A pair at the threshold of 0.75 misses all twelve first nodes with probability
0.25 ** 12. A node that branches at every level parts it with probability 0.11,
so the bound is 0.33 ** 12 (2e-6) if all its nodes do; a true pair fails either
sketch test at more than five standard deviations. Components need no list of all pairs: links that join what is
already connected are not looked for.

Defined results: a text without words (or NULL) has an empty set, is linked with
nothing and is its own component; rows with equal sets are linked; repeated rows
share their component; a row without doc_id takes its class's component_id and
links nothing by itself; an empty table gives an empty result; other columns
are ignored. All sets are those of whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import content_digest, few_enough, map_batches, materialize, table, without
from basketry.llm.components import components
from basketry.llm.shingles import shingle_set

TOKENS = 64          # minwise tokens of a set
TREES = 12           # independent trees: root tokens
BRANCHES = 2         # further tokens that a large node selects
SMALL = 64           # classes in a node that is compared by a join on the node
HOT = 1 << 10        # classes in a node above which its rows are not shuffled to it
BRANCH = 1 << 13     # classes in a node above which it branches before it is compared in blocks
MAX_DEPTH = 8        # levels at most
BLOCK = 1 << 11      # classes in a block, on average
BLOCK_SHINGLES = 1 << 20  # shingles in a block, on average (8 MB)
COLUMNS = 512        # shingles whose 0/1 matrix is held at once
RARE = 8             # sets of a block pair that share a shingle, up to which they are paired one by one
SKETCH_BITS = 22     # bits in which the sketches of a linked pair may differ (8 expected at similarity 0.75)
WIDE_DIFFER = 33     # tokens whose four bits may differ in a linked pair (15 expected at similarity 0.75)
WIDE_BLOCK = 1 << 12  # classes in a block that is compared on sketches, on average
SIMILARITY = 75      # percent

_rng = np.random.default_rng(20240601)
_TURN = _rng.integers(1 << 63, size=TOKENS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_FLIP = _rng.integers(1 << 63, size=TOKENS, dtype=np.uint64)
_POWERS = np.uint64(1) << np.arange(TOKENS, dtype=np.uint64)
_CHUNK = 1024
_NIBBLES = np.uint64(1) << np.arange(0, 64, 4, dtype=np.uint64)
_LOWEST = 0x1111111111111111  # the lowest bit of each four


def minwise_tokens(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        part = shingles[i:i + _CHUNK]
        np.minimum(best, ((part[None, :] ^ _FLIP[:, None]) * _TURN[:, None]).min(axis=1), out=best)
    return best


def _sketch_batches(batches):
    for b in batches:
        out = {"doc_id": b["doc_id"], "digest": b["digest"], "n_shingles": [], "set_key": [], "tokens": [], "bits": [], "wide": []}
        for text in b["text"]:
            s = shingle_set(text)
            out["n_shingles"].append(len(s))
            if len(s):
                tokens = minwise_tokens(s)
                bits = ((tokens >> np.uint64(17) & np.uint64(1)) * _POWERS).sum(dtype=np.uint64)
                out["set_key"].append(xxhash.xxh3_128_digest(s.tobytes()))
                out["tokens"].append(tokens.view(np.int64))
                out["bits"].append(int(bits.view(np.int64)))
                four = (tokens >> np.uint64(20) & np.uint64(15)).reshape(4, 16) * _NIBBLES
                out["wide"].append(four.sum(axis=1, dtype=np.uint64).view(np.int64))
            else:
                for name in ("set_key", "tokens", "bits", "wide"):
                    out[name].append(None)
        yield out


def _set_batches(batches):
    for b in batches:
        sets = [shingle_set(t) for t in b["text"]]
        yield {"set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
               "shingles": [s.view(np.int64) for s in sets]}


def _close(left: str, right: str):
    return F.bit_count(F.col(left).bitwiseXOR(F.col(right))) <= SKETCH_BITS


def _close_wide(left: str, right: str):
    """Few enough tokens differ in their four bits."""
    differ = F.lit(0)
    for k in range(4):
        x = F.get(left, F.lit(k)).bitwiseXOR(F.get(right, F.lit(k)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(_LOWEST)))
    return differ <= WIDE_DIFFER


def _alike_in_size(left: str, right: str):
    """Sets whose sizes alone rule a link out are no candidates."""
    return 100 * F.least(left, right) >= SIMILARITY * F.greatest(left, right)


def _exhaustive(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """Candidate pairs of small nodes: those of different components whose sizes and sketches are close."""
    rooted = rows.select("node", "id", "bits", "n").join(joined, "id", "left").withColumn(
        "root", F.coalesce("root", "id"))
    open_nodes = rooted.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low <> high").select("node")
    rows = materialize(rooted.join(open_nodes, "node", "left_semi"), "near_open")
    cols = ["node", "id", "bits", "n", "root"]
    a = rows.select(*[F.col(c).alias(f"a_{c}") for c in cols])
    b = rows.select(*[F.col(c).alias(f"b_{c}") for c in cols])
    near = ((F.col("a_node") == F.col("b_node")) & (F.col("a_id") < F.col("b_id")) & _close("a_bits", "b_bits")
            & (F.col("a_root") != F.col("b_root")) & _alike_in_size("a_n", "b_n"))
    return a.join(b, near).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))


def _stars(rows: DataFrame) -> DataFrame:
    """Candidate pairs of each class with its node's pivot."""
    near = _close("bits", "pivot_bits") & _alike_in_size("n", "pivot_n")
    return rows.where((F.col("id") != F.col("pivot_id")) & near).select(
        F.least("id", "pivot_id").alias("a"), F.greatest("id", "pivot_id").alias("b"))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes with several classes, with the node's size and pivot.

    There are at most ``TREES`` / ``HOT`` hot nodes a class, so their rows meet them without being shuffled.
    """
    pivot = F.min(F.struct(F.xxhash64("id").alias("rank"), "id", "bits", "n")).alias("pivot")
    nodes = materialize(rows.groupBy("node").agg(F.count("*").alias("size"), pivot).where("size > 1").select(
        "node", "size", F.col("pivot.id").alias("pivot_id"), F.col("pivot.bits").alias("pivot_bits"),
        F.col("pivot.n").alias("pivot_n")), "near_sizes")
    hot = few_enough(materialize(nodes.where(F.col("size") > HOT), "near_hot"))
    return rows.join(hot, "node").unionByName(
        rows.join(hot.select("node"), "node", "left_anti").join(nodes.where(F.col("size") <= HOT), "node"))


def _still_open(rows: DataFrame, joined: DataFrame, last: bool = False) -> DataFrame:
    """Rows (node, id, n, root, size, total) of the nodes that hold several components and must be looked at.

    A node that is compared in blocks (up to ``BRANCH`` classes, on the ``last`` level any) would compare nothing new
    if one larger such node has all its members. A branching node loses pairs, so it covers nothing alone: one is left
    out only if the same ``TREES`` larger branching nodes have all its members.
    """
    rooted = rows.select("node", "id", "n").join(joined, "id", "left").withColumn("root", F.coalesce("root", "id"))
    nodes = rooted.groupBy("node").agg(
        F.count("*").alias("size"), F.sum("n").alias("total"), F.min("root").alias("low"),
        F.max("root").alias("high")).where("low <> high").select("node", "size", "total")
    held = materialize(rooted.join(few_enough(materialize(nodes, "near_sizes")), "node"), "near_open")
    branching = F.lit(False) if last else F.col("size") > BRANCH
    mine = held.groupBy("id", branching.alias("branching")).agg(
        F.sort_array(F.collect_list(F.struct("size", "total", "node")), asc=False)["node"].alias("nodes"))
    covers = F.slice("nodes", 1, F.when(F.col("branching"), TREES).otherwise(1))
    needed = mine.select(F.explode("nodes").alias("node"), covers.alias("covers")).groupBy("node").agg(
        F.min(F.xxhash64("covers")).alias("low"), F.max(F.xxhash64("covers")).alias("high"),
        F.bool_or(F.array_contains("covers", F.col("node"))).alias("covering")).where(
        "low <> high or covering").select("node")
    return materialize(held.join(few_enough(materialize(needed, "near_needed")), "node", "left_semi"), "near_open")


def _children(rows: DataFrame, classes: DataFrame, depth: int) -> DataFrame:
    """The next level of large nodes: classes by two tokens that the node's hash selects."""
    picks = F.array(*[F.pmod(F.xxhash64("node", F.lit(depth * BRANCHES + k)), F.lit(TOKENS)).cast("int")
                      for k in range(BRANCHES)])
    child = rows.select("node", "id", "n").join(classes.select("id", "tokens"), "id").withColumn(
        "pick", F.explode(F.array_distinct(picks)))
    return child.select("id", "n", F.xxhash64("node", "pick", F.get("tokens", F.col("pick"))).alias("node"))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right`` (of ``left`` itself if that is None).

    Shingles in few sets are counted pair by pair, those in many as products of 0/1 matrices.
    """
    sets = left if right is None else [*left, *right]
    n, split = len(sets), len(left)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(flat)))
    # only left against right is counted: an owner comes before another one of the same shingle if its index is smaller
    start, width = (0, n) if right is None else (split, n - split)
    counts = np.zeros(split * width, np.float32)
    for k in range(2, RARE + 1):
        holders = owner[first[size == k][:, None] + np.arange(k)[None, :]]
        for i in range(k):
            for j in range(i + 1, k):
                cross = (holders[:, i] < split) & (holders[:, j] >= start)
                np.add.at(counts, holders[cross, i] * width + holders[cross, j] - start, np.float32(1))
    counts = counts.reshape(split, width)
    common = np.flatnonzero(size > RARE)
    for at in range(0, len(common), COLUMNS):
        part = common[at:at + COLUMNS]
        column = np.repeat(np.arange(len(part)), size[part])
        rows = owner[np.concatenate([np.arange(first[c], first[c] + size[c]) for c in part])]
        holds = np.zeros((n, len(part)), np.float32)
        holds[rows, column] = 1.0
        counts += holds[:split] @ holds[start:].T
    # pair by pair, only the smaller index leads; products hold both directions
    return np.maximum(counts, counts.T) if right is None else counts


def _block_links(rows: pa.Table) -> pa.Table:
    """Links of two blocks that join different components; each joins two parts that were apart until then."""
    ids, roots = rows.column("id").to_pylist(), rows.column("root").to_pylist()
    side = np.array(rows.column("side").to_pylist())
    sets = [np.asarray(x.values) for x in rows.column("shingles").combine_chunks()]
    same = not (side == 1).any()
    left = np.flatnonzero(side != 1)
    right = left if same else np.flatnonzero(side == 1)
    shared = shared_counts([sets[i] for i in left], None if same else [sets[i] for i in right])
    sizes = np.array([len(s) for s in sets], np.float64)
    named = np.array(roots)
    close = []
    for at in range(0, len(left), 256):
        part, both = left[at:at + 256], shared[at:at + 256].astype(np.float64)
        either = sizes[part][:, None] + sizes[right][None, :] - both
        found = (100 * both >= SIMILARITY * either) & (named[part][:, None] != named[right][None, :])
        close.append(np.argwhere(found) + (at, 0))
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in np.concatenate([np.zeros((0, 2), np.int64), *close]):
        a, b = left[i], right[j]
        x, y = find(roots[a]), find(roots[b])
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _possible(rows: pa.Table) -> pa.Table:
    """(node, id) of two blocks' classes that have a class of another component and of close size and sketch there."""
    id_, root, n, side = (rows.column(c).to_numpy() for c in ("id", "root", "n", "side"))
    wide = rows.column("wide").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, 4)
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    found = np.zeros(len(id_), bool)
    for at in range(0, len(left), 256):
        part = left[at:at + 256]
        differ = np.zeros((len(part), len(right)), np.uint8)
        for k in range(4):
            x = wide[part, k][:, None] ^ wide[right, k][None, :]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            differ += np.bitwise_count(x & np.uint64(_LOWEST))
        small, big = np.minimum(n[part][:, None], n[right]), np.maximum(n[part][:, None], n[right])
        near = (differ <= WIDE_DIFFER) & (root[part][:, None] != root[right]) & (100 * small >= SIMILARITY * big)
        found[part] |= near.any(axis=1)
        found[right] |= near.any(axis=0)
    return pa.table({"node": rows.column("node").filter(pa.array(found)), "id": pa.array(id_[found], pa.int64())})


def _dealt(rows: DataFrame, blocks, *columns: str) -> DataFrame:
    """The rows of each node in ``blocks`` blocks, once for every pair of them: (pair, side, columns)."""
    marked = rows.withColumn("blocks", blocks.cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = marked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select(pair.alias("pair"), F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), *columns)


def _in_blocks(rows: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the components of nodes of any size, block against block, each pair of blocks a group.

    The sketches go first: only classes with a possible partner in another component take their sets along.
    """
    sketched = rows.join(classes.select("id", "wide"), "id")
    possible = _dealt(sketched, F.ceil(F.col("size") / WIDE_BLOCK), "node", "id", "root", "n", "wide").groupBy(
        "pair").applyInArrow(_possible, "node long, id long").distinct()
    left = materialize(rows.select("node", "id", "n", "root").join(possible, ["node", "id"], "left_semi"),
                       "near_possible")
    sizes = materialize(left.groupBy("node").agg(F.count("*").alias("size"), F.sum("n").alias("total")), "near_sizes")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
    sets = _sets_of(left.select("id").distinct(), docs, classes)
    return _dealt(left.join(few_enough(sizes), "node"), blocks, "id", "root").join(sets, "id").groupBy(
        "pair").applyInArrow(_block_links, "a long, b long")


def _sets_of(ids: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, shingles) of some classes, made from their texts again and written to the shared folder."""
    named = materialize(ids.join(classes.select("id", "set_key", "doc_id"), "id"), "near_named")
    # as many ids as there are near copies: joined by shuffle at every size
    texts = docs.select("doc_id", "text").join(named.select("doc_id"), "doc_id", "left_semi")
    sets = map_batches(texts, ["text"], "set_key binary, shingles array<long>", _set_batches)
    return materialize(sets.join(named.select("id", "set_key"), "set_key").dropDuplicates(["set_key"])
                       .select("id", "shingles"), "near_sets")


def _confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) whose full shingle sets reach the similarity."""
    wide = classes.select("id", "wide")
    pairs = materialize(pairs.distinct().join(wide.toDF("a", "a_wide"), "a").join(wide.toDF("b", "b_wide"), "b").where(
        _close_wide("a_wide", "b_wide")).select("a", "b"), "near_candidates")
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, classes)
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("b_set"))
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return pairs.join(left, "a").join(right, "b").where(
        100 * shared >= SIMILARITY * (F.size("a_set") + F.size("b_set") - shared)).select("a", "b")


def near_classes(docs: DataFrame, digest: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows have doc_id, n_shingles, set_key, digest; classes have set_key, id and root (an id)."""
    digest = F.lit(None).cast("binary") if digest is None else digest
    marked = docs.select("doc_id", "text", digest.alias("digest"))
    rows = materialize(map_batches(marked, ["doc_id", "text", "digest"], "doc_id long, digest binary, n_shingles long, set_key binary, "
                                   "tokens array<long>, bits long, wide array<long>", _sketch_batches), "near_sketches")
    classes = rows.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("n"), F.any_value("tokens").alias("tokens"),
        F.any_value("bits").alias("bits"), F.any_value("wide").alias("wide"))
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "near_classes")

    roots = F.array(*[F.xxhash64(F.lit(t), F.get("tokens", F.lit(t))) for t in range(TREES)])
    first = materialize(_sized(classes.where("doc_id is not null").select(
        "id", "bits", "n", F.explode(roots).alias("node"))), "near_nodes")
    small, large = first.where(F.col("size") <= SMALL), first.where(F.col("size") > SMALL)
    links = materialize(_confirm(_stars(first), docs, classes), "near_links")
    joined = components(links)
    more = materialize(_confirm(_exhaustive(small, joined), docs, classes), "near_links")

    waiting = _still_open(large, joined)
    nodes = waiting.where(F.col("size") <= BRANCH)
    for depth in range(2, MAX_DEPTH + 1):
        above = waiting.where(F.col("size") > BRANCH)
        if above.isEmpty():
            break
        waiting = _still_open(_children(above, classes, depth), joined, depth == MAX_DEPTH)
        nodes = nodes.unionByName(waiting if depth == MAX_DEPTH else waiting.where(F.col("size") <= BRANCH))
    if not nodes.isEmpty():
        more = more.unionByName(materialize(_in_blocks(nodes, docs, classes), "near_links"))
    if not more.isEmpty():
        joined = components(links.unionByName(more))
    return rows, classes.select("set_key", "id", "doc_id").join(joined, "id", "left").withColumn(
        "root", F.coalesce("root", "id"))


def near_components(docs: DataFrame, digest: Column | None = None) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id of the component), kept, and its ``digest``."""
    rows, classes = near_classes(docs, digest)
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = materialize(classes.join(least, "root").select("set_key", "component_id"), "near_named")
    out = rows.select("doc_id", "n_shingles", "set_key", "digest").join(named, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "digest")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component those with its smallest doc_id, told by doc_id and text."""
    digest = content_digest("text")
    dropped = near_components(docs, digest).where("not kept").select("doc_id", "digest").distinct()
    return without(docs, materialize(dropped, "near_dropped"), digest)


def op3_minhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: set size, component and kept flag of every document."""
    return near_components(table(spark, sf_dir, "documents")).drop("digest")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END
         AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * k >= 75 * (na.n_shingles + nb.n_shingles - k)),
both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM n
      UNION SELECT r.doc_id, g.b FROM r JOIN both_ways g ON g.a = r.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN c ON c.doc_id = n.doc_id
"""
