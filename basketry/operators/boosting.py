"""Second-order boosted regression trees by distributed histograms, and models as tables.

Upstream fits boosted trees with the defaults of its library: squared error, step
0.3, depth 6, L2 term 1 on the leaf weights, at least one row a child, first score
0.5, 50 and then 70 rounds. The fit here follows that definition on binned columns:

- **Bin edges.** A feature with few distinct values is cut between all of them; any
  other at its quantiles (``percentile_approx``, one aggregate for all such features).
  Bin 0 holds missing values (NULL or NaN).
- **One aggregate per level.** A task adds up the gradients and rows per (node,
  feature, bin) of its blocks, and ``MERGERS`` further tasks merge the sums, each those
  of a run of features. Such a task holds at most nodes x features x bins sums whatever the size of
  the data, so the best split of each node is chosen on them directly: for every cut
  and for missing values going left or right, the gain
  ``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)``. Ties go to the first feature, the
  lowest cut, then missing values going left. The driver gets one split per node and
  run of features, never sums.
- **Exact sums.** Gradients are summed as integers (2^-20 steps), so neither the
  order of rows nor their partitioning changes a tree.
- The running score of each row is kept with its bins in persisted blocks of arrays
  that are checkpointed to the shared folder every ``checkpoint_interval`` rounds,
  which bounds what a lost executor costs.

A fitted model is rows: one per tree node. Scoring walks them by one column
function over the original columns; saving and loading them as a table changes
no bit of a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.config import LABEL_COL, ModelParams
from basketry.operators.model import SCORE_COL, feature_columns
from basketry.session import ensure_checkpoint_dir, materialize, remove_path, ship_package, written_paths

BINS = 64               # bins of a feature, that of missing values included
FIRST_SCORE = 0.5
L2 = 1.0
MIN_CHILD = 1.0         # rows of a child at least (the hessian of a squared error is 1)
MIN_GAIN = 1e-6
STEPS = 1 << 20         # gradients are integers of 2**-20
MERGERS = 4             # tasks that merge the sums of a level, each those of a run of features
PACKED_ROWS = 1 << 14   # rows of a block up to which ...
ROW_BITS = 38
ROW = float(1 << ROW_BITS)  # ... one sum holds rows (in multiples of this) and gradients
PART_BLOCKS = 200       # blocks of a partition of the persisted blocks at most

MODEL_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType(), False),          # from 1; 0 is the first score
    T.StructField("node", T.IntegerType(), False),          # root 1, children of n: 2n and 2n + 1
    T.StructField("feature", T.StringType(), True),         # NULL for a leaf
    T.StructField("cut", T.DoubleType(), True),             # left if value <= cut
    T.StructField("missing_left", T.BooleanType(), True),
    T.StructField("left", T.IntegerType(), True),
    T.StructField("right", T.IntegerType(), True),
    T.StructField("leaf", T.DoubleType(), True),            # weight of a leaf, step included
    T.StructField("gain", T.DoubleType(), True),
    T.StructField("n_rows", T.LongType(), True),
])


@dataclass(frozen=True)
class Node:
    tree: int
    node: int
    feature: str | None = None
    cut: float | None = None
    missing_left: bool | None = None
    leaf: float | None = None
    gain: float | None = None
    n_rows: int = 0

    def row(self) -> tuple:
        inner = self.feature is not None
        return (self.tree, self.node, self.feature, self.cut, self.missing_left, 2 * self.node if inner else None,
                2 * self.node + 1 if inner else None, self.leaf, self.gain, self.n_rows)


@dataclass(frozen=True)
class TreeModel:
    """Nodes by tree; ``first`` is the score before the first tree."""

    trees: tuple[tuple[Node, ...], ...]
    first: float = FIRST_SCORE


def _value(name: str, dtype: T.DataType) -> str:
    """A feature as DOUBLE, NULL if missing."""
    quoted = "`" + name.replace("`", "``") + "`"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"nullif(cast({quoted} as double), double('NaN'))"
    return f"cast({quoted} as double)"


def _distinct_values(batches):
    """``f, v``: the distinct values of each feature, those of a task once."""
    seen: dict[int, np.ndarray] = {}
    for b in batches:
        for f in range(b.num_columns):
            v = np.unique(b.column(f).drop_null().to_numpy() + 0.0)     # -0.0 is 0.0
            seen[f] = np.union1d(seen[f], v) if f in seen else v
    for f, v in seen.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), f, np.int32)), pa.array(v)], ["f", "v"])


def bin_edges(df: DataFrame, cols: list[str], bins: int = BINS) -> list[list[float]]:
    """Cuts of each feature, ascending: between all distinct values if they are few, else at quantiles.

    Quantiles cost most by far, so they are asked for only where the values are not few.
    """
    most = bins - 2  # bin 0 is for missing values, and k cuts make k + 1 bins
    values = [F.expr(_value(c, df.schema[c].dataType)).alias(f"v{i}") for i, c in enumerate(cols)]
    wide = df.select(*values)
    about = wide.agg(*[F.approx_count_distinct(f"v{i}").alias(f"n{i}") for i in range(len(cols))]).first()
    few = [i for i in range(len(cols)) if about[f"n{i}"] <= 2 * most]
    distinct: dict[int, list[float]] = {i: [] for i in few}
    if few:
        # each task sends a feature's distinct values once; the estimate above bounds them
        sent = wide.select(*[f"v{i}" for i in few]).mapInArrow(_distinct_values, "f int, v double")
        for f, v in sent.distinct().collect():
            distinct[few[f]].append(v)
    edges = {i: sorted(own)[:-1] for i, own in distinct.items() if len(own) <= most + 1}
    many = [i for i in range(len(cols)) if i not in edges]
    if many:
        shares = [(i + 1) / (most + 1) for i in range(most)]
        found = wide.agg(*[F.percentile_approx(f"v{i}", shares, 10000).alias(f"q{i}") for i in many],
                         *[F.max(f"v{i}").alias(f"m{i}") for i in many]).first()
        edges |= {i: [q for q in sorted(set(found[f"q{i}"] or [])) if q < found[f"m{i}"]] for i in many}
    return [edges[i] for i in range(len(cols))]


def binned(df: DataFrame, cols: list[str], edges: list[list[float]], label: str) -> DataFrame:
    """``df`` as rows of a block each: ``bins`` (a byte a row, feature after feature), ``y`` and, if ``df`` has it, the score so far."""
    kept = [F.col(c).cast("double").alias(f"k{i}") for i, c in enumerate([label] + [SCORE_COL] * (SCORE_COL in df.columns))]
    values = [F.expr(_value(c, df.schema[c].dataType)).alias(f"v{i}") for i, c in enumerate(cols)]
    cuts, n = [np.array(e) for e in edges], len(kept)

    def pack(batches):
        for b in batches:
            bins = np.empty((len(cuts), b.num_rows), np.uint8)
            for f, own in enumerate(cuts):
                v = b.column(n + f).to_numpy(zero_copy_only=False)
                # 1 + the number of cuts below the value: a cut itself belongs to the bin on its left
                bins[f] = np.where(np.isnan(v), 0, 1 + np.searchsorted(own, v))
            parts = [bins.tobytes(), *[b.column(i).to_numpy().tobytes() for i in range(n)]]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names)
    names = ["bins", "y", "score"][:n + 1]
    return df.select(*kept, *values).mapInArrow(pack, ", ".join(f"{name} binary" for name in names))


def _steps(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each node the feature that it asks for, and by node and bin the node that comes next (itself if it is not split).

    A node's code is ((feature * 128) + bin of the cut) * 2 + missing goes left, or -1 if it is not split.
    """
    node, code, b = np.arange(len(codes))[:, None], codes[:, None], np.arange(BINS)
    right = np.where(b == 0, 1 - (code & 1), b > ((code >> 1) & 127))
    return np.maximum(codes, 0) >> 8, np.where(code < 0, node, 2 * node + right).reshape(-1)


def node_of(bins: np.ndarray, codes: np.ndarray, levels: int) -> np.ndarray:
    """Node of each row after ``levels`` steps from the root."""
    feature, after = _steps(codes)
    flat, node = np.ascontiguousarray(bins.T).reshape(-1), np.ones(len(bins), np.int64)
    start, rows = feature * len(bins), np.arange(len(bins))
    for _ in range(levels):
        node = after.take(node * BINS + flat.take(start.take(node) + rows))
    return node


Block = tuple[np.ndarray, np.ndarray, np.ndarray]   # bins (rows x features, features one after the other), labels, scores so far


def _blocks(rows: DataFrame, used: list[int], start: TreeModel, codes: list[np.ndarray]) -> RDD:
    """The binned rows as blocks of arrays of the ``used`` features, scored by ``start`` if they have no scores. The rounds
    of a fit are hundreds of small aggregates over the same persisted blocks, which need no query plan each. Blocks are
    dealt to few even partitions, because each level is a task a partition."""
    weights = [_leaf_weights(t, c) for t, c in zip(start.trees, codes, strict=True)]

    def arrays(row) -> Block:
        y = np.frombuffer(row.y, np.float64)
        bins = np.frombuffer(row.bins, np.uint8).reshape(-1, len(y))[used].T
        if "score" in row:
            return bins, y, np.frombuffer(row.score, np.float64)
        scores = np.full(len(y), start.first)
        for c, w in zip(codes, weights, strict=True):
            scores = scores + w[node_of(bins, c, _depth(c))]
        return bins, y, scores
    width = rows.sparkSession.sparkContext.defaultParallelism
    parts = width * max(1, math.ceil(rows.count() / (width * PART_BLOCKS)))
    dealt = rows.rdd.mapPartitionsWithIndex(lambda p, own: (((p + i) % parts, arrays(r)) for i, r in enumerate(own)))
    return dealt.partitionBy(parts, _itself).values()


def _itself(key: int) -> int:
    return key


def _depth(codes: np.ndarray) -> int:
    return len(codes).bit_length() - 2


def _leaf_weights(nodes: tuple[Node, ...], codes: np.ndarray) -> np.ndarray:
    weights = np.zeros(len(codes))
    for n in nodes:
        weights[n.node] = n.leaf or 0.0
    return weights


def _codes_of(model: TreeModel, cols: list[str], edges: list[list[float]]) -> list[np.ndarray] | None:
    """Walking codes of a model's trees; None if one of its cuts is no edge."""
    place, out = {c: f for f, c in enumerate(cols)}, []
    for tree in model.trees:
        codes = np.full(1 << (max(n.node for n in tree).bit_length()), -1)
        for n in tree:
            if n.feature is None:
                continue
            f = place.get(n.feature, -1)
            if f < 0 or n.cut not in edges[f]:
                return None
            codes[n.node] = (f * 128 + edges[f].index(n.cut) + 1) * 2 + int(n.missing_left)
        out.append(codes)
    return out


def _sums(own, codes: np.ndarray, level: int, widths: np.ndarray) -> np.ndarray:
    """Gradient and row sums of blocks per (node of the level, bin), the bins of all features side by side."""
    first, size = 1 << level, BINS << level
    sums = np.zeros((2, len(widths), size), np.int64)
    packs, used = np.zeros((len(widths), size), np.int64), 0.0   # sums of packed blocks, and what their gradients come to at most

    def unpack():
        n = (packs + (1 << ROW_BITS - 1)) >> ROW_BITS
        sums[0] += packs - (n << ROW_BITS)
        sums[1] += n
        packs[:] = 0

    for bins, y, scores in own:
        cells, place, g = bins.T, node_of(bins, codes, level) - first, np.rint((scores - y) * STEPS)
        live = np.flatnonzero(place >= 0)
        if not len(live):
            continue
        if len(live) < len(g):
            cells, place, g = cells.take(live, axis=1), place.take(live), g.take(live)
        place *= BINS
        # a row adds ROW and its gradient to one sum, which tells both
        largest = np.abs(g).max() * len(g)
        packed = len(g) < PACKED_ROWS and largest < ROW / 2
        if packed:
            if used + largest >= ROW / 2:
                unpack()
                used = 0.0
            used += largest
            rows = g + ROW
        # feature by feature: few sums at a time stay in the processor's cache
        for f in range(len(widths)):
            at = place + cells[f]
            # float sums of one block of integers are exact: below 2**53
            if packed:
                packs[f] += np.bincount(at, rows, size).astype(np.int64)
            else:
                sums[0, f] += np.bincount(at, g, size).astype(np.int64)
                sums[1, f] += np.bincount(at, minlength=size)
    unpack()
    sums = sums.reshape(2, len(widths), 1 << level, BINS)
    return np.concatenate([sums[:, f, :, :w] for f, w in enumerate(widths.tolist())], axis=2)


def _level_splits(blocks: RDD, codes: np.ndarray, level: int,
                  n_cuts: np.ndarray) -> tuple[list[tuple | None], list[tuple[int, int]]]:
    """Best split and (gradient, row) sums of each node of a level.

    The sums of a task go to the merging tasks in runs of features; each of these merges its
    features' sums and sends their best split per node, so what the driver gets does not grow with the rows.
    """
    widths = n_cuts + 2     # bin 0 is for missing values, and k cuts make k + 1 bins
    runs = [r for r in np.array_split(np.arange(len(n_cuts)), MERGERS) if len(r)]

    def partial(own):
        sums, at = _sums(own, codes, level, widths), 0
        for i, run in enumerate(runs):
            wide = int(widths[run].sum())
            yield i, sums[:, :, at:at + wide]
            at += wide

    def best(merged):
        for i, sums in merged:
            run = runs[i]
            cells = np.zeros((2, 1 << level, len(run), BINS), np.int64)
            at = 0
            for f, w in enumerate(widths[run].tolist()):
                cells[:, :, f, :w] = sums[:, :, at:at + w]
                at += w
            splits = [s and (s[0] + int(run[0]), *s[1:]) for s in best_splits(cells[0], cells[1], n_cuts[run])]
            yield i, splits, [(int(g), int(h)) for g, h in cells[:, :, 0].sum(axis=2).T]

    found = sorted(blocks.mapPartitions(partial).reduceByKey(np.add, len(runs), _itself).mapPartitions(best).collect(),
                   key=lambda r: r[0])
    # ties go to the first feature, so to the first run
    return [max((s[n] for _, s, _ in found if s[n]), key=lambda s: s[3], default=None)
            for n in range(1 << level)], found[0][2]


def _with_tree(blocks: RDD, codes: np.ndarray, weights: np.ndarray, depth: int) -> RDD:
    """``blocks`` with the weight of each row's leaf added to its score."""
    return blocks.map(lambda b: (b[0], b[1], b[2] + weights[node_of(b[0], codes, depth)]))


def best_splits(g: np.ndarray, h: np.ndarray, n_cuts: np.ndarray) -> list[tuple | None]:
    """Per node (feature, bin of the cut, missing goes left, gain, (GL, HL), (GR, HR)), or None without a gain."""
    total_g, total_h = g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)
    left_g, left_h = np.cumsum(g[:, :, 1:], axis=2)[:, :, :-1], np.cumsum(h[:, :, 1:], axis=2)[:, :, :-1]
    with_g = np.stack([left_g + g[:, :, :1], left_g], axis=3)   # missing values left, then right
    with_h = np.stack([left_h + h[:, :, :1], left_h], axis=3)

    def part(gs, hs):
        scaled = gs / STEPS
        return scaled * scaled / (hs + L2)
    other_g, other_h = total_g[:, None, None, None] - with_g, total_h[:, None, None, None] - with_h
    gain = part(with_g, with_h) + part(other_g, other_h) - part(total_g, total_h)[:, None, None, None]
    allowed = (with_h >= MIN_CHILD) & (other_h >= MIN_CHILD) & (np.arange(left_g.shape[2]) < n_cuts[:, None])[None, :, :, None]
    flat = np.where(allowed, gain, -np.inf).reshape(len(g), -1)
    out: list[tuple | None] = []
    for node, best in enumerate(flat.argmax(axis=1).tolist()):
        value = float(flat[node, best])
        if not value > MIN_GAIN:
            out.append(None)
            continue
        f, j, way = np.unravel_index(best, with_g.shape[1:])
        gl, hl = int(with_g[node, f, j, way]), int(with_h[node, f, j, way])
        out.append((int(f), int(j) + 1, way == 0, value, (gl, hl), (int(total_g[node]) - gl, int(total_h[node]) - hl)))
    return out


def leaf_weight(g: int, h: int, step: float) -> float:
    return -(g / STEPS) / (h + L2) * step


def _grow(blocks: RDD, tree: int, cols: list[str], edges: list[list[float]],
          params: ModelParams) -> tuple[list[Node], np.ndarray]:
    """Nodes and walking codes of one tree; one aggregate per level."""
    n_cuts = np.array([len(e) for e in edges])
    codes = np.full(2 << params.depth, -1)
    nodes: list[Node] = []
    sums: dict[int, tuple[int, int]] = {}
    for level in range(params.depth):
        open_nodes = [1] if not level else [n for n in sums if n >= 1 << level]
        if not open_nodes:
            break
        splits, totals = _level_splits(blocks, codes, level, n_cuts)
        if not level:
            sums[1] = totals[0]
        for n in open_nodes:
            split = splits[n - (1 << level)]
            if split is None:
                continue
            f, cut, missing_left, gain, left, right = split
            codes[n] = (f * 128 + cut) * 2 + int(missing_left)
            nodes.append(Node(tree, n, cols[f], edges[f][cut - 1], bool(missing_left), None, gain, sums.pop(n)[1]))
            sums[2 * n], sums[2 * n + 1] = left, right
    nodes += [Node(tree, n, leaf=leaf_weight(*s, params.learning_rate), n_rows=s[1]) for n, s in sums.items()]
    return sorted(nodes, key=lambda n: n.node), codes


@dataclass(frozen=True)
class Prepared:
    """A training table in bins, written: what the fits of one table share. ``used``: the features that a split can be on."""

    cols: list[str]
    edges: list[list[float]]
    rows: DataFrame
    used: list[int]


def _used(rows: DataFrame, edges: list[list[float]]) -> list[int]:
    """Features with cuts, but for those that are in the same bin as an earlier one in every row: ties go to the first
    feature, so no split is on them. Only features of equal cuts are compared."""
    cut = [f for f, e in enumerate(edges) if e]
    pairs = [(f, g) for i, f in enumerate(cut) for g in cut[i + 1:] if edges[f] == edges[g]]
    n_features = len(edges)

    def differing(batches):
        for b in batches:
            for cells in b.column(0):
                bins = np.frombuffer(cells.as_py(), np.uint8).reshape(n_features, -1)
                found = [i for i, (f, g) in enumerate(pairs) if (bins[f] != bins[g]).any()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32())], ["pair"])
    differ = {r.pair for r in rows.select("bins").mapInArrow(differing, "pair int").distinct().collect()} if pairs else set()
    same = {g for i, (_, g) in enumerate(pairs) if i not in differ}
    return [f for f in cut if f not in same] or [0]


def prepare(train: DataFrame, params: ModelParams = ModelParams(), label: str = LABEL_COL,
            cols: list[str] | None = None) -> Prepared:
    """The bins of ``train``; the caller owns the table that is written for it."""
    cols = cols or feature_columns(train, params.exclude)
    ensure_checkpoint_dir(train.sparkSession)
    ship_package(train.sparkSession)
    edges = bin_edges(train, cols)
    rows = materialize(binned(train, cols, edges, label), "tree_rows")
    return Prepared(cols, edges, rows, _used(rows, edges))


def fit(train: DataFrame, params: ModelParams = ModelParams(), label: str = LABEL_COL,
        cols: list[str] | None = None, start: TreeModel | None = None, prepared: Prepared | None = None) -> TreeModel:
    """M3 / M4: the boosted trees of ``train``. An empty table gives a model without trees.

    With ``start``, a model of the same table and parameters with fewer rounds, only
    the missing rounds are fitted; the result is the same as from the beginning.
    ``prepared`` is what :func:`prepare` gave for the same table, parameters and columns.
    """
    start = start or TreeModel(())
    with written_paths() as paths:
        prepared = prepared or prepare(train, params, label, cols)
        rows, used = prepared.rows, prepared.used
        names, edges = [prepared.cols[f] for f in used], [prepared.edges[f] for f in used]
        walks = _codes_of(start, names, edges)
        if walks is None:   # a model that is cut elsewhere
            rows, walks = materialize(binned(score(start, train), prepared.cols, prepared.edges, label), "tree_rows"), []
        blocks, held, trees = _blocks(rows, used, start if walks else TreeModel((), start.first), walks), None, list(start.trees)
        for tree in range(len(trees) + 1, 0 if rows.isEmpty() else params.rounds + 1):
            blocks.persist(StorageLevel.MEMORY_AND_DISK)
            if tree % params.checkpoint_interval == 0:
                blocks.checkpoint()
            nodes, codes = _grow(blocks, tree, names, edges, params)
            trees.append(tuple(nodes))
            if held is not None:
                held.unpersist()
            held, blocks = blocks, _with_tree(blocks, codes, _leaf_weights(tuple(nodes), codes), params.depth)
        if held is not None:
            held.unpersist()
    for path in paths:
        remove_path(train.sparkSession, path)
    return TreeModel(tuple(trees))


def model_table(spark: SparkSession, model: TreeModel) -> DataFrame:
    """K4: a model as rows, one per node; tree 0 carries the first score."""
    first = Node(0, 1, leaf=model.first)
    return spark.createDataFrame([n.row() for tree in ((first,), *model.trees) for n in tree], MODEL_SCHEMA)


def from_table(table: DataFrame) -> TreeModel:
    """The model of a table of nodes; a model's size is bounded by rounds and depth, not by the data."""
    trees: dict[int, list[Node]] = {}
    first = FIRST_SCORE
    for r in table.collect():
        if r.tree == 0:
            first = r.leaf
        else:
            trees.setdefault(r.tree, []).append(Node(r.tree, r.node, r.feature, r.cut, r.missing_left, r.leaf, r.gain, r.n_rows))
    return TreeModel(tuple(tuple(sorted(trees[t], key=lambda n: n.node)) for t in sorted(trees)), first)


def save(spark: SparkSession, model: TreeModel, path: str) -> None:
    model_table(spark, model).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> TreeModel:
    return from_table(spark.read.schema(MODEL_SCHEMA).parquet(path))


def _walk(nodes: tuple[Node, ...], place: dict[str, int]):
    """One tree as a function of feature values (one row a feature, NaN if missing) that gives the weight of each row's leaf."""
    at = {n.node: i for i, n in enumerate(nodes)}
    inner = [n.feature is not None for n in nodes]
    feature = np.array([place[n.feature] if split else 0 for n, split in zip(nodes, inner, strict=True)])
    cut = np.array([n.cut if split else 0.0 for n, split in zip(nodes, inner, strict=True)])
    left, right = (np.array([at[2 * n.node + side] if split else i for i, (n, split) in enumerate(zip(nodes, inner, strict=True))])
                   for side in (0, 1))
    missing = np.where([bool(n.missing_left) for n in nodes], left, right)
    weight, root = np.array([0.0 if n.leaf is None else n.leaf for n in nodes]), at[1]
    depth = max(n.node for n in nodes).bit_length() - 1

    def leaves(flat: np.ndarray, n_rows: int, gaps: bool) -> np.ndarray:
        node, rows, start = np.full(n_rows, root), np.arange(n_rows), feature * n_rows
        for _ in range(depth):
            v = flat.take(start.take(node) + rows)
            after = np.where(v <= cut.take(node), left.take(node), right.take(node))
            node = np.where(np.isnan(v), missing.take(node), after) if gaps else after
        return weight.take(node)
    return leaves


def score(model: TreeModel, df: DataFrame, out: str = SCORE_COL) -> DataFrame:
    """M5: ``df`` with the model's score, the weights added in the order of the trees.

    One column function over the features that the trees ask for; it walks all rows of an
    Arrow batch at once.
    """
    names = list(dict.fromkeys(n.feature for t in model.trees for n in t if n.feature is not None))
    if not names:
        total = model.first
        for t in model.trees:
            total += t[0].leaf
        return df.withColumn(out, F.lit(total))
    ship_package(df.sparkSession)
    walks, first = [_walk(t, {c: f for f, c in enumerate(names)}) for t in model.trees], model.first

    def scores(*columns: pa.Array) -> pa.Array:
        flat = np.concatenate([c.to_numpy(zero_copy_only=False) for c in columns])
        n, gaps = len(columns[0]), bool(np.isnan(flat).any())
        total = np.full(n, first)
        for leaves in walks:
            total = total + leaves(flat, n, gaps)
        return pa.array(total)
    return df.withColumn(out, F.arrow_udf(scores, "double")(*[F.expr(_value(c, df.schema[c].dataType)) for c in names]))


def gain_by_feature(table: DataFrame) -> DataFrame:
    """Splits and total gain per feature of a model table."""
    return table.where("feature is not null").groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_splits"), F.sum("gain").alias("gain"))
