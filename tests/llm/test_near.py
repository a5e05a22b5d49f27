import random

import numpy as np
import pyarrow as pa
import pytest
from brute import LONG, near_components

from basketry.llm import op03_near as near
from basketry.llm.components import components


def varied(seed, groups=6, size=9, words=60, common=0):
    """Groups of texts that differ in a few words each; ``common`` words lead every text."""
    rng = random.Random(seed)
    lead = " ".join(f"lead{i}" for i in range(common))
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(words)] = f"x{rng.randrange(9999)}"
            rows.append((len(rows) * 3 + 1, f"{lead} {' '.join(text)}".strip()))
    rng.shuffle(rows)
    return rows


def as_rows(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("common", [0, 40, 400])
def test_all_pairs_of_a_small_corpus(make_docs, common):
    rows = varied(common, common=common)
    assert as_rows(near.near_components(make_docs(rows))) == sorted(near_components(rows))


@pytest.mark.parametrize("branch", [5, 1000])
def test_large_nodes_branch_and_end_in_blocks(make_docs, monkeypatch, branch):
    """With tiny nodes every level and the blocks at the end are used; nothing may be lost."""
    for name, value in (("SMALL", 3), ("BLOCK", 4), ("WIDE_BLOCK", 5), ("HOT", 6), ("BRANCH", branch), ("MAX_DEPTH", 3)):
        monkeypatch.setattr(near, name, value)
    rows = varied(11, groups=4, size=14, common=60)
    assert as_rows(near.near_components(make_docs(rows))) == sorted(near_components(rows))


def star(seed, leaves=70, words=100, lead=50):
    """A text and others that are linked with it alone: each has four other words in places of its own."""
    rng = random.Random(seed)
    shared = [f"lead{i}" for i in range(lead)]
    middle = [f"w{i}" for i in range(words)]
    rows = [(1, " ".join(shared + middle))]
    for leaf in range(leaves):
        text = list(middle)
        for i in range(4):
            text[25 * i + 4 + rng.randrange(17)] = f"x{leaf}y{i}"
        rows.append((leaf + 2, " ".join(shared + text)))
    return rows


def test_star_of_single_links_inside_a_branching_node(make_docs, monkeypatch):
    """All texts share the lead's tokens, so one branching node holds all; it alone would part some links."""
    for name, value in (("SMALL", 3), ("BLOCK", 4), ("BRANCH", 20), ("MAX_DEPTH", 4)):
        monkeypatch.setattr(near, name, value)
    monkeypatch.setattr(near, "_stars", lambda rows: rows.select(rows.id.alias("a"), rows.id.alias("b")).limit(0))
    rows = star(1)
    assert as_rows(near.near_components(make_docs(rows))) == sorted(near_components(rows))


def test_sketches_of_blocks_find_all_possible_partners(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(1 << 63, size=64, dtype=np.uint64)
    tokens = np.where(rng.random((30, 64)) < rng.random((30, 1)), rng.integers(1 << 63, size=(30, 64), dtype=np.uint64), base)
    four = tokens >> np.uint64(20) & np.uint64(15)
    wide = (four.reshape(30, 4, 16) * near._NIBBLES).sum(axis=2, dtype=np.uint64).view(np.int64)
    n, root = rng.integers(60, 100, 30), rng.integers(0, 9, 30)
    alike = (four[:, None] != four[None]).sum(axis=2) <= near.WIDE_DIFFER
    sized = 100 * np.minimum(n[:, None], n) >= 75 * np.maximum(n[:, None], n)
    want = alike & sized & (root[:, None] != root)
    assert 0 < want.sum() < 30 * 29
    sides = (np.arange(30) % 3 == 0).astype(int)
    for side, some in ((np.zeros(30, int), want), (sides, want & (sides[:, None] != sides))):
        got = near._possible(pa.table({"node": np.arange(30) + 100, "id": np.arange(30), "root": root, "n": n,
                                       "side": side, "wide": pa.array(wide.tolist())}))
        assert got["id"].to_pylist() == np.flatnonzero(some.any(axis=1)).tolist()
        assert got["node"].to_pylist() == [100 + i for i in got["id"].to_pylist()]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(wide.tolist())], "id long, wide array<long>")
    pairs = rows.toDF("a", "x").join(rows.toDF("b", "y"), near._close_wide("x", "y")).select("a", "b").collect()
    assert {(r.a, r.b) for r in pairs} == set(zip(*(x.tolist() for x in np.nonzero(alike))))


def test_shared_counts_of_blocks():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(40)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    got = near.shared_counts(sets, None)
    off = ~np.eye(40, dtype=bool)
    assert (got[off] == want[off]).all()
    assert (near.shared_counts(sets[:15], sets[15:]) == want[:15, 15:]).all()


ODD = [(5, None), (6, ""), (7, " \t\n"), (8, "a b"), (9, "A  B"), (10, "a b c d e"), (11, "a b c d e"), (11, "a b c d e"),
       (12, LONG), (13, LONG + " end"), (14, "a b c d"), (15, "a b")]


def test_odd_rows(make_docs):
    got = near.near_components(make_docs(ODD)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(near_components(ODD))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near.near_components(make_docs([])).count() == 0
    nobody = near.near_components(make_docs([(None, "a b c d e f"), (3, "a b c d e f")])).collect()
    assert {r.component_id for r in nobody} == {3}


def test_stage_keeps_the_smallest_id(make_docs):
    docs = make_docs(ODD)
    left = near.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [5, 6, 7, 8, 10, 12, 14, 15]


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 140)] + [(200, 200 + i) for i in range(1, 30)] + [(300, 300), (310, 311)]
    links += [(rng.randrange(400, 460), rng.randrange(400, 460)) for _ in range(40)]
    root = {x: x for l in links for x in l}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root if find(x) != x}
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k != v} == want
