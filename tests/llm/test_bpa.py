import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import LONG, ascii_lower

from basketry.llm import op11_bpa as bpa

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=20):
    """{item row: [(rank, doc_id, score)]} by scoring every document."""
    bags = [(d, Counter(TERM.findall(ascii_lower(t)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for q, (item, text) in enumerate(items):
        scores = []
        for d, bag in bags:
            scale = 75 + 25 * sum(bag.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * bag[t] // (1000 * bag[t] + 12 * scale))
                        for t in TERM.findall(ascii_lower(text)) if bag[t])
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out[q] = (item, [(r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)])
    return out


def ranked(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return {i: sorted(rows) for i, rows in got.items()}


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    docs = [(d * 7 % 1009, " ".join(rng.choices(words, k=rng.randrange(1, 50), weights=range(60, 0, -1)))) for d in range(n)]
    docs += [(5000 + i, "tie tie other") for i in range(30)] + [(9999, None), (9998, ""), (9997, "..--"), (9996, LONG)]
    docs += [(42, "W1 w2!w3"), (42, "W1 w2!w3"), (None, "w1 w2 w3")]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 14)))) for i in range(12)]
    items += [(50, "tie"), (51, None), (52, "unknown"), (53, "w1 w1 w1 w9"), (None, "w5 w6"), (54, "É é W7")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_follows_brute_force(spark, make_docs, monkeypatch, small):
    if small:  # many chunks, many blocks of items, single positions read at first
        for name, value in (("CHUNK_DOCS", 9), ("STEP", 1), ("BLOCK_TERMS", 40), ("PIECE", 50)):
            monkeypatch.setattr(bpa, name, value)
    docs, items = corpus(3)
    rng = random.Random(1)
    rng.shuffle(docs)
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {item: rows for item, rows in brute(docs, items).values() if rows}
    assert ranked(bpa.search(make_docs(docs), table)) == want
    assert len(want[50]) == 20 and want[50][0][1] == 5000 and 51 not in want and 52 not in want


def test_repeated_item_rows_are_ranked_for_themselves(spark, make_docs):
    table = spark.createDataFrame([(1, "a b"), (1, "a b")], "item_id long, text string")
    got = bpa.search(make_docs([(1, "a b c"), (2, "b d"), (3, "e")]), table).collect()
    assert sorted(r["rank"] for r in got) == [1, 1, 2, 2]


def test_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert bpa.search(make_docs([]), items).count() == 0
    assert bpa.search(make_docs([(1, "a")]), items.limit(0)).count() == 0
    assert bpa.search(make_docs([(1, None), (2, "?")]), items).count() == 0


def test_best_positions_stop_before_the_end_and_strictly_below_the_kth():
    n = 4000
    rng = np.random.default_rng(2)
    steep = np.sort(rng.integers(1, 10, n))
    steep[-30:] += 1000 * np.arange(1, 31)
    order = rng.permutation(n)
    impacts = np.empty(n, np.int64)
    impacts[order] = steep
    lists = [(bpa.ImpactList(np.arange(n), impacts), 1), (bpa.ImpactList(np.arange(n), impacts + 5), 2)]
    top, depth = bpa.best_positions(lists, n, 20, [], list(range(n)))
    total = 3 * impacts + 10
    assert [-s for s, _, _ in top] == sorted(total.tolist(), reverse=True)[:20] and depth < n // 10
    flat = [(bpa.ImpactList(np.arange(n), np.full(n, 7)), 1)]
    top, depth = bpa.best_positions(flat, n, 20, [], list(range(n, 0, -1)))
    assert [i for _, _, i in top] == list(range(1, 21)) and depth >= n   # equal scores: all are read


def test_terms_of_long_texts_come_in_pieces(monkeypatch):
    body = (LONG + " É9_x " + "y" * 300 + " end").encode()
    whole = [t for part in bpa.text_terms(body) for t in part]
    monkeypatch.setattr(bpa, "PIECE", 64)
    assert [t for part in bpa.text_terms(body) for t in part] == whole
    assert [t.decode() for t in whole] == TERM.findall(ascii_lower(body.decode()))
