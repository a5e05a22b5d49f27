import hashlib
import random
from collections import defaultdict

from brute import LONG, ascii_lower

from basketry.llm import op06_exact as ex


def test_index_follows_a_dictionary_through_inserts_deletes_and_growth():
    rng, index, live = random.Random(1), ex.CuckooIndex(2), {}
    for step in range(6000):
        key = hashlib.sha256(str(rng.randrange(900)).encode()).digest()
        if key in live and rng.random() < 0.5:
            assert index.delete(key) == live.pop(key)
            assert index.find(key) is None and index.delete(key) is None
        elif key not in live:
            index.insert(key, step + 1)
            live[key] = step + 1
        assert index.find(key) == live.get(key)
    assert dict(index.items()) == live and index.size == len(live)


def test_fingerprint_hits_are_verified(monkeypatch):
    monkeypatch.setattr(ex.CuckooIndex, "_places", lambda self, key: (7, 0, self._other(0, 7)))
    index = ex.CuckooIndex(4)
    index.insert(b"a" * 32, 1)
    assert index.find(b"b" * 32) is None
    index.insert(b"b" * 32, 2)
    assert (index.find(b"a" * 32), index.find(b"b" * 32)) == (1, 2)


def test_combiner_holds_its_bound():
    rows = {"row_id": list(range(500)), "doc_id": list(range(500)), "digest": [bytes([i % 100]) * 32 for i in range(500)]}
    total = defaultdict(int)
    for out in ex._combine_batches(iter([rows]), limit=10):
        for d, n in zip(out["digest"], out["n"], strict=True):
            total[d] += n
    assert set(total.values()) == {5} and len(total) == 100


ROWS = [(1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "one"),
        (7, "one"), (None, "one"), (None, "nobody"), (8, LONG), (10, LONG.upper()), (11, " same text")]


def test_groups_of_odd_rows(make_docs):
    got = ex.exact_groups(make_docs(ROWS)).collect()
    assert len(got) == len(ROWS)
    groups = defaultdict(list)
    for doc, text in ROWS:
        groups[hashlib.sha256(ascii_lower(text).encode()).digest()].append(doc)
    kept = defaultdict(int)
    for r in got:
        ids = groups[bytes(r.digest)]
        best = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (best, len(ids))
        assert not r.kept or r.doc_id == best
        kept[bytes(r.digest)] += r.kept
    assert set(kept.values()) == {1}
    assert ex.exact_groups(make_docs([])).count() == 0


def test_stage_keeps_one_row_of_each_group(make_docs):
    docs = make_docs(ROWS)
    left = ex.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 4, 5, 6, 7, 9, 10, 11]
    assert ex.drop_exact_copies(make_docs([])).count() == 0
