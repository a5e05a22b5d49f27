import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import LONG, ascii_lower

from basketry.llm import op13_lines as lines

BLANKS = " \t\n\x0b\x0c\r"


def brute(docs, min_docs=10, min_chars=1, keep_first=False):
    split = [(d, [(x, ascii_lower(x.strip(BLANKS))) for x in (t or "").split("\n")]) for d, t in docs]
    held = Counter(k for _, ls in split for k in {k for _, k in ls if len(k) >= min_chars})
    first = {}
    for d, ls in split:
        for _, k in ls:
            if d is not None:
                first[k] = min(d, first.get(k, d))
    out = []
    for d, ls in split:
        left, seen = [], set()
        for x, k in ls:
            if len(k) >= min_chars and held[k] >= min_docs and not (keep_first and first.get(k) == d and k not in seen):
                continue
            seen.add(k)
            left.append(x)
        out.append((d, len(ls), len(ls) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def corpus(seed=1, n=200):
    rng = random.Random(seed)
    common = [f"Shared line {i}" for i in range(6)] + ["  menu\t", "Ünï", "X", "\r"]
    docs = []
    for d in range(n):
        text = [rng.choice(common) if rng.random() < 0.4 else f"own {d} {i} {rng.randrange(3)}" for i in range(rng.randrange(8))]
        if d % 2:
            text = [t.upper() if t.isascii() else t for t in text]
        docs.append((d, "\n".join(text)))
    docs += [(500 + i, "hot line\nHOT LINE \nother " + str(i)) for i in range(12)]
    docs += [(600 + i, f"nine {i}\nnearly") for i in range(9)]
    return docs + [(900, None), (901, ""), (902, "\n\n"), (903, LONG), (904, LONG + "\nhot line"), (905, "x" * 200000),
                   (906, "hot line"), (906, "hot line"), (None, "hot line\nnobody's"), (None, None)]


def as_rows(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_lines_follow_brute_force(make_docs, monkeypatch, small):
    if small:  # many slices that are never broadcast, many chunks, nearly all common keys joined by shuffle
        for name, value in (("SLICE_KEYS", 40), ("SENT_SLICES", 0), ("CHUNK_KEYS", 16), ("KEYS_SENT", 2)):
            monkeypatch.setattr(lines, name, value)
    docs = corpus()
    want = brute(docs)
    assert as_rows(lines.clean_lines(make_docs(docs))) == want
    assert sum(w[2] for w in want) > 100 and any(w[3] == "" and w[2] for w in want)
    assert as_rows(lines.clean_lines(make_docs(docs), keep_first=True)) == brute(docs, keep_first=True)


def test_other_limits(make_docs):
    docs = corpus(3)
    assert as_rows(lines.clean_lines(make_docs(docs), 2, 3)) == brute(docs, 2, 3)
    with pytest.raises(ValueError):
        lines.clean_lines(make_docs(docs), 1)
    assert lines.clean_lines(make_docs([])).count() == 0


def test_filters_miss_no_repeat_and_suspect_few_others():
    rng = np.random.default_rng(5)
    slices = 3
    keys = rng.integers(1 << 63, size=slices * lines.SLICE_KEYS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    repeated = keys[:2000]
    filters = defaultdict(lines.SliceFilters)
    chunks = [*np.array_split(keys, 7), repeated]
    for chunk in chunks:
        for part, probes, again in lines.sparse_filters(chunk, slices):
            filters[part].add(probes, again)
    twice = {p: lines._open(f.packed()) for p, f in filters.items()}

    def suspected(hashes):
        part, probes = lines.places(hashes, slices)
        out = np.zeros(len(hashes), bool)
        for p, bits in twice.items():
            out[part == p] = lines.holds(bits, probes[part == p])
        return out
    assert suspected(repeated).all()
    assert suspected(keys[2000:]).mean() < 0.05
    within = defaultdict(lines.SliceFilters)
    for part, probes, again in lines.sparse_filters(np.concatenate([repeated, repeated]), slices):
        within[part].add(probes, again)
    assert sum(int(f.twice.any()) for f in within.values()) == slices


def test_only_suspected_keys_are_shuffled(make_docs, monkeypatch):
    docs = [(i, f"line {i} a\nline {i} b\nfooter") for i in range(300)]
    suspects, common = lines.common_keys(make_docs(docs), 10, 1)
    assert suspects.count() < 320 and common.count() == 1
    assert common.first().n == 300 and bytes(common.first().key) == hashlib.sha256(b"footer").digest()[:16]
