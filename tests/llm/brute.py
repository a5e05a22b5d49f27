"""Plain Python versions of the operators, written apart from them, for small inputs."""

import re
from collections import defaultdict

LONG = " ".join(f"word{i} tail{i % 7}" for i in range(6000))
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = SPACE.findall(ascii_lower(text))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def near_components(rows):
    """{position: smallest position-wise id} by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(groups[find(i)])) for i in range(len(rows))]


def contained(docs, items):
    out = {}
    for d, text in docs:
        whole = shingles(text)
        out[d] = sorted(i for i, t in items if shingles(t) and 100 * len(shingles(t) & whole) >= 75 * len(shingles(t)))
    return out
