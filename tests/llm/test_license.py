import random
import re

from brute import LONG

from basketry.llm import op10_license as lic

AUTO = lic.SuffixAutomaton(lic.TEMPLATES, lic.BASE_PHRASES)
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in lic.BASE_PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places_equal_brute_force():
    rng = random.Random(2)
    pool = [w.decode() for w in AUTO.vocabulary] + ["zz", "MIT", "License", "é x", "mit"] + [
        "mit", "license", "apache", "general", "public"] * 10
    for _ in range(2000):
        text = rng.choice([" ", "-", ". ", "\n"]).join(rng.choice(pool) for _ in range(rng.randrange(40)))
        assert lic.scan_text(AUTO, text)[:5] == brute(text), text


def test_matching_statistics_equal_brute_force():
    rng = random.Random(7)
    runs = [tuple(s[i:j]) for s in [*AUTO.sequences, *(list(p) for p, _ in AUTO.phrases)]
            for i in range(len(s)) for j in range(i + 1, len(s) + 1)]
    known = set(runs)
    pool = sorted(AUTO.vocabulary)
    for _ in range(60):
        words = []
        while len(words) < 60:
            words += rng.choice(runs)[:rng.randrange(1, 9)] if rng.random() < 0.6 else (rng.choice([*pool, b"zz"]),)
        want = {}
        for i in range(len(words)):
            n = max((n for n in range(1, i + 2) if tuple(words[i + 1 - n:i + 1]) in known), default=0)
            if n:
                want[i] = n
        assert {i: n for i, n, _ in AUTO.stream(words)} == want


def test_templates_are_found_whole_and_changed():
    for label, template in lic.TEMPLATES:
        got = lic.scan_text(AUTO, f"Some words before. {template} And after.")
        assert label in got[5].split(","), template
        assert got[6] == 1.0 or got[6] >= lic.MIN_COVER
    changed = lic.TEMPLATES[2][1].replace("except in", "save only in")
    assert lic.scan_text(AUTO, changed)[5] == "apache"
    assert lic.scan_text(AUTO, "the license of this software is subject to the terms")[5] == ""


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "MIT License MIT-license"), (None, "mit license"), (3, "mit licenses"),
            (4, LONG + " the GNU General Public License " + LONG)]
    got = lic.scan_documents(make_docs(rows)).collect()
    for (doc, text), r in zip(rows, got, strict=True):
        assert (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (doc, *brute(text))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert lic.scan_documents(make_docs([])).count() == 0


def best_cover(auto, runs, t):
    """The most words of a template that any chain of runs covers, by trying all chains."""
    places = [(end, length, at) for end, length, state in runs for at in auto.nodes[state].ends.get(t, ())]

    def most(last, covered):
        best = covered
        for end, length, at in places:
            if last is None:
                best = max(best, most((end, at), length))
                continue
            e, a = last
            overlap = max(0, e - (end - length + 1) + 1, a - (at - length + 1) + 1)
            gaps = max((end - length + 1) - e - 1, (at - length + 1) - a - 1)
            if e < end and a < at and overlap < length and gaps <= lic.MAX_GAP:
                best = max(best, most((end, at), covered + length - overlap))
        return best

    return most(None, 0)


def test_chains_equal_the_best_of_all_chains():
    """Templates with repeated openings: every place of a run may start or extend a chain."""
    rng = random.Random(4)
    gained = 0
    for _ in range(150):
        opening = [f"w{rng.randrange(5)}" for _ in range(4)]
        template = []
        for _ in range(3):
            template += opening + [f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 8))]
        auto = lic.SuffixAutomaton([("x", " ".join(template))], [])
        text = []
        for _ in range(4):
            i = rng.randrange(len(template))
            text += template[i:i + rng.randrange(3, 9)] + [f"z{rng.randrange(9)}"] * rng.randrange(0, 9)
        words = [w.encode() for w in text]
        runs, held = [], None
        for i, length, state in auto.stream(words):
            if held is not None and (i != held[0] + 1 or length != held[1] + 1) and held[1] >= lic.MIN_RUN:
                runs.append(held)
            held = (i, length, state)
        if held is not None and held[1] >= lic.MIN_RUN:
            runs.append(held)
        spans = lic.scan_words(auto, words)[1]
        want = best_cover(auto, runs, 0) / len(auto.sequences[0])
        assert max((s[3] for s in spans), default=0.0) == want, (template, text)
        assert all(a[2] < b[1] for a, b in zip(spans, spans[1:], strict=False))
        gained += len(runs) > 1
    assert gained > 20


def test_a_repeated_opening_does_not_hide_what_follows_its_second_place():
    opening, first, second = "a b c d", "e f g h", "i j k l"
    auto = lic.SuffixAutomaton([("x", f"{opening} {first} {opening} {second}")], [])
    spans = lic.scan_words(auto, [w.encode() for w in f"{opening} zz {second}".split()])[1]
    assert [(s[1], s[2], s[3]) for s in spans] == [(0, 8, 0.5)]
