import math
from collections import Counter

import pytest

from brute import LONG

from basketry.llm import op09_quality as quality
from basketry.llm.charlm import ORDER, discounts

CLEAN = ["the river runs through the valley and the hills rise above it in the evening light",
         "a small house stands near the river and the garden behind the house is full of trees",
         "in the evening the light falls on the hills and the trees near the small garden"]
JUNK = ["THE!! RIVER!! RUNS!! THROUGH!! VALLEY!! AND!! HILLS!! RISE!!", "the### river$$$ runs%%% valley&&& and*** hills###",
        "light light light light light light light light light light light light", "x | q | zz | jj | kk | vv | xq | zq"]


def corpus():
    rows = [(i, CLEAN[i % 3] + " " + CLEAN[(i // 3) % 3], "en") for i in range(60)]
    return rows + [(100 + i, t * 3, "en") for i, t in enumerate(JUNK)]


def labels(spark, rows):
    return spark.createDataFrame([(r[0], 1 if r[0] < 100 else 0, 0) for r in rows if r[0] is not None and r[0] % 2 == 0],
                                 "doc_id long, quality int, toxic int")


def test_junk_goes_and_clean_text_stays(spark, make_docs):
    rows = corpus()
    got = {r.doc_id: r for r in quality.classify(make_docs(rows), labels(spark, rows)).collect()}
    assert all(got[i].kept for i in range(60)) and not any(got[100 + i].kept for i in range(4))
    docs = make_docs(rows)
    left = quality.drop_rejected(docs, labels(spark, rows))
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == list(range(60))


def grams_of(text):
    """Grams of a coded text as tuples, contexts cut at the blank before the word."""
    units = [32, *(48 if 48 <= ord(c) <= 57 else ord(c) for c in quality.code_text(text)), 3]
    out = []
    for i in range(1, len(units)):
        gram = [units[i]]
        for back in range(1, ORDER):
            if i - back < 0 or back > 1 and gram[0] in (32, 0):
                gram.insert(0, 0)
            else:
                gram.insert(0, units[i - back])
        out.append(tuple(gram))
    return out


def test_perplexity_equals_the_textbook_model(spark, make_docs):
    rows = corpus()
    trusted = [t for d, t, _ in rows if d % 2 == 0 and d < 100]
    tables = {ORDER: Counter(g for t in trusted for g in grams_of(t))}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = Counter(g[-n:] for g in tables[n + 1])
    cuts = {n: discounts(spark.createDataFrame([(c,) for c in t.values()], "n long")) for n, t in tables.items()}

    def logp(gram):
        value = 1.0 / (len(tables[1]) + 1)
        for n in range(1, ORDER + 1):
            g, table = gram[-n:], tables[n]
            same = [c for x, c in table.items() if x[:-1] == g[:-1]]
            if same:
                held = sum(cuts[n][min(c, 3) - 1] for c in same)
                above = table[g] - cuts[n][min(table[g], 3) - 1] if g in table else 0.0
                value = (above + held * value) / sum(same)
        return math.log(value)

    got = {r.doc_id: r.perplexity for r in quality.classify(make_docs(rows), labels(spark, rows)).collect()}
    for doc, text, _ in rows[:6] + rows[60:]:
        grams = grams_of(text)
        # the end of a text is scored but not counted as a character
        want = math.exp(-sum(map(logp, grams)) / (len(grams) - 1))
        assert got[doc] == pytest.approx(want, rel=1e-9), doc


def test_shards_and_chunks_do_not_change_scores(spark, make_docs, monkeypatch):
    rows = corpus()
    want = sorted(map(tuple, quality.classify(make_docs(rows), labels(spark, rows)).select("doc_id", "perplexity").collect()))

    def tiny(batches, work=quality._pack_batches):
        quality.CHUNK_CHARS, quality.SHARD_CHARS = 300, 900
        try:
            yield from work(batches)
        finally:
            quality.CHUNK_CHARS, quality.SHARD_CHARS = 1 << 20, 1 << 24

    monkeypatch.setattr(quality, "_pack_batches", tiny)
    got = sorted(map(tuple, quality.classify(make_docs(rows), labels(spark, rows)).select("doc_id", "perplexity").collect()))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] == pytest.approx(w[1], rel=1e-9) for g, w in zip(got, want, strict=True))


ODD = [(200, None, "en"), (201, "", "en"), (202, " \n\t", None), (203, CLEAN[0], None), (204, CLEAN[1], "xx"),
       (None, CLEAN[2], "en"), (205, CLEAN[0] + " " + CLEAN[1], "en"), (205, CLEAN[0] + " " + CLEAN[1], "en"),
       (206, "\x02\x03\x05 " + CLEAN[0], "en"), (207, LONG, "en"), (208, "😀 " + CLEAN[2], "en")]


def test_odd_rows(spark, make_docs):
    rows = corpus() + ODD
    got = quality.classify(make_docs(rows), labels(spark, corpus()).unionByName(labels(spark, corpus()))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].perplexity is None and not by[i].kept for i in (200, 201, 202))
    assert all(by[i].kept for i in (203, 204, 205, None)) and not by[207].kept
    assert quality.classify(make_docs([]), labels(spark, corpus())).count() == 0
    untaught = quality.classify(make_docs(rows), labels(spark, corpus()).limit(0)).collect()
    assert all(r.kept == (r.perplexity is not None) for r in untaught)
