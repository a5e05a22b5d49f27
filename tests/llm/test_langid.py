import zlib
from collections import Counter

import numpy as np
import pytest
from brute import LONG
from pyspark.sql import functions as F

from basketry.llm import op02_langid as langid
from basketry.llm.charlm import BLANK, ORDER, collect_models, discounts


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    got = langid.op2_language_id(spark, d).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert len(held) > 150 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


TEXTS = {"en": "the quick brown fox jumps over the lazy dog and then the other dogs ",
         "de": "der schnelle braune fuchs springt über den faulen hund und die anderen hunde ",
         "fr": "le renard brun saute par dessus le chien paresseux et les autres chiens "}


def rows():
    return [(i, t * (1 + i % 3), lang) for i, (lang, t) in enumerate(list(TEXTS.items()) * 6)]


ODD = [(100, None, "en"), (101, "", "de"), (102, "123 !!! 😀", "fr"), (103, "the lazy dogs", None), (104, "ﷲ Ж", "en"),
       (None, "der faule hund", "de"), (105, "les chiens " + LONG, None), (103, "the lazy dogs", None)]


def test_odd_rows(spark, make_docs):
    got = langid.identify(make_docs(rows() + ODD), F.col("doc_id") < 100).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 18 + len(ODD)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102))
    assert by[103].lang_pred == "en" and by[None].lang_pred == "de" and by[104].lang_pred in TEXTS
    assert langid.identify(make_docs([]), F.lit(True)).count() == 0
    untaught = langid.identify(make_docs(rows()), F.lit(False)).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_blocks_of_languages_predict_the_same(make_docs, monkeypatch):
    docs = make_docs(rows() + ODD)
    want = sorted((r.doc_id or -1, r.lang_pred, round(r.score, 9)) for r in langid.identify(docs, F.col("doc_id") < 100).collect())
    monkeypatch.setattr(langid, "BLOCK", 1)
    got = sorted((r.doc_id or -1, r.lang_pred, round(r.score, 9)) for r in langid.identify(docs, F.col("doc_id") < 100).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-3 for g, w in zip(got, want, strict=True))


def kneser_ney(counts, cuts, size):
    """{gram: probability} by the textbook recursion over strings whose contexts end at a blank."""
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = Counter(g[-n:] for g in tables[n + 1])

    def p(gram):
        value = 1.0 / (size + 1)
        for n in range(1, ORDER + 1):
            g, table = gram[-n:], tables[n]
            same = [(x, c) for x, c in table.items() if x[:-1] == g[:-1]]
            total = sum(c for _, c in same)
            if total:
                cut = cuts[n]
                held = sum(cut[min(c, 3) - 1] for _, c in same)
                above = table[g] - cut[min(table[g], 3) - 1] if g in table else 0.0
                value = above / total + held / total * value
        return value

    return p, len(tables[1])


def test_models_equal_the_textbook_recursion(spark, make_docs):
    docs = make_docs(rows()).select(F.lit("all").alias("lang"), "text")
    counted = langid.count_grams(docs, "test_grams")
    model = collect_models(counted, "lang", "test_continuations")["all"]
    grams = {r.gram: r.n for r in counted.collect()}
    text = lambda g: tuple((g >> 16 * i) & 0xFFFF for i in range(ORDER - 1, -1, -1))
    cuts, tables = {}, {ORDER: Counter({text(g): n for g, n in grams.items()})}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = Counter(g[-n:] for g in tables[n + 1])
    for n, table in tables.items():
        cuts[n] = discounts(spark.createDataFrame([(c,) for c in table.values()], "n long"))
    p, size = kneser_ney(tables[ORDER], cuts, len(tables[1]))
    keys = np.array(list(grams), np.int64).view(np.uint64)
    got = np.exp(model.logp(keys))
    want = np.array([p(text(int(k))) for k in keys])
    assert size == model.size
    assert np.all(np.abs(got - want) < 1e-4 * np.maximum(want, 1e-3) + 1e-6)


def test_models_keep_every_gram_apart(spark, monkeypatch):
    """More distinct grams than any fixed table: each keeps its counts, and an unseen one has none."""
    from basketry.llm import charlm
    monkeypatch.setattr(charlm, "SLICE", 1 << 18)
    n = 600_000
    char = lambda step: F.lit(0x4E00) + F.pmod(F.floor(F.col("id") / step), F.lit(1000))
    packed = char(1) + char(1000) * F.lit(1 << 16) + F.lit(0x4E00 << 32) + F.lit(BLANK << 48)
    counted = spark.range(n).select(F.lit("all").alias("lang"), packed.cast("long").alias("gram"),
                                    F.lit(2).cast("long").alias("n"))
    model = collect_models(counted, "lang", "test_many")["all"]
    assert len(model.grams[ORDER].at) == n
    unseen = np.array([(BLANK << 48) + (0x4E01 << 32) + (0x4E00 << 16) + 0x4E00 + i for i in range(1000)], np.uint64)
    assert not model.grams[ORDER].get(unseen).any()


def test_letters_beyond_the_bmp_tell_languages_apart(make_docs):
    adlam = ["".join(chr(0x1E922 + (7 * i + j) % 28) for j in range(6)) for i in range(12)]
    gothic = ["".join(chr(0x10330 + (5 * i + j) % 24) for j in range(6)) for i in range(12)]
    rows = [(i, f"{w} {w}", lang) for lang, words in (("ff", adlam), ("got", gothic)) for i, w in enumerate(words)]
    new = [(100, adlam[3] + " " + adlam[8], None), (101, gothic[3].upper() + " " + gothic[9], None),
           (102, "\U0001F600 \U0001F680", None)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(make_docs(rows + new), F.lit(True)).collect()}
    assert (got[100], got[101], got[102]) == ("ff", "got", "und")
