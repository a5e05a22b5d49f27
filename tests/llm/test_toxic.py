import random

import numpy as np
import pytest
from brute import LONG
from pyspark.sql import functions as F

from basketry.llm import op05_toxic as toxic
from basketry.llm.charlm import collect_models
from basketry.llm.op02_langid import count_grams

BAD = ["idiot", "stupid", "loser", "moron"]
CALM = "river house garden light evening valley hills trees small stand above behind through walk water morning".split()


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = [rng.choice(CALM) + rng.choice(["", "", "s", "ing"]) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(30)] = rng.choice(BAD)
            if i % 8 == 0:
                words[rng.randrange(30)] = "grobi" + rng.choice(["an", "ana", "ich", "otte", "us", "ent"])
        rows.append((i, " ".join(words)))
        marks.append((i, None, int(bad)))
    return rows, marks


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(corpus()[1], "doc_id long, quality int, toxic int")


def test_disguised_words_are_restored(spark, make_docs):
    rows = corpus()[0]
    model = collect_models(count_grams(make_docs(rows).select(F.lit("all").alias("lang"), "text"), "t"), "lang", "u")["all"]
    restorer = toxic.Restorer(model)
    for word, plain in {"1d10t": "idiot", "$tup1d!!": "stupid", "l0ser": "loser", "m0r0n,": "moron", "idiiiiot": "idiot",
                        "st*pid": "stupid", "i d i o t": "idiot", "l.o.s.e.r": "loser", "m_o_r_o_n": "moron"}.items():
        assert plain in restorer.restored(f"you {word} there"), word
    assert restorer.restored("a plain text, with 12 numbers; mail x@y.com or 10.0.0.1 and erhe***") == []


def test_marks_are_learned_and_disguise_does_not_help(spark, make_docs, labels):
    rows = corpus()[0]
    plain = " ".join(CALM * 2)
    extra = [(1001, f"{plain} 1d10t {plain}"), (1002, f"{plain} s t u p i d {plain}"), (1003, f"{plain} mooooron {plain}"),
             (1004, f"{plain} grobiwort {plain}"), (1005, plain), (1006, f"{plain} idiotic"), (1007, plain.upper()),
             (1008, f"{plain} IDIOT.")]
    got = {r.doc_id: r for r in toxic.score_toxicity(make_docs(rows + extra), labels, F.lit(True)).collect()}
    assert np.mean([(got[i].score >= toxic.THRESHOLD) == (i % 4 == 0) for i in range(400)]) > 0.99
    assert all(got[i].score >= toxic.THRESHOLD for i in (1001, 1002, 1003, 1004, 1008))
    assert all(got[i].score < toxic.THRESHOLD for i in (1005, 1007))


def test_held_out_quality_on_the_given_tables(spark):
    d = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic")
    got = toxic.op5_toxicity(spark, d).join(truth, "doc_id").where("held_out").collect()
    caught = [r.predicted for r in got if r.toxic == 1]
    spared = [1 - r.predicted for r in got if r.toxic == 0]
    assert np.mean(caught) > 0.6 and np.mean(spared) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= toxic.THRESHOLD) for r in got)


def test_odd_rows(spark, make_docs, labels):
    odd = [(2000, None), (2001, ""), (None, "idiot"), (2002, LONG + " idiot " + LONG), (2003, "idiot"), (2003, "idiot"),
           (2004, "*" * 5000), (2005, "a" * 5000), (2006, "1" * 5000 + "a")]
    rows = corpus()[0] + odd
    got = toxic.score_toxicity(make_docs(rows), labels.unionByName(labels.limit(40)), F.lit(True)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.score for r in got}
    assert by[2000] == by[2001] < 0.5 and min(by[None], by[2002], by[2003]) >= toxic.THRESHOLD
    assert toxic.score_toxicity(make_docs([]), labels, F.lit(True)).count() == 0
    untaught = toxic.score_toxicity(make_docs(rows), labels, F.lit(False)).collect()
    assert {r.score for r in untaught} == {0.0}


@pytest.fixture
def restorer(make_docs):
    counts = count_grams(make_docs(corpus()[0]).select(F.lit("all").alias("lang"), "text"), "t")
    return toxic.Restorer(collect_models(counts, "lang", "u")["all"])


def test_long_disguises_are_decoded_whole(restorer):
    for text, plain in {"st" + "u" * 40 + "pid": "stupid", "m" * 30 + "oron": "moron",
                        "1d" + "1" * 60 + "0t": "idiot"}.items():
        assert plain in restorer.restored(f"you {text} there"), text
    assert any("idiot" in w for w in restorer.restored("riverhousegardenlighteveningvalleyhillstrees1d10t"))
    assert restorer.restored("x1" * 20_000)


def test_single_letter_words_do_not_hide_spaced_ones(restorer):
    for text, plain in {"such a m o r o n there": "moron", "what a i d i o t": "idiot", "y o u i d i o t": "idiot",
                        "the s.t.u.p.i.d.l.o.s.e.r": "loser", "m o o o o r o n": "moron"}.items():
        assert plain in restorer.restored(text), text
    assert restorer.restored("1 2 3 4 5") == []
    assert restorer.restored("the b a d one")


def test_words_of_mostly_digits_and_symbols_are_decoded(restorer):
    for text, plain in {"1d107": "idiot", "57up1d": "stupid", "$7up1d": "stupid", "1053r": "loser", "m0r0n": "moron"}.items():
        assert plain in restorer.restored(f"you {text} there"), text
    assert restorer.restored("in 1998a and 2023b") == []


def test_no_mark_is_left_out_for_its_frequency(spark, make_docs):
    """Boilerplate of a toxic source makes thousands of marks; an insult in few texts still counts."""
    rng = random.Random(3)
    boiler = ["".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(4)) + "q" for _ in range(3000)]
    rows, marks = [], []
    for i in range(60):
        words = [rng.choice(CALM) for _ in range(30)]
        if i < 12:
            words = rng.sample(boiler, len(boiler))
        elif i < 20:
            words[3 + i % 5] = "moron"
        rows.append((i, " ".join(words)))
        marks.append((i, None, int(i < 20)))
    rows.append((100, "river moron valley"))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxic.score_toxicity(make_docs(rows), labels, F.lit(True)).collect()}
    assert got[100] >= toxic.THRESHOLD


def test_implied_marks_are_left_out():
    marks = [("abc", 0.9), ("abcd", 0.9), ("abcd ", 0.95), ("abc ", 0.9), ("abce ", 0.9), ("xyz ", 0.9), ("xyzw ", 0.9)]
    assert sorted(toxic.telling_marks(marks)) == [("abc", 0.9), ("abc ", 0.9), ("abcd ", 0.95), ("xyz ", 0.9),
                                                  ("xyzw ", 0.9)]


def test_joined_and_mixed_disguises_are_decoded(restorer):
    for text, plain in {"$tup1d/l0ser": "loser", "l0ser.m0ron": "moron", "st*p1d&idi0t": "stupid", "i d ! o t": "idiot",
                        "s  t  u  p  i  d": "stupid", "$ t u p i d": "stupid", "i.d-i o t": "idiot",
                        "m o r o n !": "moron", "m*o*r*o*n": "moron", "you=1d10t": "idiot"}.items():
        assert plain in restorer.restored(f"you {text} there"), text
    for text in ("see https://l0ser.net/1d10t", "mail m0r0n@l0ser.com", "open /home/l0ser/1d10t", "c:\\l0ser\\x1",
                 "www.m0ron.org", "file l0ser.txt,", "5 - 6 - 7 ! !", "- - - . . ."):
        assert not set(BAD) & set(restorer.restored(text)), text


def test_decoder_equals_all_paths_of_a_short_lattice(restorer):
    """List Viterbi against every path, scored one by one."""
    from itertools import product
    for word in ("1d10t", "$tup!d", "l0s3r", "m*r*n", "mooooron", "6a8y", "st*p1d"):
        scored = []
        for steps in product(*toxic._lattice(toxic._LONG_RUN.sub(r"\1\1\1", word)), [(" ", 0.0)]):
            now, total, told = " ", 0.0, ""
            for letters, p in steps:
                total += p
                for c in letters:
                    total += restorer._logp(now, c)
                    now = (now + c)[1 - toxic.ORDER:] if c != " " else c
                told += letters
            scored.append((total, told.strip()))
        scored.sort(key=lambda x: -x[0])
        got = restorer.decode(word)
        cut = scored[toxic.BEST - 1][0] if len(scored) >= toxic.BEST else -1e9
        assert len(got) == min(toxic.BEST, len(scored)), word
        assert set(got) <= {t for p, t in scored if p >= cut - 1e-9}, word
        assert {t for p, t in scored if p > cut + 1e-9} <= set(got), word


def test_marks_are_counted_as_a_plain_count_does(restorer):
    from collections import Counter
    from types import SimpleNamespace
    texts = ["river river house", "House of light", "idiot house", "a to lights idiotic", None, ""]
    marks = [0, 0, 1, 1, 1, 0]
    told = list(toxic._fit_batches([{"toxic": marks[:3], "text": texts[:3]}, {"toxic": marks[3:], "text": texts[3:]}],
                                   SimpleNamespace(value=restorer.model)))
    got = {m: (t, c) for b in told for m, t, c in zip(b["mark"], b["toxic"], b["clean"], strict=True)}
    want = Counter()
    for bad, text in zip(marks, texts, strict=True):
        for m in {x for w in (text or "").lower().split()
                  for x in [w + " ", *(w[:n] for n in range(toxic.STEM[0], min(toxic.STEM[1], len(w) - 1) + 1))]}:
            want[m, bad] += 1
    assert got == {m: (want[m, 1], want[m, 0]) for m, _ in want}


def test_letters_beyond_the_bmp_are_scored(make_docs):
    word = "\U0001E922\U0001E923\U0001E924\U0001E925"   # Adlam
    counts = count_grams(make_docs([(i, f"{word} {word}") for i in range(9)]).select(F.lit("all").alias("lang"), "text"), "t")
    restorer = toxic.Restorer(collect_models(counts, "lang", "u")["all"])
    total = lambda w: sum(restorer._logp((" " + w)[max(0, i - 2):i + 1], c) for i, c in enumerate(w))
    assert total(word) > total(word[::-1]) + 5
