"""Toxicity by noisy-channel restoration of disguised words.

1. Channel and language model. A disguised word is a character lattice: digits
   and symbols may stand for letters, a run of one letter for one or two of it,
   blanks or marks between single letters or signs for nothing or a word's end, a
   star for any letter. Words joined by marks such as a slash are decoded one by one,
   unless the whole is an address, a path or a file name.
   An interpolated Kneser-Ney character model of order 4, counted over the words
   of all documents, rates the paths; Viterbi decoding over the model's contexts
   (the last three characters) finds the best one. Only suspicious words are
   decoded, plain ones are read as they are.
2. Word marks. From labelled texts of the learning folds (at most ``FIT_ROWS`` of
   them, chosen by a hash of their id; of texts with the same minwise shingle only
   one counts, so copies of a toxic text do not mark its every word) the operator
   learns which whole words and which beginnings of longer words betray a toxic
   text: those with enough toxic texts and few clean ones among their holders.
3. Score. Each distinct plain or restored word counts with the most telling mark
   it bears; the score is the probability that at least one of them is right.
   Without any it is the rate of toxic texts among texts without marks.

All marks are looked up by one Aho-Corasick pass over the whole text.

Defined results: NULL and empty texts get the base score (no marks); without
labelled texts nothing is learned and every score is 0; rows without a label are
scored like all others; several labels of one document count as toxic if one of
them says so; rows without doc_id are held out; repeated rows are scored one by
one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import groupby

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.charlm import ORDER, CharModel, collect_models
from basketry.llm.common import hash_bucket, map_batches, materialize, table
from basketry.llm.op02_langid import count_grams
from basketry.llm.shingles import shingle_sequence

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
FIT_ROWS = 20_000        # labelled texts that the marks are learned from at most
MIN_TOXIC = 6            # toxic texts that must hold a mark
MIN_RIGHT = 0.85         # toxic share of the texts that hold it
STEM = (3, 9)            # lengths of word beginnings that may be marks
BEST = 6                 # restored forms of a word that are looked up
MARKS_HELD = 1 << 18     # marks that a counting task holds before it hands their sums on
BEAM = 1 << 11           # contexts of the best paths that decoding goes on with
SEEN = 64                # characters of a disguised word whose forms are remembered

# What digits and symbols stand for in disguised writing.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
ANY = "abcdefghijklmnopqrstuvwxyz"
SWAP = math.log(0.05)    # channel: a letter written as a digit or symbol
PLAIN = math.log(1 / 95) # a digit or symbol that stands for itself: any printable character
WILD = math.log(0.01)    # a letter written as a star
JOINED = math.log(0.8)   # a blank or mark between single letters stands for nothing
BREAK = math.log(0.2)    # or for the end of a word
REPEAT = math.log(0.2)   # a run of a letter stands for fewer of it
KEEP = math.log(0.9)     # a letter written as itself

_WORD = re.compile(r"[^\W\d_]+")
_MARKED = re.escape("".join(c for c in LEET if not c.isdigit()) + "*")
_HINT = re.compile(rf"[\d{_MARKED}][^\W\d_]|[^\W\d_](?:[\d@$*€£+|]|[!(¡][\d{_MARKED}])")
_TOKEN = re.compile(rf"(?<!\S)(?=\S*[\d{_MARKED}])(?=\S*[^\W\d_])\S{{3,}}(?!\S)")
_EDGES = re.compile(r"^[^\w\s@$|+*€£¡!]+|[^\w\s@$*€£]+$|([^\w\s])\1+$|^([^\w\s])\2+")
_MARKS = re.compile(r"[./:=\\&%#?]+")
# Endings of addresses and file names, whose parts are no words.
_ENDINGS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|html?|php|js|py|txt|pdf|jpe?g|png|gif|csv|json|xml|zip"
_LINK = re.compile(rf"""[("'<\[{{]*(?:(?:[a-z][a-z0-9+.\-]*:)?//|www\.|[a-z]:\\|\.{{0,2}}/|~/|[^\s@/]+@[^\s@/]+\.[a-z]{{2,}}\b"""
                   rf"""|[\w\-]+(?:\.[\w\-]+)*\.(?:{_ENDINGS})(?![^\W_]))""")
_RUN = re.compile(r"([^\W\d_])\1\1")
_LONG_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
_GAPS = re.compile(r"[ \t.\-_]+")
_ENDS = "!¡|+("   # signs that may as well be punctuation after or before a spaced word
_UNIT = rf"(?:[^\W_]|[{_MARKED}])"
_SPACED = re.compile(rf"(?<![^\W_]){_UNIT}(?:{_GAPS.pattern}{_UNIT}){{2,}}(?![^\W_])")
_STARRED = re.compile(r"(?<![^\W_])[^\W_](?:\*[^\W_]){2,}(?![^\W_])")


def disguises(token: str) -> list[str]:
    """The parts of a token that look like disguised words, without punctuation at their ends; none of an address or path."""
    if _MARKS.search(token) and _LINK.match(token):
        return []
    found = []
    for part in _MARKS.split(token):
        word = _EDGES.sub("", _EDGES.sub("", part))
        letters = sum(map(str.isalpha, word))
        if len(word) > 2 and 0 < letters < len(word):
            found.append(word)
    return found


def _lattice(word: str) -> list[list[tuple[str, float]]]:
    """Per place of the word its possible letters (or none, or two) with the channel's log-probability."""
    places: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(word):
        c = word[i]
        j = i
        while j < len(word) and word[j] == c:
            j += 1
        if c.isalpha():
            letters = [(c, KEEP)]
        elif c == "*":
            letters = [(a, WILD) for a in ANY] if j == i + 1 else [("", WILD)]
        else:
            letters = [(a, SWAP) for a in LEET.get(c, "")] or [("", SWAP)]
        run = j - i
        if run == 1 or run == 2 and c.isalpha():
            places.extend([letters] * run)
        else:  # a run stands for one letter or two
            places.append([x for a, p in letters for x in ((a, p + REPEAT), (a + a, p + REPEAT))])
        i = j
    return places


def _spaced_lattice(letters: str) -> list[list[tuple[str, float]]]:
    """Places of single letters with blanks between them, each of which is nothing or a word's end."""
    places: list[list[tuple[str, float]]] = []
    for _, run in groupby(letters):
        for place in _lattice("".join(run)):
            places += [[("", JOINED), (" ", BREAK)], place] if places else [place]
    return places


def _score(path: tuple[float, tuple]) -> float:
    return path[0]


def _spelled(chain: tuple) -> str:
    """The text of a path, whose steps are chained from the last to the first."""
    parts = []
    while chain:
        chain, told = chain
        parts.append(told)
    return "".join(reversed(parts))


class Restorer:
    """List Viterbi decoder of disguised words."""

    def __init__(self, model: CharModel):
        self.model = model
        self.seen: dict[tuple[str, bool], list[str]] = {}
        self.cost: dict[tuple[str, str], float] = {}

    def _logp(self, context: str, letter: str) -> float:
        key = (context, letter)
        got = self.cost.get(key)
        if got is None:
            units = np.frombuffer((context + letter).encode("utf-16-le", "surrogatepass"), np.uint16).tolist()
            grams = []
            for end in range(len(units) - len(letter.encode("utf-16-le", "surrogatepass")) // 2, len(units)):
                gram = 0
                for back, unit in enumerate(reversed(units[max(0, end + 1 - ORDER):end + 1])):
                    gram |= unit << 16 * back
                grams.append(gram)
            got = float(self.model.logp(np.array(grams, np.uint64)).sum())
            if len(self.cost) > 1 << 18:
                self.cost.clear()
            self.cost[key] = got
        return got

    def _plain(self, word: str) -> float:
        """Log-probability of a token read as it is written: its runs of letters, and digits and symbols as such."""
        total = PLAIN * sum(not c.isalpha() for c in word)
        for run in _WORD.findall(word):
            now = " "
            for c in run + " ":
                total += (KEEP if c != " " else 0.0) + self._logp(now, c)
                now = (now + c)[1 - ORDER:]
        return total

    def decode(self, word: str, spaced: bool = False) -> list[str]:
        """The most probable words behind a disguised one, best first; letters that stood ``spaced`` may be several."""
        word = _LONG_RUN.sub(r"\1\1\1", word)  # runs of three and more are read alike
        got = self.seen.get((word, spaced))
        if got is not None:
            return got
        paths: dict[str, list[tuple[float, tuple]]] = {" ": [(0.0, ())]}  # context -> best paths to it, as chains
        for letters in [*(_spaced_lattice if spaced else _lattice)(word), [(" ", 0.0)]]:
            after: dict[str, list[tuple[float, tuple]]] = {}
            for context, best in paths.items():
                for told, p in letters:
                    now, more = context, p
                    for c in told:
                        more += self._logp(now, c)
                        now = (now + c)[1 - ORDER:] if c != " " else c
                    after.setdefault(now, []).extend((score + more, (chain, told)) for score, chain in best)
            paths = {now: sorted(best, key=_score, reverse=True)[:BEST] for now, best in after.items()}
            if len(paths) > BEAM:
                paths = dict(sorted(paths.items(), key=lambda x: x[1][0][0], reverse=True)[:BEAM])
        found = sorted((x for best in paths.values() for x in best), key=_score, reverse=True)[:BEST]
        if 5 * sum(map(str.isalpha, word)) < 2 * len(word) and found[0][0] <= self._plain(word):
            found = []  # mostly digits and symbols, and likelier just that
        forms = [_spelled(chain).strip() for _, chain in found]
        if len(word) <= SEEN:
            if len(self.seen) > 1 << 16:
                self.seen.clear()
            self.seen[word, spaced] = forms
        return forms

    def restored(self, text: str) -> list[str]:
        """Restored forms of the suspicious words of a lower-cased text."""
        found: list[str] = []
        if _HINT.search(text):
            found += [w for token in _TOKEN.findall(text) for w in disguises(token)]
        end = 0
        for m in _RUN.finditer(text):
            if m.start() < end:
                continue
            start, end = m.span()
            while start and text[start - 1].isalpha():
                start -= 1
            while end < len(text) and text[end].isalpha():
                end += 1
            found.append(text[start:end])
        forms = [form for w in found for form in self.decode(w)]
        spaced = [_GAPS.sub("", m.group()) for m in _SPACED.finditer(text)]
        spaced += [m.group().replace("*", "") for m in _STARRED.finditer(text)] if "*" in text else []
        for letters in dict.fromkeys(x for run in spaced for x in (run, run.strip(_ENDS))):
            if any(map(str.isalpha, letters)):
                forms += dict.fromkeys(w for form in self.decode(letters, True) for w in form.split())
        return forms


def word_marks(words) -> set[str]:
    """Whole words (closed by a blank) and beginnings of longer words."""
    out = set()
    for w in words:
        out.add(w + " ")
        for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1):
            out.add(w[:n])
    return out


def _fit_batches(batches, shared):
    """How many toxic and clean texts have each mark; sums are handed on whenever they fill the task's bound."""
    restorer = Restorer(shared.value)
    toxic_texts: Counter = Counter()
    clean_texts: Counter = Counter()

    def told():
        marks = list(toxic_texts.keys() | clean_texts.keys())
        out = {"mark": marks, "toxic": [toxic_texts[m] for m in marks], "clean": [clean_texts[m] for m in marks]}
        toxic_texts.clear()
        clean_texts.clear()
        return out

    for b in batches:
        for toxic, text in zip(b["toxic"], b["text"], strict=True):
            low = (text or "").lower()
            (toxic_texts if toxic else clean_texts).update(
                word_marks({*_WORD.findall(low), *restorer.restored(low)}))
            if len(toxic_texts) + len(clean_texts) > MARKS_HELD:
                yield told()
    yield told()


def _sign_batches(batches):
    """A text's smallest shingle: copies mostly share it."""
    for b in batches:
        signs = []
        for text in b["text"]:
            shingles = shingle_sequence(text)
            signs.append(int(shingles.min().view(np.int64)) if len(shingles) else -1)
        yield {"text": b["text"], "toxic": b["toxic"], "sign": signs}


def telling_marks(marks) -> list[tuple[str, float]]:
    """The marks without those that a shorter beginning of at least the same probability implies."""
    begins: dict[str, float] = {}
    kept = []
    for mark, p in sorted(marks, key=lambda x: (len(x[0].strip()), x[0])):
        word = mark.strip()
        if all(begins.get(word[:n], 0.0) < p for n in range(STEM[0], len(word))):
            kept.append((mark, p))
            if mark == word:
                begins[word] = p
    return kept


def learn_marks(labelled: DataFrame, shared) -> tuple[list[tuple[str, float]], float]:
    """(marks with their probability, score of a text without any) from the sample (text, toxic)."""
    signed = map_batches(labelled, ["text", "toxic"], "text string, toxic long, sign long", _sign_batches)
    rows = materialize(signed.dropDuplicates(["sign", "toxic"]), "toxic_sample")
    counts = map_batches(rows, ["text", "toxic"], "mark string, toxic long, clean long",
                         lambda b: _fit_batches(b, shared))
    counts = counts.groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    right = (F.col("toxic") + 0.5) / (F.col("toxic") + F.col("clean") + 1.0)
    marks = counts.where(F.col("toxic") >= MIN_TOXIC).withColumn("right", right).where(F.col("right") >= MIN_RIGHT)
    picked = telling_marks((r["mark"], r["right"]) for r in marks.collect())

    def unmarked(batches):
        scorer = Scorer(shared.value, picked, 0.0)
        for b in batches:
            yield {"toxic": b["toxic"], "marked": [bool(scorer.score(t)[1]) for t in b["text"]]}

    rest = map_batches(rows, ["text", "toxic"], "toxic long, marked boolean", unmarked).where("not marked")
    total, toxic = rest.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    return picked, min((toxic + 0.5) / (total + 1.0), THRESHOLD / 2) if picked or total else 0.0


class Scorer:
    """Scores texts with learned marks."""

    def __init__(self, model: CharModel, marks: list[tuple[str, float]], base: float):
        self.restorer, self.base = Restorer(model), base
        table: dict[str, list[float]] = {}
        for mark, p in marks:
            table.setdefault(mark.strip(), [0.0, 0.0])[mark.endswith(" ")] = p
        self.find = ahocorasick.Automaton()
        for mark, (inside, whole) in table.items():
            self.find.add_word(mark, (len(mark), inside, whole))
        if marks:
            self.find.make_automaton()
        self.any = bool(marks)

    def _telling(self, text: str) -> dict[str, float]:
        """Words with marks, and the probability of the most telling one."""
        out: dict[str, float] = {}
        for last, (size, inside, whole) in self.find.iter(text):
            start, end = last + 1 - size, last + 1
            if start and text[start - 1].isalpha():
                continue
            longer = end < len(text) and text[end].isalpha()
            p = inside if longer else whole
            if p:
                while end < len(text) and text[end].isalpha():
                    end += 1
                word = text[start:end]
                out[word] = max(p, out.get(word, 0.0))
        return out

    def score(self, text: str | None) -> tuple[float, list[str]]:
        if not self.any:
            return self.base, []
        low = (text or "").lower()
        found = self._telling(low)
        for word in self.restorer.restored(low):
            found |= self._telling(word)
        wrong = 1.0 - self.base
        for p in found.values():
            wrong *= 1.0 - p
        return 1.0 - wrong, sorted(found)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """Per row: doc_id, score and the marked words; ``learn`` says of a doc_id whether its label may be used."""
    spark = docs.sparkSession
    counts = count_grams(docs.select(F.lit("all").alias("lang"), "text"), "toxic_grams")
    models = collect_models(counts, "lang", "toxic_continuations")
    model = spark.sparkContext.broadcast(models.get("all"))
    if model.value is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.array().cast("array<string>").alias("marks"))
    marked = labels.where("toxic is not null and doc_id is not null").where(learn).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    # the sample has a fixed size, so its ids can be sent to the scan
    sample = materialize(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS), "toxic_labels")
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    marks, base = learn_marks(labelled.select("doc_id", "text", F.when(F.col("toxic") > 0, 1).otherwise(0).cast("long")
                                              .alias("toxic")), model)
    shared = spark.sparkContext.broadcast((marks, base))

    def work(batches):
        scorer = Scorer(model.value, *shared.value)
        for b in batches:
            found = [scorer.score(t) for t in b["text"]]
            yield {"doc_id": b["doc_id"], "score": [s for s, _ in found], "marks": [m for _, m in found]}

    return map_batches(docs, ["doc_id", "text"], "doc_id long, score double, marks array<string>", work)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: toxicity score and decision for every document."""
    fold = hash_bucket("doc_id", FOLDS)
    found = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold != HELD_OUT)
    return found.select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(True)).alias("held_out"), "score",
                        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "marks")
