"""Language identification by Kneser-Ney character models.

Each language gets an interpolated Kneser-Ney model of order 4 over the letters
of its training texts; the models hold every gram under its exact key. A text's cross-entropy per character is taken under every model, together with
the code length of the language itself; the lowest one gives the prediction.

Calibrated rejection: the training texts that a language won set a limit for it,
the 0.995 quantile of their cross-entropy plus half its distance from the
median. A prediction above the limit is marked as rejected and its score halved:
the text fits none of the learned languages well. The score is the winner's
probability against the runner-up, with the evidence counted for at most
``EVIDENCE`` characters, since characters of one text are not independent.

Models learn only from texts with a language whose crc32 fold is not the held
out one; a prediction sees the text alone.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0
and not rejected; a text whose letters all lie outside the models still gets the
language of the shortest code; rows without doc_id are held out; without
training texts everything is ``und``; repeated rows are predicted one by one; an
empty table gives an empty result; extra columns are ignored. Languages are
scored in blocks of ``BLOCK`` models, so their number is not limited.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.charlm import BLANK, CharModel, collect_models, merge_counts, pack_grams
from basketry.llm.common import hash_bucket, map_batches, materialize, table

FOLDS, HELD_OUT = 4, 2
BLOCK = 4                 # languages whose models are broadcast together (each grows with its distinct grams)
CHUNK_CHARS = 1 << 20     # characters held as arrays at once
GRAMS_HELD = 1 << 21      # grams that a counting task holds before it hands them on
KNOWN_GRAMS = 1 << 20     # scored grams that a task remembers
EVIDENCE = 40.0
QUANTILE = 0.995
MARGIN = 0.5


def _letter_table() -> np.ndarray:
    out = np.full(1 << 16, BLANK, np.uint64)
    for code in range(1 << 16):
        c = chr(code)
        if not 0xD800 <= code < 0xE000 and c.isalpha():
            out[code] = ord(c.lower()[0]) & 0xFFFF
    return out


_LETTERS: np.ndarray | None = None


def _pairs_of_letters(raw: np.ndarray, units: np.ndarray) -> None:
    """Put the two units of each letter beyond the BMP, lowered, into ``units``; other such characters stay blanks."""
    at = np.flatnonzero((raw[:-1] & 0xFC00 == 0xD800) & (raw[1:] & 0xFC00 == 0xDC00))
    if not len(at):
        return
    codes = 0x10000 + ((raw[at].astype(np.int64) & 0x3FF) << 10) + (raw[at + 1] & 0x3FF)
    distinct, back = np.unique(codes, return_inverse=True)
    letters = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in distinct])[back]
    at, letters = at[letters > 0xFFFF], letters[letters > 0xFFFF] - 0x10000
    units[at] = 0xD800 + (letters >> 10)
    units[at + 1] = 0xDC00 + (letters & 0x3FF)


def letter_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(grams, how many of each text) of the words' letters and ends, A to Z and others lowered."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letter_table()
    raw = [(" " + t + " ").encode("utf-16-le", "surrogatepass") for t in texts]
    sizes = np.array([len(r) // 2 for r in raw])
    plain = np.frombuffer(b"".join(raw), np.uint16)
    units = _LETTERS[plain]
    _pairs_of_letters(plain, units)
    told = units != BLANK
    told[1:] |= (units[1:] == BLANK) & (units[:-1] != BLANK)  # a word's end is told once
    ends = np.cumsum(sizes)
    cumulative = np.concatenate([[0], np.cumsum(told)])
    per_text = cumulative[ends] - cumulative[ends - sizes]
    return pack_grams(units)[told], per_text


def chunks(rows: list, text_at: int):
    """Runs of rows whose texts hold about CHUNK_CHARS characters together."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[text_at]) + 2
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _count_batches(batches):
    parts: dict = {}
    size = 0

    def flush():
        for lang, lists in parts.items():
            grams, counts = merge_counts(lists)
            yield {"lang": [lang], "grams": [grams.view(np.int64)], "counts": [counts]}
        parts.clear()

    for b in batches:
        by_lang: dict = {}
        for lang, text in zip(b["lang"], b["text"], strict=True):
            by_lang.setdefault(lang, []).append((text or "",))
        for lang, rows in by_lang.items():
            for part in chunks(rows, 0):
                grams, counts = np.unique(letter_grams([t for t, in part])[0], return_counts=True)
                lists = parts.setdefault(lang, [])
                lists.append((grams, counts))
                if len(lists) > 8:
                    lists[:] = [merge_counts(lists)]
        size = sum(len(g) for lists in parts.values() for g, _ in lists)
        if size > GRAMS_HELD:
            yield from flush()
    yield from flush()


def count_grams(rows: DataFrame, name: str) -> DataFrame:
    """(lang, gram, n) over all rows (lang, text); each task hands on sums, which are dealt out by gram."""
    lists = map_batches(rows, ["lang", "text"], "lang string, grams array<long>, counts array<long>", _count_batches)
    flat = lists.select("lang", F.explode(F.arrays_zip("grams", "counts")).alias("x"))
    return materialize(flat.groupBy("lang", F.col("x.grams").alias("gram")).agg(F.sum("x.counts").alias("n")), name)


class GramScores:
    """Log-probabilities of grams under several models, remembered up to a bound."""

    def __init__(self, models: list[CharModel]):
        self.models = models
        self.keys = np.zeros(0, np.uint64)
        self.values = np.zeros((0, len(models)))

    def get(self, grams: np.ndarray) -> np.ndarray:
        """Rows of log-probabilities for sorted distinct grams."""
        at = np.searchsorted(self.keys, grams)
        new = np.ones(len(grams), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != grams[inside]
        if new.any():
            if len(self.keys) > KNOWN_GRAMS:
                self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, len(self.models)))
                new = np.ones(len(grams), bool)
            fresh = grams[new]
            keys = np.concatenate([self.keys, fresh])
            values = np.concatenate([self.values, np.stack([m.logp(fresh) for m in self.models], axis=1)])
            order = np.argsort(keys)
            self.keys, self.values = keys[order], values[order]
            at = np.searchsorted(self.keys, grams)
        return self.values[at]


RANKED = ("row_id long, doc_id long, lang string, train boolean, chars long, "
          "ranked array<struct<entropy: double, lang: string>>")


def _rank_batches(batches, shared):
    langs, models, lengths = shared.value
    scores = GramScores(models)
    for b in batches:
        rows = [(i, t or "") for i, t in enumerate(b["text"])]
        chars = [0] * len(rows)
        ranked: list = [[] for _ in rows]
        for part in chunks(rows, 1):
            grams, sizes = letter_grams([t for _, t in part])
            distinct, back = np.unique(grams, return_inverse=True)
            cumulative = np.concatenate([[0], np.cumsum(sizes)])
            values = scores.get(distinct)
            filled = sizes > 0
            totals = np.zeros((len(part), len(langs)))
            if filled.any():
                for k in range(len(langs)):
                    totals[filled, k] = np.add.reduceat(values[:, k][back], cumulative[:-1][filled])
            for j, (i, text) in enumerate(part):
                # cheap for ordinary text: the first letter ends the search
                if not any(map(str.isalpha, text)):
                    continue
                n = max(int(sizes[j]), 1)
                chars[i] = n
                entropy = (lengths - totals[j]) / n
                best = np.argsort(entropy, kind="stable")[:2]
                ranked[i] = [{"entropy": float(entropy[k]), "lang": langs[k]} for k in best]
        yield {"row_id": b["__row"], "doc_id": b["doc_id"], "lang": b["lang"], "train": b["train"], "chars": chars,
               "ranked": ranked}


def identify(docs: DataFrame, train) -> DataFrame:
    """Per row: doc_id, lang_pred, score, entropy, rejected; ``train`` marks the rows to learn from."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", "lang", F.coalesce(train, F.lit(False)).alias("train")).withColumn(
        "__row", F.monotonically_increasing_id())
    learn = rows.where("train and lang is not null")
    counts = count_grams(learn, "langid_grams")
    models = collect_models(counts, "lang", "langid_continuations")
    sizes = dict(counts.groupBy("lang").agg(F.sum("n")).collect())
    langs = sorted(x for x in models if sizes.get(x))
    every = sum(sizes[x] for x in langs) or 1
    passes = []
    for i in range(0, len(langs), BLOCK):
        mine = langs[i:i + BLOCK]
        lengths = -np.log(np.array([sizes[x] / every for x in mine]))
        shared = spark.sparkContext.broadcast((mine, [models[x] for x in mine], lengths))
        passes.append(map_batches(rows, ["__row", "doc_id", "text", "lang", "train"], RANKED,
                                  lambda b, s=shared: _rank_batches(b, s)))
    if not passes:
        none = rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("entropy"), F.lit(False).alias("rejected"))
        return none
    ranked = passes[0]
    if len(passes) > 1:
        for more in passes[1:]:
            ranked = ranked.unionByName(more)
        ranked = ranked.groupBy("row_id", "doc_id", "lang", "train").agg(
            F.max("chars").alias("chars"), F.array_sort(F.flatten(F.collect_list("ranked"))).alias("ranked"))
    ranked = materialize(ranked.select(
        "doc_id", "lang", "train", "chars", F.get("ranked", F.lit(0)).alias("first"),
        F.get("ranked", F.lit(1)).alias("second")), "langid_ranked")
    own = ranked.where("train and first.lang = lang").groupBy("lang").agg(
        F.percentile_approx("first.entropy", QUANTILE, 10000).alias("high"),
        F.percentile_approx("first.entropy", 0.5, 10000).alias("middle"))
    limits = materialize(own.select(F.col("lang").alias("won"), (F.col("high") + MARGIN * (
        F.col("high") - F.col("middle"))).alias("limit")), "langid_limits")
    out = ranked.join(limits, F.col("first.lang") == F.col("won"), "left")
    gap = F.coalesce(F.col("second.entropy") - F.col("first.entropy"), F.lit(10.0))
    sure = 1 / (1 + F.exp(-gap * F.least(F.col("chars").cast("double"), F.lit(EVIDENCE))))
    rejected = F.coalesce(F.col("first.entropy") > F.col("limit"), F.lit(False))
    return out.select("doc_id", F.coalesce("first.lang", F.lit("und")).alias("lang_pred"),
                      F.when(F.col("first").isNull(), 0.0).when(rejected, sure / 2).otherwise(sure).alias("score"),
                      F.col("first.entropy").alias("entropy"), rejected.alias("rejected"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: predicted language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents")
    fold = hash_bucket("doc_id", FOLDS)
    held = F.coalesce(hash_bucket("doc_id", FOLDS) == HELD_OUT, F.lit(True))
    found = identify(docs, fold != HELD_OUT)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "entropy", "rejected")
