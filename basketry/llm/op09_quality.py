"""Quality classifier: perplexity under a Kneser-Ney character model of trusted text.

Trusted texts are those of rows with ``labels.quality = 1``. A text is coded
before it is counted: blanks become one blank, a word that repeats the word
before it becomes a mark of its own, digits become one digit. Junk shows as
characters, cases, separators or repetitions that trusted text seldom has.

1. Documents are coded and packed (bzip2) into shards of bounded size. A shard's last
   row lists its distinct character 4-grams and how often its trusted texts have
   each (the only pass over the raw text; written to the shared folder).
2. The counts of all shards make an interpolated modified Kneser-Ney model of
   order 4: counts, continuation counts of the lower orders, and per context its
   total and how many grams were seen once, twice and more often. These are
   tables, dealt out by gram or context, never broadcast or collected.
3. Sharded count joins: the distinct grams of all documents are joined with the
   count tables of each order, which gives their log-probability; the
   (shard, gram) lists pick up these values, and each shard meets its own list in
   one bounded task that adds up the texts' log-probabilities.
4. A text is rejected if its cross-entropy lies above the threshold of its
   language: the 0.995 quantile of that language's trusted texts plus half its
   distance from the median. Short texts are drawn toward their language's
   mean by ``PRIOR`` characters, so a few odd characters do not condemn a clean
   short text.

Labels decide only which texts are counted; a document's own label, source and
id are never used for its score.

Defined results: a NULL text or one without words has a NULL perplexity and is
rejected; a NULL or unseen language is held against the quantile of all trusted
texts; without any trusted text nothing with words is rejected; a document
counts once however often its label row is repeated; repeated documents are
scored one by one; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import bz2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.charlm import (
    BLANK,
    ORDER,
    count_tables,
    discounts,
    held_back,
    low,
    merge_counts,
    pack_grams,
)
from basketry.llm.common import content_digest, few_enough, map_batches, materialize, ship_package, table, without

SHARD_CHARS = 1 << 24       # characters of a shard
CHUNK_CHARS = 1 << 20       # characters that a task holds as arrays at once
PRIOR = 200.0               # characters of its language's mean that each text is mixed with
QUANTILE = 0.995
MARGIN = 0.5
PAD, END, SAME = "\x02", "\x03", "\x05"
_CONTROL = str.maketrans({c: " " for c in (PAD, END, SAME)})


def code_text(text: str | None) -> str:
    """The coded text; empty if there is no word."""
    words = (text or "").translate(_CONTROL).split() if any(c in (text or "") for c in (PAD, END, SAME)) else (
        text or "").split()
    return " ".join([SAME if a == b else b for a, b in zip([None, *words], words, strict=False)])


def gram_keys(coded: str) -> tuple[np.ndarray, np.ndarray]:
    """(packed grams, end positions of the texts) of coded texts, each led by PAD and closed by END.

    A gram is a character with up to three before it in the same word and the blank before that word; what lies
    further back is 0. So a word that repeats the one before it always costs what repetition costs in trusted text.
    """
    units = np.frombuffer(coded.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.uint64)
    told = units != ord(PAD)
    units[(units >= 48) & (units <= 57)] = 48
    units[~told] = BLANK
    return pack_grams(units)[told], np.flatnonzero(units[told] == ord(END))


PACKED = ("shard long, doc_ids array<long>, langs array<string>, trusted array<boolean>, digests array<binary>, "
          "payload binary, grams array<long>, counts array<long>")


def _pack_batches(batches):
    shard, size = TaskContext.get().partitionId() << 24, 0
    parts: list = []

    def row(docs=(), payload=None, grams=None, counts=None):
        return {"shard": [shard], "doc_ids": [[d[0] for d in docs]], "langs": [[d[1] for d in docs]],
                "trusted": [[d[2] for d in docs]], "digests": [[d[3] for d in docs]], "payload": [payload],
                "grams": [grams], "counts": [counts]}

    def chunk(docs):
        coded = "".join([PAD + d[4] + END for d in docs])
        keys, ends = gram_keys(coded)
        sizes = np.diff(ends, prepend=-1)
        trusted = np.repeat(np.array([d[2] for d in docs], bool), sizes)
        grams, times = np.unique(keys[trusted], return_counts=True)
        known = np.unique(keys)
        parts.append((np.concatenate([known, grams]), np.concatenate([np.zeros(len(known), np.int64), times])))
        if len(parts) > 16:
            parts[:] = [merge_counts(parts)]
        return row(docs, bz2.compress(coded.encode("utf-8", "surrogatepass")))

    held, chars = [], 0
    for b in batches:
        for doc, lang, good, digest, text in zip(b["doc_id"], b["lang"], b["trusted"], b["digest"], b["text"], strict=True):
            coded = code_text(text)
            held.append((doc, lang, bool(good) and bool(coded), digest, coded))
            chars += len(coded) + ORDER
            if chars >= CHUNK_CHARS:
                yield chunk(held)
                size, held, chars = size + chars, [], 0
                if size >= SHARD_CHARS:
                    grams, counts = merge_counts(parts)
                    yield row(grams=grams.view(np.int64), counts=counts)
                    shard, size = shard + 1, 0
                    parts.clear()
    if held:
        yield chunk(held)
    if parts:
        grams, counts = merge_counts(parts)
        yield row(grams=grams.view(np.int64), counts=counts)


def pack_documents(docs: DataFrame, labels: DataFrame, digest: Column | None = None) -> DataFrame:
    """Shards of coded texts and their gram lists, written to the shared folder; rows take their ``digest`` along."""
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("__id")).distinct()
    marks = few_enough(materialize(trusted, "quality_trusted"))
    digest = F.lit(None).cast("binary") if digest is None else digest
    rows = docs.select("doc_id", "lang", "text").join(marks, F.col("doc_id") == F.col("__id"), "left").select(
        "doc_id", "lang", F.col("__id").isNotNull().alias("trusted"), digest.alias("digest"), "text")
    return materialize(map_batches(rows, ["doc_id", "lang", "trusted", "digest", "text"], PACKED, _pack_batches),
                       "quality_shards")


def gram_scores(shards: DataFrame) -> DataFrame:
    """(gram, logp) of every distinct 4-gram of the documents under the model of the trusted counts."""
    listed = shards.where("grams is not null").select(F.explode(F.arrays_zip("grams", "counts")).alias("x")).select(
        F.col("x.grams").alias("gram"), F.col("x.counts").alias("n"))
    listed = materialize(listed.groupBy("gram").agg(F.sum("n").alias("n")), "quality_grams")
    counts = count_tables(listed.where("n > 0"), [], "quality_grams")
    scored = listed.select("gram")
    size = counts[1].count() + 1
    probability = F.lit(1.0 / size)
    for order in range(1, ORDER + 1):
        discount = held_back(discounts(counts[order]))
        grams = counts[order].select(F.col("gram").alias("__gram"), (F.col("n") - discount).alias("__above"))
        context = F.shiftrightunsigned(F.col("gram"), 16)
        contexts = counts[order].groupBy(context.alias("__context")).agg(
            F.sum("n").alias("__total"), F.sum(discount).alias("__held"))
        tail = low("gram", order)
        # order 1 has the one empty context: its key is 0 for every gram
        scored = scored.withColumn("__p", probability).join(grams, tail == F.col("__gram"), "left").join(
            contexts, F.shiftrightunsigned(tail, 16) == F.col("__context"), "left")
        probability = F.when(F.col("__total").isNull(), F.col("__p")).otherwise(
            F.coalesce("__above", F.lit(0.0)) / F.col("__total") + F.col("__held") / F.col("__total") * F.col("__p"))
        scored = scored.select("gram", probability.alias("__q"))
        probability = F.col("__q")
    return scored.select("gram", F.log("__q").alias("logp"))


SCORED = "doc_id long, lang string, trusted boolean, digest binary, chars long, logp double"


def _score_shard(packed: pa.Table, listed: pa.Table) -> pa.Table:
    """Add up the log-probabilities of a shard's texts; ``listed`` holds the shard's grams."""
    known = listed.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(known)
    known, logp = known[order], listed.column("logp").to_numpy()[order]
    out: dict[str, list] = {n: [] for n in ("doc_id", "lang", "trusted", "digest", "chars", "logp")}
    for i in range(packed.num_rows):  # one packed row as objects at a time
        row = packed.slice(i, 1).to_pylist()[0]
        keys, ends = gram_keys(bz2.decompress(row["payload"]).decode("utf-8", "surrogatepass"))
        starts = np.concatenate([[0], ends[:-1] + 1])
        sums = np.add.reduceat(logp[np.searchsorted(known, keys)], starts)
        out["doc_id"] += row["doc_ids"]
        out["lang"] += row["langs"]
        out["trusted"] += row["trusted"]
        out["digest"] += row["digests"]
        out["chars"] += (ends - starts).tolist()
        out["logp"] += sums.tolist()
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "lang": pa.array(out["lang"], pa.string()),
                     "trusted": pa.array(out["trusted"], pa.bool_()), "digest": pa.array(out["digest"], pa.binary()),
                     "chars": pa.array(out["chars"], pa.int64()),
                     "logp": pa.array(out["logp"], pa.float64())})


def score_documents(docs: DataFrame, labels: DataFrame, digest: Column | None = None) -> DataFrame:
    """(doc_id, lang, trusted, digest, chars, logp) of every document, written to the shared folder."""
    ship_package(docs.sparkSession)
    shards = pack_documents(docs, labels, digest)
    logp = materialize(gram_scores(shards), "quality_logp")
    lists = shards.where("grams is not null").select(
        F.col("shard").alias("of_shard"), F.explode("grams").alias("gram")).join(logp, "gram")
    texts = shards.where("payload is not null").select("shard", "doc_ids", "langs", "trusted", "digests", "payload")
    scored = texts.groupBy("shard").cogroup(lists.groupBy("of_shard")).applyInArrow(_score_shard, SCORED)
    return materialize(scored, "quality_scores")


def classify(docs: DataFrame, labels: DataFrame, digest: Column | None = None) -> DataFrame:
    """Per document: doc_id, lang, perplexity, entropy (drawn to the mean), threshold, kept, and its ``digest``."""
    rows = score_documents(docs, labels, digest)
    good = rows.where("trusted")
    means = good.groupBy("lang").agg((-F.sum("logp") / F.sum("chars")).alias("mean"))
    all_mean = good.agg(-F.sum("logp") / F.sum("chars")).first()[0] or 0.0
    joined = rows.alias("r").join(means.alias("m"), F.expr("r.lang <=> m.lang"), "left").select(
        "r.*", F.coalesce("mean", F.lit(all_mean)).alias("mean"))
    entropy = (-F.col("logp") + PRIOR * F.col("mean")) / (F.col("chars") + PRIOR)
    measured = joined.withColumn("entropy", F.when(F.col("chars") > 0, entropy))

    def limit(name):
        high, middle = F.percentile_approx("entropy", QUANTILE, 10000), F.percentile_approx("entropy", 0.5, 10000)
        return (high + MARGIN * (high - middle)).alias(name)

    trusted = measured.where("trusted")
    limits = materialize(trusted.groupBy("lang").agg(limit("limit")), "quality_limits")
    overall = trusted.agg(limit("all_limit")).first()[0]
    out = measured.alias("r").join(limits.alias("l"), F.expr("r.lang <=> l.lang"), "left").select(
        "r.*", F.coalesce("limit", F.lit(overall).cast("double")).alias("threshold"))
    return out.select("doc_id", "lang", F.when(F.col("chars") > 0, F.exp(-F.col("logp") / F.col("chars")))
                      .alias("perplexity"), "entropy", "threshold",
                      ((F.col("chars") > 0) & (F.col("threshold").isNull() | (F.col("entropy") <= F.col("threshold"))))
                      .alias("kept"), "digest")


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps; rows of one doc_id are told apart by text and language."""
    digest = content_digest("text", "lang")
    rejected = classify(docs, labels, digest).where("not kept").select("doc_id", "digest").distinct()
    return without(docs, materialize(rejected, "quality_rejected"), digest)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: perplexity, threshold and decision for every document."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "perplexity", "entropy", "threshold", "kept")
