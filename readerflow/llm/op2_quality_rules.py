"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio.

Unigrams and bigrams of all documents are counted in ``2**bits`` hash buckets,
once for the whole corpus and once for the trusted part. A document's score is
the mean over its n-grams of log p_trusted(bucket) - log p_corpus(bucket), with
add-``alpha`` smoothing. Every document is judged by the same fixed threshold.

Defined results: a null or empty text has no words and fails the base rules;
repeated rows are judged each (and counted each); an empty table gives an empty
result; without trusted documents the ratio is 0 for all. Only the id and the
text column are read, so further columns never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import held_out, put, slices, table
from .wordhash import Words, keyed, mix

BITS = 16
ALPHA = 0.5
THRESHOLD = -0.15
MIN_WORDS = 50
FILTER_BITS = 1 << 23  # 131,072 rows at most
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _buckets(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the text that each belongs to."""
    two, at = w.grams(2)
    h = np.concatenate([w.hash, two])
    return (mix(h) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([w.doc, w.doc[at]])


def ngram_counts(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(bucket, corpus, target): counts over all documents and over those whose id is in ``trusted``.

    Each task adds up its documents in one array first, so the shuffle carries
    at most 2**bits rows a task whatever the skew of words. The corpus is
    counted where it is read. Both counts cover every document: the trusted ids
    are joined without a bound, by a shuffle at every size. Before it a set of
    hashed ids in ``FILTER_BITS`` bits, broadcast in rows of 64, spares the texts
    that cannot be trusted ones; the more ids there are, the fewer it spares.
    """
    kind = trusted.schema[id_col].dataType.simpleString()
    ids = trusted.select(F.col(id_col).alias("__id")).where("__id IS NOT NULL").distinct()
    ids = put(ids, scratch_path(docs.sparkSession, "trusted"), f"__id {kind}")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    place = F.pmod(F.xxhash64(F.col("__id").cast("string")), F.lit(FILTER_BITS))
    spared = ids.select(place.alias("p")).groupBy(F.expr("p div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(p % 64))")).alias("bits"))
    maybe = (rows.withColumn("p", place).join(F.broadcast(spared), F.expr("p div 64 = word AND bits & shiftleft(1L, int(p % 64)) <> 0"), "left_semi").drop("p"))

    def run(batches):
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for b in slices(batch, "text"):
                counts += np.bincount(_buckets(Words(b.column(0)), bits)[0], minlength=1 << bits)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    def count(texts: DataFrame) -> DataFrame:
        return texts.select("text").mapInArrow(run, "bucket long, n long")

    none = F.lit(0).cast("long")
    corpus = count(rows).select("bucket", F.col("n").alias("corpus"), none.alias("target"))
    target = count(maybe.join(ids.hint("merge"), "__id", "left_semi")).select("bucket", none.alias("corpus"), F.col("n").alias("target"))
    return corpus.unionByName(target).groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))


def ratio_table(counts: DataFrame, bits: int = BITS, alpha: float = ALPHA) -> np.ndarray:
    """log p_trusted - log p_corpus of every bucket: an array of the fixed size 2**bits."""
    corpus, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for r in counts.collect():  # one row a bucket at most
        corpus[r["bucket"]], target[r["bucket"]] = r["corpus"], r["target"]
    if not target.sum():
        return np.zeros(1 << bits, np.float32)
    size = 1 << bits
    return (np.log((target + alpha) / (target.sum() + alpha * size)) - np.log((corpus + alpha) / (corpus.sum() + alpha * size))).astype(np.float32)


def base_statistics(w: Words) -> dict[str, np.ndarray]:
    """word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    cont = (w.data & 0xC0) == 0x80
    feed = np.flatnonzero(w.data == 10)  # each text ends with one
    begin = np.concatenate([[0], feed[:-1] + 1]) if len(feed) else feed
    words_to = np.searchsorted(w.begin, feed) - np.searchsorted(w.begin, begin)
    full = words_to > 0
    text_of = np.searchsorted(w.start, begin, side="right") - 1
    key = keyed(text_of, w.spans(begin, feed)) if len(feed) else np.zeros(0, np.uint64)
    _, firsts = np.unique(key[full], return_index=True)
    lines = np.bincount(text_of[full], minlength=w.n)
    distinct = np.bincount(text_of[full][firsts], minlength=w.n)
    three, at = w.grams(3)
    _, back, n = np.unique(keyed(w.doc[at], three), return_inverse=True, return_counts=True)
    hit = at[n[back] > 1]
    covered = np.zeros(len(w.hash) + 2, bool)
    for k in range(3):
        covered[hit + k] = True
    return {
        "word_chars": w.per_text(~w.ws & ~cont),
        "n_symbols": w.per_text(SYMBOLS[w.data]),
        "n_dup_lines": (lines - distinct)[: w.n],
        "n_repeat_words": np.bincount(w.doc[covered[: len(w.hash)]], minlength=w.n)[: w.n],
    }


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, the base statistics, base_failed, llr (per n-gram) and kept."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    bits = int(len(ratios)).bit_length() - 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr"]

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                w = Words(b.column(1))
                bucket, doc = _buckets(w, bits)
                llr = np.bincount(doc, weights=ratios[bucket], minlength=w.n) / np.maximum(1, np.bincount(doc, minlength=w.n))
                s = base_statistics(w)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(w.count, pa.int64()), *(pa.array(s[k], pa.int64()) for k in names[2:6]), pa.array(llr, pa.float64())], names=names)

    stats = rows.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good, outside the evaluation fold."""
    return labels.where((F.col("quality") == 1) & ~held_out()).select("doc_id")


def op2(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judge(docs, ratio_table(ngram_counts(docs, trusted_ids(labels))))
