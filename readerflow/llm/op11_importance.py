"""Importance resampling towards a target distribution of hashed word n-grams.

Features of a text are its runs of one and of two consecutive terms. A feature's
bucket is the crc32 of its bytes modulo ``buckets``; the raw corpus and the
target are counted by bucket over all their texts. A bucket's gain is its
smoothed log ratio of target to corpus in thousandths, a document's weight the
floored mean gain over the occurrences of its features. Gumbel noise drawn from
a hash of the id makes the highest scores a draw without replacement with
probabilities by weight.

Interning. Each batch of texts has an open-addressed NumPy table: occurrences are
placed by xxhash64 key, all at once, round by round; whoever finds its place
taken compares key and bytes with the holder and stays or moves on by one. A
slot keeps the count and the bucket of its n-gram, so the crc32 is taken once for
each distinct n-gram of a batch, and each occurrence gathers the gain of its
slot. Terms are interned first; a pair is keyed by the xxhash64 of its two slots
and verified by comparing them, which stand for verified bytes.

Ranks need no global sort: documents are counted by score (whole numbers within
a range fixed by the logarithms, so a bounded table), the counts are summed from
the top, and rows are ordered within one score only.

Defined results: null or empty text has no features, weight 0 and no rank (too
few words); equal scores go by id, null ids last; a null id draws its noise
from the empty text; repeated rows are documents of their own (those of one id
share the noise); null target texts are empty; an empty table gives an empty
result, an empty target is counted as zeros. Only the id and the text are read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import LOWER, UPPER, few_files, put, slices, table
from .terms import FOLD, TERM_SQL, Terms

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
SLICE = 4 << 20

# xxhash64's own primes
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def _finish(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(33)
    x *= _P2
    x ^= x >> np.uint64(29)
    x *= _P3
    return x ^ x >> np.uint64(32)


class Spans:
    """Byte spans of one buffer: xxhash64 of each and comparison by bytes."""

    SHORT = 32

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        self.bytes = data.tobytes() + b"\0" * 8
        n = len(data) + 1
        # the eight, the four and the one bytes from every place on
        self.lane = np.ndarray((n,), "<u8", self.bytes, strides=(1,))
        self.half = np.ndarray((n,), "<u4", self.bytes, strides=(1,))
        self.byte = np.frombuffer(self.bytes, np.uint8)
        self.begin, self.size = begin, end - begin

    def __getitem__(self, i: int) -> bytes:
        return self.bytes[self.begin[i]:self.begin[i] + self.size[i]]

    def keys(self) -> np.ndarray:
        """xxhash64 (seed 0) of every span: the short ones all at once, others by the library."""
        h = _P5 + self.size.astype(np.uint64)
        at, left = self.begin.copy(), self.size.copy()
        left[self.size >= self.SHORT] = 0
        for _ in range(self.SHORT // 8 - 1):
            i = np.flatnonzero(left >= 8)
            if not len(i):
                break
            h[i] = _turn(h[i] ^ _turn(self.lane[at[i]] * _P2, 31) * _P1, 27) * _P1 + _P4
            at[i] += 8
            left[i] -= 8
        i = np.flatnonzero(left >= 4)
        h[i] = _turn(h[i] ^ self.half[at[i]].astype(np.uint64) * _P1, 23) * _P2 + _P3
        at[i] += 4
        left[i] -= 4
        for k in range(3):
            i = np.flatnonzero(left > k)
            h[i] = _turn(h[i] ^ self.byte[at[i] + k].astype(np.uint64) * _P5, 11) * _P1
        h = _finish(h)
        for i in np.flatnonzero(self.size >= self.SHORT).tolist():
            h[i] = xxhash.xxh64_intdigest(self[i])
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of spans a and b are equal."""
        equal = self.size[a] == self.size[b]
        left = np.where(equal, self.size[a], 0)
        p, q = self.begin[a], self.begin[b]
        for k in range(0, self.SHORT, 8):
            i = np.flatnonzero(equal & (left > k) & (left < self.SHORT))
            if not len(i):
                break
            rest = np.minimum(left[i] - k, 8).astype(np.uint64) * np.uint64(8)
            differ = (self.lane[p[i] + k] ^ self.lane[q[i] + k]) << (np.uint64(64) - rest)
            equal[i] = differ == 0
        for i in np.flatnonzero(equal & (left >= self.SHORT)).tolist():
            equal[i] = self[a[i]] == self[b[i]]
        return equal


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """xxhash64 of the eight bytes of each pair of 32-bit numbers."""
    x = a.astype(np.uint64) | b.astype(np.uint64) << np.uint64(32)
    return _finish(_turn(_P5 + np.uint64(8) ^ _turn(x * _P2, 31) * _P1, 27) * _P1 + _P4)


def intern(keys: np.ndarray, same) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing with linear probing of all keys at once.

    Returns (number of the distinct item of each occurrence, an occurrence of each item). ``same(a, b)`` compares occurrences.
    """
    room = 1 << max(4, (2 * len(keys)).bit_length())
    owner = np.full(room, -1, np.int64)
    at = (keys & np.uint64(room - 1)).astype(np.int64)
    slot = np.empty(len(keys), np.int64)
    left = np.arange(len(keys))
    while len(left):
        p = at[left]
        free = owner[p] < 0
        owner[p[free]] = left[free]
        holder = owner[p]
        hit = np.flatnonzero(keys[holder] == keys[left])
        hit = hit[same(holder[hit], left[hit])]
        slot[left[hit]] = p[hit]
        stays = np.ones(len(left), bool)
        stays[hit] = False
        left = left[stays]
        at[left] = at[left] + 1 & room - 1
    used = np.flatnonzero(owner >= 0)
    number = np.empty(room, np.int64)
    number[used] = np.arange(len(used))
    return number[slot], owner[used]


class Features:
    """The n-grams of a batch: ``slot`` of each occurrence, ``doc`` it belongs to, ``count`` and ``bucket`` of each slot, ``n_words`` of each text."""

    def __init__(self, column: pa.Array, buckets: int = BUCKETS) -> None:
        t = Terms(column)
        self.n_words = t.count
        spans = Spans(FOLD[t.data], t.begin, t.end)
        word, example = intern(spans.keys(), spans.same)
        texts = [spans[i] for i in example.tolist()]
        crc = [zlib.crc32(x) for x in texts]
        texts = [b" " + x for x in texts]
        first = np.flatnonzero(t.doc[1:] == t.doc[:-1])
        a, b = word[first], word[first + 1]
        pair, example = intern(pair_keys(a, b), lambda i, j: (a[i] == a[j]) & (b[i] == b[j]))
        crc += [zlib.crc32(texts[y], crc[x]) for x, y in zip(a[example].tolist(), b[example].tolist())]
        self.bucket = np.array(crc, np.int64) % buckets
        self.slot = np.concatenate([word, pair + len(texts)])
        self.doc = np.concatenate([t.doc, t.doc[first]])
        self.count = np.bincount(self.slot, minlength=len(self.bucket))
        self.n = t.n


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; a task adds up in one array first, so the shuffle has at most ``buckets`` rows a task."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for s in slices(batch, "text", SLICE):
                f = Features(s.column(0), buckets)
                np.add.at(total, f.bucket, f.count)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    one = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return one.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket; the counts of ``buckets`` rows come to the driver."""
    s, t = dict(map(tuple, raw.collect())), dict(map(tuple, target.collect()))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    return [math.floor(1000 * math.log((t.get(b, 0) + 1) * all_s / ((s.get(b, 0) + 1) * all_t))) for b in range(buckets)]


def weigh(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches):
        table_ = np.array(gain, np.int64)
        for batch in batches:
            for b in slices(batch, "text", SLICE):
                f = Features(b.column(1), len(gain))
                n = np.bincount(f.doc, minlength=f.n)
                sums = np.zeros(f.n, np.int64)
                np.add.at(sums, f.doc, table_[f.bucket][f.slot])
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (f.n_words, n, sums // np.maximum(n, 1)))], names=names)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (doc_id, n_words, n_features, weight, score) with the rank of the drawn rows."""
    scored = scored.withColumn("__fit", F.col("n_words") >= min_words)
    counts = scored.where("__fit").groupBy("score").agg(F.count("*").alias("n"))
    counts = put(counts, scratch_path(scored.sparkSession, "scores"), "score long, n long", few_files(scored.sparkSession))
    take = percent * (counts.agg(F.sum("n")).first()[0] or 0) // 100
    # one row a score: whole numbers between about -1000 * ln(corpus) and 1000 * (ln(target) + 22)
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("score", above.alias("above")).where(F.col("above") < take)
    cut = offsets.agg(F.min("score")).first()[0]
    is_near = F.lit(False) if cut is None else F.col("__fit") & (F.col("score") >= cut)
    rest = scored.where(~is_near).withColumn("rank", F.lit(None).cast("long"))
    within = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    near = scored.where(is_near).join(offsets, "score").withColumn("rank", F.col("above") + F.row_number().over(within)).drop("above")
    near = near.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    return near.unionByName(rest).drop("__fit")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score, rank (null where not drawn)."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text, buckets), buckets)
    scored = weigh(docs, gain, id_col, text_col)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.schema)
    return draw(put(scored, scratch_path(docs.sparkSession, "importance"), schema), percent, min_words)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


# crc32 by a table of 256 rests that is made from the polynomial
ORACLE = rf"""
WITH rests AS (SELECT list(list_reduce(list_prepend(i::UBIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                     lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS rest FROM range(256) r(i)),
texts AS (SELECT 0 AS side, row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
          UNION ALL SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
words AS (SELECT side, rid, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM_SQL}') AS w FROM texts),
f AS (SELECT side, rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM words),
n AS (SELECT side, rid, g, count(*) AS n FROM f GROUP BY ALL),
bytes AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM n)),
crc AS (SELECT g, (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
               lambda c, b: xor(c >> 8, rest[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % {BUCKETS})::BIGINT AS b FROM bytes, rests),
c AS (SELECT b, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM n JOIN crc USING (g) GROUP BY b),
total AS (SELECT sum(s) AS s, sum(t) AS t FROM c),
gain AS (SELECT b, floor(1000 * ln((coalesce(c.t, 0) + 1)::DOUBLE * (coalesce(total.s, 0) + {BUCKETS})::DOUBLE / ((coalesce(c.s, 0) + 1)::DOUBLE * (coalesce(total.t, 0) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM c, total),
w AS (SELECT rid, sum(n)::BIGINT AS k, sum(n * gain)::BIGINT AS total FROM n JOIN crc USING (g) JOIN gain USING (b) WHERE side = 0 GROUP BY rid),
d AS (SELECT words.rid, doc_id, len(w) AS n_words, coalesce(k, 0) AS n_features, CASE WHEN k > 0 THEN (total - ((total % k) + k) % k) // k ELSE 0 END AS weight,
             ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM words LEFT JOIN w ON words.rid = w.rid WHERE side = 0),
e AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d),
r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) OVER () AS total FROM e WHERE n_words >= {MIN_WORDS})
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score, CASE WHEN r <= ({PERCENT} * total) // 100 THEN r END AS rank FROM e LEFT JOIN r USING (rid)
"""
