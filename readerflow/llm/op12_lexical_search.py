"""Ranked lexical search with hashed max-sketches.

Index. Every document with a term becomes one row: its distinct term hashes with
their counts, and its sketch. A term's impact in a document, ``1000000000 * tf
div (1000 * tf + 12 * m)``, is at most 1000000; the impacts fold into
``COORDINATES`` coordinates by hash, each keeping the maximum of its terms,
rounded up to one byte. Only occupied coordinates are stored.

Search. The items are taken in blocks of at most ``block_chars`` characters; the
document frequencies of a block's terms are counted over the whole index. A task
holds the block as a matrix (coordinate x item) of term weights. Looking a batch
of sketches up in it is one matrix product and gives upper bounds of all scores.
For each item the documents of the batch are then scored exactly in the order of
falling bounds, ``STEP`` at a time, until the next bound is below the item's
current ``k``-th score; so every document is either scored or shown to be below.
A task hands on at most ``k`` rows for each item; a first ranking joins them in
groups of tasks' rows, a second one for the item.

Terms are known by 64-bit hashes; two of n distinct terms share one with a
chance of about n * n / 2**65, which no check follows.

Defined results: null and empty texts have no terms and count neither as
documents nor as items; fewer than ``k`` rows come back if fewer score above 0;
equal scores go by ascending id, null ids last; repeated rows of a document are
documents of their own and all ranked; repeated equal items are answered once,
different texts of one item id each; empty tables give an empty result. Only ids
and texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import LOWER, UPPER, put, slices, table
from .terms import TERM_SQL, Terms, count_terms

TOP = 20
COORDINATES = 1 << 16
FULL = 1_000_000
BLOCK_CHARS = 200_000
ITEMS = 128
STEP = 64
CELLS = 2_000_000
INDEX = "n long, terms binary, tfs binary, spots binary, maxima binary"


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def coordinate(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64) % COORDINATES


def sketch(doc: np.ndarray, h: np.ndarray, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, coordinate, maximum in 1/255 of the full impact, rounded up) of every occupied coordinate, ordered."""
    cell = doc * COORDINATES + coordinate(h)
    order = np.lexsort((impact, cell))
    cell, impact = cell[order], impact[order]
    last = np.append(cell[1:] != cell[:-1], True) if len(cell) else np.zeros(0, bool)
    return cell[last] // COORDINATES, cell[last] % COORDINATES, -(-impact[last] * 255 // FULL)


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The values of each row as one binary value."""
    size = values.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer((first * size).astype(np.int64)), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _unpacked(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values of all rows, where each row begins)."""
    c = column.cast(pa.large_binary())
    offs = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
    size = np.dtype(dtype).itemsize
    return np.frombuffer(c.buffers()[2] or b"", dtype, (offs[-1] - offs[0]) // size, offs[0]), (offs - offs[0]) // size


def term_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term hash, count) in order of text and hash, and the number of terms of each text."""
    t = Terms(column)
    h = t.hashes()
    order = np.lexsort((h, t.doc))
    doc, h = t.doc[order], h[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h))), t.count


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with a term, terms of all documents)."""

    def run(batches):
        n = total = 0
        for b in batches:
            c = count_terms(b.column(0))
            n, total = n + int((c > 0).sum()), total + int(c.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["n", "total"])

    r = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return r[0] or 0, r[1] or 0


def build_index(docs: DataFrame, size: tuple[int, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n, terms, tfs, spots, maxima) of all documents with a term."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_docs, total = size

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                doc, h, tf, n = term_counts(b.column(1))
                m = 75 + 25 * n * n_docs // max(1, total)
                where, spot, top = sketch(doc, h, impacts(tf, m[doc]))
                has = n > 0
                texts = np.arange(len(n) + 1)
                cut, cut2 = np.searchsorted(doc, texts), np.searchsorted(where, texts)
                out = pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), _packed(h, cut), _packed(tf.astype(np.uint32), cut), _packed(spot.astype(np.uint16), cut2), _packed(top.astype(np.uint8), cut2)],
                    names=["doc_id", "n", "terms", "tfs", "spots", "maxima"])
                yield out.filter(pa.array(has))

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {INDEX}")


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """(item id, text) in blocks of at most ``block_chars`` characters (a longer item is its own block)."""
    part, held = [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        if part and held + len(r[1]) > block_chars:
            yield part
            part, held = [], 0
        part.append((r[0], r[1]))
        held += len(r[1])
    if part:
        yield part


def frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Number of documents that hold each of the (sorted) term hashes."""

    def run(batches):
        df = np.zeros(len(terms), np.int64)
        for b in batches:
            h, _ = _unpacked(b.column(0), np.uint64)
            at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
            df += np.bincount(at[terms[at] == h], minlength=len(terms))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["term", "df"])

    out = np.zeros(len(terms), np.int64)
    for r in index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


class Queries:
    """Weights of some items: by term for exact scores, by coordinate for bounds."""

    def __init__(self, numbers: list[int], item: np.ndarray, h: np.ndarray, weight: np.ndarray) -> None:
        """``numbers``: of the items in their block; ``item``, ``h``, ``weight``: one entry for each item and term of it."""
        self.numbers = numbers
        self.terms, term = np.unique(h, return_inverse=True)
        spots = coordinate(self.terms)
        self.spots, spot = np.unique(spots, return_inverse=True)
        self.by_spot = np.zeros((len(self.spots), len(numbers)))
        np.add.at(self.by_spot, (spot[term], item), weight)
        self.of_item = []
        for k in range(len(numbers)):
            mine = item == k
            self.of_item.append((term[mine], weight[mine]))

    def bounds(self, n: int, doc: np.ndarray, spot: np.ndarray, top: np.ndarray) -> np.ndarray:
        """Upper bound of the score of every document (row) for every item (column)."""
        at = np.minimum(np.searchsorted(self.spots, spot), len(self.spots) - 1)
        hit = self.spots[at] == spot
        maxima = np.zeros((n, len(self.spots)))
        maxima[doc[hit], at[hit]] = top[hit]
        return np.ceil(maxima @ self.by_spot * (FULL / 255) * (1 + 1e-12))


class Batch:
    """Documents of the index: the impacts of those of their terms that some item has."""

    def __init__(self, q: Queries, first: np.ndarray, h: np.ndarray, tf: np.ndarray, m: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(q.terms, h), len(q.terms) - 1)
        hit = np.flatnonzero(q.terms[at] == h)
        doc = np.searchsorted(first, hit, side="right") - 1
        self.q, self.term, self.impact = q, at[hit], impacts(tf[hit], m[doc])
        self.first = np.searchsorted(doc, np.arange(len(first)))
        self.weights = np.zeros(len(q.terms), np.int64)

    def exact(self, item: int, docs: np.ndarray) -> np.ndarray:
        """Scores of the given documents for an item."""
        a, n = self.first[docs], self.first[docs + 1] - self.first[docs]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(a - (ends - n), n)
        term, weight = self.q.of_item[item]
        self.weights[term] = weight
        sums = np.append(0, np.cumsum(self.weights[self.term[at]] * self.impact[at]))
        self.weights[term] = 0
        return sums[ends] - sums[ends - n]


def _order(row: tuple) -> tuple:
    """By falling score, then by id, null ids last."""
    return (-row[0], 1) if row[1] is None else (-row[0], 0, row[1])


class Best:
    """The ``k`` best (score, id) rows of every item so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.rows = k, [[] for _ in range(n)]
        self.least = np.ones(n)  # scores below this are out

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        rows = self.rows[item] + [(s, i) for s, i in zip(scores.tolist(), ids) if s > 0]
        self.rows[item] = rows = sorted(rows, key=_order)[:self.k]
        if len(rows) == self.k:
            self.least[item] = max(1, rows[-1][0])

    def search(self, batch: Batch, bounds: np.ndarray, ids: list) -> int:
        """Score the documents of a batch by falling bounds; returns how many were scored."""
        scored = 0
        for item in np.flatnonzero((bounds >= self.least).any(0)).tolist():
            b = bounds[:, item]
            order = np.flatnonzero(b >= self.least[item])
            order = order[np.argsort(-b[order], kind="stable")]
            for a in range(0, len(order), STEP):
                docs = order[a:a + STEP]
                docs = docs[b[docs] >= self.least[item]]
                if not len(docs):
                    break
                scored += len(docs)
                s = batch.exact(item, docs)
                keep = np.flatnonzero(s >= self.least[item])
                if len(keep):
                    self.add(item, s[keep], [ids[d] for d in docs[keep].tolist()])
        return scored


def local_best(index: DataFrame, parts: list[Queries], size: tuple[int, int], k: int, kind: str) -> DataFrame:
    """(item, doc_id, score): at most ``k`` rows for each item and task, ``item`` being its number in the block."""
    n_docs, total = size

    def run(batches):
        best = [Best(len(q.numbers), k) for q in parts]
        step = max(1, min(512, CELLS // max((len(q.spots) for q in parts), default=1)))
        arrow = None
        for batch in batches:
            arrow = batch.schema.field("doc_id").type
            for a in range(0, batch.num_rows, step):
                b = batch.slice(a, step)
                ids = b.column(0).to_pylist()
                m = 75 + 25 * b.column(1).to_numpy() * n_docs // max(1, total)
                h, first = _unpacked(b.column(2), np.uint64)
                tf = _unpacked(b.column(3), np.uint32)[0].astype(np.int64)
                spot, where = _unpacked(b.column(4), np.uint16)
                top = _unpacked(b.column(5), np.uint8)[0]
                doc = np.repeat(np.arange(b.num_rows), np.diff(where))
                for q, found in zip(parts, best):
                    found.search(Batch(q, first, h, tf, m), q.bounds(b.num_rows, doc, spot.astype(np.int64), top), ids)
        for q, found in zip(parts, best):
            rows = [(i, d, s) for i, held in zip(q.numbers, found.rows) for s, d in held]
            if rows:
                item, doc, score = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, arrow), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return index.select("doc_id", "n", "terms", "tfs", "spots", "maxima").mapInArrow(run, f"item int, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "search")
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text <> ''").distinct()
    size = corpus_size(docs, text_col)
    index = put(build_index(docs, size, id_col, text_col), f"{root}/index", f"doc_id {kinds[0]}, {INDEX}")
    results = []
    for number, block in enumerate(item_blocks(items, block_chars)):
        item, h, count, _ = term_counts(pa.array([t for _, t in block], pa.string()))
        if not len(h):
            continue
        terms = np.unique(h)
        df = frequencies(index, terms)
        weight = np.array([term_weight(size[0], f) for f in df.tolist()], np.int64)[np.searchsorted(terms, h)] * count
        parts = []
        for a in range(0, len(block), ITEMS):
            mine = (item >= a) & (item < a + ITEMS)
            if mine.any():
                parts.append(Queries(list(range(a, min(a + ITEMS, len(block)))), item[mine] - a, h[mine], weight[mine]))
        found = local_best(index, parts, size, k, kinds[0])
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item int, item_id {kinds[1]}")
        by = [F.desc("score"), F.asc_nulls_last("doc_id")]
        # hundreds of thousands of tasks' rows meet in 64 groups first
        found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*by))).where(F.col("rank") <= k).drop("rank", "part")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).where(F.col("rank") <= k)
        results.append(put(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), f"{root}/found-{number}",
                           f"item_id {kinds[1]}, rank int, doc_id {kinds[0]}, score long", 8))
    if not results:
        return spark.createDataFrame([], f"item_id {kinds[1]}, rank int, doc_id {kinds[0]}, score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM_SQL}') AS w FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
qt AS (SELECT item_id, text, term, count(*) AS k FROM (SELECT item_id, text, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM_SQL}')) AS term FROM q) GROUP BY ALL),
t AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM t, c GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 75 + (25 * len(w) * n_docs) // total AS m FROM d, c WHERE len(w) > 0),
s AS (SELECT item_id, text, m.rid, m.doc_id, sum(k * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM qt JOIN w USING (term) JOIN t USING (term) JOIN m ON m.rid = t.rid GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {TOP}
"""
