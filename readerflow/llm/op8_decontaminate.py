"""Benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased and their white space collapsed. A test item of n
characters may be met with up to k = rate * n edits; cut into k + 1 pieces, at
least one piece of it must occur unchanged (an Aho-Corasick automaton over the
pieces finds all of them in one pass), and only around such hits Myers'
bit-parallel distance decides. Documents are the streamed side; the benchmark is
taken in blocks of at most ``block_chars`` characters, each of which fits a task.

Defined results: null or empty documents match nothing; null or empty items are
matched by nothing; items too short for two pieces must occur unchanged; equal
items are reported each; a null document id is reported as null; repeated rows
of a document count once; empty tables give empty results. Only ids and texts
are read by ``find_matches``; ``drop_contaminated`` returns all its columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import table

RATE = 0.05
MIN_PIECE = 12
BLOCK_CHARS = 2_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(n: int, rate: float = RATE, min_piece: int = MIN_PIECE) -> int:
    """Edits allowed for an item of n characters; pieces keep at least ``min_piece`` characters."""
    return max(0, min(int(rate * n), n // min_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def best_distance(item: str, window: str, limit: int) -> tuple[int, int]:
    """(least edit distance of the item to any substring of the window, where that ends), by Myers' bit vectors."""
    m = len(item)
    peq: dict[str, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for at, c in enumerate(window):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = (mv | ~(xh | pv)) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, at + 1
                if best == 0:
                    break
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
    return best, end


class Matcher:
    """The items of one block and the automaton over their pieces."""

    def __init__(self, items: list[tuple], rate: float = RATE, min_piece: int = MIN_PIECE) -> None:
        self.items = [(i, t) for i, t in ((i, normal(x)) for i, x in items) if t]
        self.budget = [budget(len(t), rate, min_piece) for _, t in self.items]
        self._auto = None

    def __getstate__(self):
        return self.__dict__ | {"_auto": None}

    def _automaton(self):
        if self._auto is None:
            where: dict[str, list] = {}
            for n, (_, t) in enumerate(self.items):
                for off, p in pieces(t, self.budget[n]):
                    where.setdefault(p, []).append((n, off))
            a = ahocorasick.Automaton()
            for p, v in where.items():
                a.add_word(p, (len(p), v))
            if where:
                a.make_automaton()
            self._auto = a
        return self._auto

    def matches(self, text: str | None, first_only: bool = False) -> list[tuple]:
        """(item id, distance, end in the normalised text) of every item within its budget."""
        t, auto = normal(text), self._automaton()
        if not t or not len(auto):
            return []
        spots: dict[int, list[int]] = {}
        for end, (size, held) in auto.iter(t):
            for n, off in held:
                spots.setdefault(n, []).append(end + 1 - size - off)
        found = []
        for n, starts in spots.items():
            got = self._verify(n, sorted(set(starts)), t)
            if got:
                found.append(got)
                if first_only:
                    break
        return found

    def _verify(self, n: int, starts: list[int], t: str):
        """Best match over the windows around the hits; hits whose windows overlap share one."""
        item_id, item = self.items[n]
        k, m = self.budget[n], len(item)
        best = None
        for s in starts:
            if s >= 0 and t.startswith(item, s):
                return item_id, 0, s + m
        if k == 0:
            return None
        i = 0
        while i < len(starts):
            j = i
            while j + 1 < len(starts) and starts[j + 1] - starts[j] <= 2 * k:
                j += 1
            lo, hi = max(0, starts[i] - k), starts[j] + m + k
            d, e = best_distance(item, t[lo:hi], k)
            if d <= k and (best is None or (d, lo + e) < best[1:]):
                best = (item_id, d, lo + e)
            i = j + 1
        return best


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items in id order, in blocks of at most ``block_chars`` characters (a longer item is its own block)."""
    part, size = [], 0
    for r in benchmark.where(F.col(text_col).isNotNull()).select(id_col, text_col).orderBy(id_col, text_col).toLocalIterator():
        if part and size + len(r[1]) > block_chars:
            yield part
            part, size = [], 0
        part.append((r[0], r[1]))
        size += len(r[1])
    if part:
        yield part


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 rate: float = RATE, min_piece: int = MIN_PIECE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item within the budget: doc_id, item_id, distance, end (in the normalised text)."""
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "decontaminate")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = rows.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, end long"
    paths = []

    def scan(matcher: Matcher):
        def run(batches):
            for b in batches:
                at, out = [], []
                for k, t in enumerate(b.column(1).to_pylist()):
                    for m in matcher.matches(t):
                        at.append(k)
                        out.append(m)
                if out:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array([m[0] for m in out]), pa.array([m[1] for m in out], pa.int32()), pa.array([m[2] for m in out], pa.int64())],
                                                     names=["doc_id", "item_id", "distance", "end"])

        return run

    for k, part in enumerate(blocks(benchmark, item_col, item_text, block_chars)):
        rows.mapInArrow(scan(Matcher(part, rate, min_piece)), schema).write.parquet(f"{root}/{k}")
        paths.append(f"{root}/{k}")
    if not paths:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).parquet(*paths)
    best = found.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "end")).alias("m"))
    return best.select("doc_id", "item_id", F.col("m.distance").alias("distance"), F.col("m.end").alias("end"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                      rate: float = RATE, min_piece: int = MIN_PIECE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows that no item matches, with all their columns.

    Each block's matched texts are written as two hashes before the next block
    is read, so that a task and the driver hold one block at a time; one
    anti-join by the hashes follows, for which Spark broadcasts them where they
    are small.
    """
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "contaminated")
    key = ("__matched_1", "__matched_2")
    hashed = dict(zip(key, (F.xxhash64(text_col), F.xxhash64(F.lit(1), text_col))))
    rows = docs.select(F.col(text_col).cast("string").alias("text"), *[c.alias(n) for n, c in hashed.items()])
    schema = f"{key[0]} long, {key[1]} long"
    paths = []

    def matched(matcher: Matcher):
        def run(batches):
            for b in batches:
                yield b.select(list(key)).filter(pa.array([bool(matcher.matches(t, first_only=True)) for t in b.column(0).to_pylist()], pa.bool_()))

        return run

    for k, part in enumerate(blocks(benchmark, item_col, item_text, block_chars)):
        rows.mapInArrow(matched(Matcher(part, rate, min_piece)), schema).write.parquet(f"{root}/{k}")
        paths.append(f"{root}/{k}")
    if not paths:
        return docs
    gone = spark.read.schema(schema).parquet(*paths).distinct()
    return docs.withColumns(hashed).join(gone, list(key), "left_anti").select(*docs.columns)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
