"""Removal of long repeated byte strings by the interval tree of a sparse suffix array.

Anchors. A 32-byte to 128-byte gram is an anchor where its hash is least among
the grams of some window of ``length`` bytes; every string of that length holds
an anchor, and equal strings hold it at equal places. So two equal strings show
up as two suffixes that start at equal anchors, and only anchors whose gram
occurs twice in the corpus need sorting (counting their hashes is one small
shuffle). A suffix is known by its context: the bytes up to ``length`` to the
right and up to ``length - gram`` to the left, which is all that strings of
``length`` bytes around the anchor can reach.

Periodic stretches. In a run of period p < ``length - gram + 1`` that is at least
``length + p`` long, each string of ``length`` bytes comes again p bytes further
on, so the whole run is covered and is reported as such where it is read. Only
its first p strings, which are all the different ones, and the strings that reach
over its ends choose anchors; without that each byte of a run could be one.

Groups. Suffixes of equal grams meet in one group; equal contexts are counted
and collapsed before. A group sorts its contexts to the right (enhanced suffix
array: order and common prefixes), scans the common prefixes with a stack for
the intervals of its tree, and inside an interval orders the members by their
left contexts: runs whose common left part and common right part reach
``length`` are the maximal repeat groups, with all their occurrences, bounded on
the left where the preceding bytes differ.

Hot groups. A group of more than ``LIMIT`` different contexts is dealt again by a
longer key: the places that an anchor may have in a string are halved twice, and
each quarter keys its members by the bytes that all strings of the quarter share.
Contexts that are equal within the quarter collapse again. At last a quarter is
one place and its key a whole string, so this ends, with no cap on a group.

Defined results: null text is empty; texts shorter than ``length`` lose nothing;
repeated rows are occurrences of their own; a null id is a document like others;
empty tables give empty results. Only the id and the text column are read, so
further columns never clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import few_files, put, slices, table
from .streams import sorted_groups
from .wordhash import Bytes, mix

LENGTH = 400
GRAM = 128
LIMIT = 2048
SLICE = 512 << 10


def _matching(data: np.ndarray, p: int, at: int, stop: int, step: int) -> int:
    """How many bytes from ``at`` on (``step`` 1: forwards, -1: the ones before it) equal those ``p`` bytes further on; ``stop`` bounds the places."""
    n, block = 0, 64
    while True:
        lo, hi = (at + n, min(stop, at + n + block)) if step > 0 else (max(stop, at - n - block), at - n)
        if hi <= lo:
            return n
        differ = np.flatnonzero(data[lo:hi] != data[lo + p:hi + p])
        if len(differ):
            return n + int(differ[0] if step > 0 else hi - lo - 1 - differ[-1])
        n, block = n + hi - lo, min(2 * block, 1 << 20)


def periodic_runs(b: Bytes, pos: np.ndarray, g: np.ndarray, length: int, gram: int) -> list[tuple[int, int, int]]:
    """(begin, end, period) of the maximal periodic runs of at least ``length`` and a period, from the anchors: a run shows as equal grams a period apart."""
    gap = np.diff(pos)
    near = np.flatnonzero((g[1:] == g[:-1]) & (gap < length - gram + 1))
    runs: list[tuple[int, int, int]] = []
    for j in near.tolist():
        at, p = int(pos[j]), int(gap[j])
        if runs and runs[-1][2] == p and at < runs[-1][1] - p:
            continue
        d = int(np.searchsorted(b.start, at, side="right")) - 1
        lo, hi = int(b.start[d]), int(b.start[d + 1]) - 1
        begin = at - _matching(b.data, p, at, lo, -1)
        end = at + _matching(b.data, p, at, hi - p, 1) + p
        if end - begin >= length + p:
            runs.append((begin, end, p))
    return runs


def anchors(b: Bytes, length: int, gram: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Positions (in ``b.data``) of the least gram of every window of ``length`` bytes inside a text, and the periodic runs.

    Windows inside a run choose none but for the first period.
    """
    n = len(b.data)
    count = n - length + 1
    if count <= 0:
        return np.zeros(0, np.int64), []
    at = np.arange(n - gram + 1)
    bits = np.uint64(int(n).bit_length())
    key = (b.spans(at, at + gram) >> bits << bits) | at.astype(np.uint64)  # ties: the leftmost
    w = length - gram + 1
    rows = np.concatenate([key, np.full(-len(key) % w, ~np.uint64(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[:count]
    behind = np.minimum.accumulate(rows, axis=1).ravel()[w - 1:w - 1 + count]
    room = np.repeat(b.start[1:] - 1, np.diff(b.start))[:count] - np.arange(count) >= length
    window = np.flatnonzero(room)
    pos = (np.minimum(ahead, behind)[room] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    chosen = _distinct(pos)
    runs = periodic_runs(b, chosen, b.spans(chosen, chosen + gram), length, gram)
    if runs:
        stays = np.ones(len(pos), bool)
        for begin, end, p in runs:
            stays[np.searchsorted(window, begin + p):np.searchsorted(window, end - length, side="right")] = False
        chosen = _distinct(pos[stays])
    return chosen, runs


def _distinct(pos: np.ndarray) -> np.ndarray:
    return np.unique(pos[np.concatenate([[True], pos[1:] != pos[:-1]])]) if len(pos) else pos


def _anchor_rows(length: int, gram: int, only_gram: bool):
    """Rows of the anchors. A periodic run is a row of its own: ``pos`` its begin, ``rl`` its length, which is more than that of any context."""

    def run(batches):
        for batch in batches:
            for s in slices(batch, "text", SLICE):
                b = Bytes(s.column("text"))
                p, runs = anchors(b, length, gram)
                g = b.spans(p, p + gram)
                if only_gram:
                    yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64))], names=["g"])
                    continue
                d = np.searchsorted(b.start, p, side="right") - 1
                lo, hi = np.maximum(b.start[d], p - (length - gram)), np.minimum(b.start[d + 1] - 1, p + length)
                ctx = mix(b.spans(lo, hi) + (p - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                if runs:
                    begin, end = (np.array([r[k] for r in runs], np.int64) for k in (0, 1))
                    p, lo, hi = np.concatenate([p, begin]), np.concatenate([lo, begin]), np.concatenate([hi, end])
                    d = np.searchsorted(b.start, p, side="right") - 1
                    own = mix(s.column("r1").to_numpy().view(np.uint64)[d[len(g):]] ^ begin.astype(np.uint64))  # spread over the partitions
                    g, ctx = np.concatenate([g, own]), np.concatenate([ctx, own])
                ids = s.select(["did", "r1", "r2"]).take(pa.array(d))
                yield pa.RecordBatch.from_arrays(
                    [*ids.columns, pa.array(p - b.start[d], pa.int64()), pa.array(g.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(p - lo, pa.int32()), pa.array(hi - p, pa.int32())],
                    names=["did", "r1", "r2", "pos", "g", "ctx", "ll", "rl"])

    return run


def _common(rows: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a and b."""
    if not len(a):
        return np.zeros(0, np.int64)
    differ = rows[a] != rows[b]
    first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[a], sizes[b]))


def _matrix(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in strings], np.int64)
    width = max(1, int(sizes.max(initial=0)))
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width), sizes


def intervals(lcp: list[int]):
    """(common prefix, first, last) of the intervals of a suffix array with the given neighbour prefixes, by a stack scan."""
    stack = [(0, 0)]
    for i, x in enumerate([*lcp, -1]):
        left = i
        while stack and stack[-1][0] > x:
            size, left = stack.pop()
            yield size, left, i
        if not stack or stack[-1][0] < x:
            stack.append((x, left))


def repeat_groups(lefts: list[bytes], rights: list[bytes], length: int):
    """Maximal repeats of at least ``length`` bytes among suffixes with the given contexts.

    Yields (members, left, right): the members of a run share ``left[i]`` bytes before and ``right`` bytes after
    the anchor with a neighbour of the run; what all of them share is min(left) + right long.
    """
    n = len(lefts)
    order = sorted(range(n), key=rights.__getitem__)
    m, sizes = _matrix(rights)
    sa = np.array(order)
    lcp = _common(m, sizes, sa[:-1], sa[1:])
    turned = [s[::-1] for s in lefts]
    lm, lsizes = _matrix(turned)
    rank = np.empty(n, np.int64)
    rank[sorted(range(n), key=turned.__getitem__)] = np.arange(n)
    longest = int(lsizes.max(initial=0))
    for right, first, last in intervals(lcp.tolist()):
        if right + longest < length:
            continue
        members = sa[first:last + 1]
        members = members[np.argsort(rank[members])]
        left = _common(lm, lsizes, members[:-1], members[1:])
        joined = left + right >= length
        if not joined.any():
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            run = left[a:b]
            yield members[a:b + 1], np.maximum(np.concatenate([[0], run]), np.concatenate([run, [0]])), right


def _compare(length: int):
    """Groups (key, ctx, r1, r2, pos, n, a, b, left, right) sorted by key, ctx -> covered spans (r1, r2, lo, hi)."""

    def run(batches):
        rows: list[tuple] = []
        for g in sorted_groups(batches):
            if g.num_rows < 2:
                continue
            ctx = g.column(1).to_pylist()
            use = [i for i, c in enumerate(ctx) if i == 0 or c != ctx[i - 1]]
            r1, r2, pos, n, lefts, rights = (g.column(k).to_pylist() for k in (2, 3, 4, 5, 8, 9))
            reach_l, reach_r = [0] * len(use), [0] * len(use)
            for members, left, right in repeat_groups([lefts[i] for i in use], [rights[i] for i in use], length):
                for x, e in zip(members.tolist(), left.tolist()):
                    reach_l[x] = max(reach_l[x], e)
                    reach_r[x] = max(reach_r[x], right)
            rows += [(r1[i], r2[i], pos[i] - e, pos[i] + r) for i, e, r in zip(use, reach_l, reach_r) if r and n[i] == 1]
            if len(rows) > 20_000:
                yield _spans(rows)
                rows = []
        if rows:
            yield _spans(rows)

    return run


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["r1", "r2", "lo", "hi"])


def _hash(*parts: bytes) -> int:
    h = hashlib.blake2b(digest_size=8)
    for p in parts:
        h.update(len(p).to_bytes(4, "little"))
        h.update(p)
    return int.from_bytes(h.digest(), "little", signed=True)


ROW = "key long, ctx long, r1 long, r2 long, pos long, n long, a int, b int, left binary, right binary"
_KINDS = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.binary()] * 2
_NAMES = [c.split()[0] for c in ROW.split(", ")]


def _quarters(length: int):
    """Rows of hot groups -> their rows for each quarter of the places [a, b] that the anchor may have in a string."""

    def run(batches):
        for batch in batches:
            out = []
            for key, _, r1, r2, pos, n, a, b, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                step = max(1, -(-(b - a + 1) // 4))
                for lo in range(a, b + 1, step):
                    hi = min(b, lo + step - 1)
                    if len(left) < lo or len(right) < length - hi:
                        continue
                    core = (left[len(left) - lo:], right[:length - hi])
                    near_l, near_r = left[max(0, len(left) - hi):], right[:length - lo]
                    if len(near_l) + len(near_r) < length:
                        continue
                    out.append((_hash(key.to_bytes(8, "little", signed=True), lo.to_bytes(4, "little"), *core), _hash(near_l, near_r), r1, r2, pos, n, lo, hi, near_l, near_r))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], names=_NAMES)

    return run


def _contexts(length: int, gram: int):
    """(blob, wanted places) -> rows of the first level."""

    def run(batches):
        un = zstandard.ZstdDecompressor()
        for batch in batches:
            out, held = [], 0
            for blob, r1, r2, want in zip(*(c.to_pylist() for c in batch.columns)):
                text = un.decompress(blob)
                for w in want:
                    p = w["pos"]
                    left, right = text[max(0, p - (length - gram)):p], text[p:p + length]
                    out.append((w["g"], w["ctx"], r1, r2, p, w["n"], 0, length - gram, left, right))
                    held += 1
                if held > 5_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], names=_NAMES)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], names=_NAMES)

    return run


def _blobs(batches):
    """Texts as compressed bytes: the shuffle of the texts carries these."""
    pack = zstandard.ZstdCompressor(level=1)
    for b in batches:
        texts = b.column(0).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pack.compress(t or b"") for t in texts], pa.binary()), *b.columns[1:]], names=["blob", *b.schema.names[1:]])


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = LIMIT) -> DataFrame:
    """(r1, r2, lo, hi): spans of the texts (known by two hashes) that are covered by repeated strings. ``docs`` has did, r1, r2, text."""
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "suffix")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    files = few_files(spark)
    at = lambda name: f"{root}/{name}"

    long_docs = docs.where(F.octet_length("text") >= length)
    grams = long_docs.select("text").mapInArrow(_anchor_rows(length, gram, True), "g long")
    # tables of distinct grams are written before they are joined: a join of two plain exchanges can be split where a gram is hot
    shared = put(grams.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g", F.lit(True).alias("twice")), at("shared"), "g long, twice boolean", files)
    schema = "did long, r1 long, r2 long, pos long, g long, ctx long, ll int, rl int"
    found = long_docs.mapInArrow(_anchor_rows(length, gram, False), schema).join(shared, "g", "left").where(F.col("twice") | (F.col("rl") > length))
    found = put(found.select(*[c.split()[0] for c in schema.split(", ")]), at("anchors"), schema)
    runs, found = found.where(F.col("rl") > length), found.where(F.col("rl") <= length)

    # equal contexts: wholly repeated around the anchor
    classes = found.groupBy("g", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("did", "r1", "r2", "pos")).alias("o"))
    classes = put(classes.select("g", "ctx", "n", "o.*"), at("classes"), "g long, ctx long, n long, did long, r1 long, r2 long, pos long")
    same = found.join(classes.where("n > 1").select("g", "ctx"), ["g", "ctx"], "left_semi").where(F.col("ll") + F.col("rl") >= length)
    covers = [d.select("r1", "r2", (F.col("pos") - F.col("ll")).alias("lo"), (F.col("pos") + F.col("rl")).alias("hi")) for d in (runs, same)]

    # different contexts of one gram: fetched from the texts, once for each context
    open_groups = classes.groupBy("g").agg(F.count("*").alias("k"), F.sum((F.col("n") == 1).cast("long")).alias("s")).where("k > 1 AND s > 0").select("g")
    open_groups = put(open_groups, at("open"), "g long", files)
    wanted = (classes.join(open_groups, "g", "left_semi").groupBy("did", "r1", "r2")
              .agg(F.collect_list(F.struct("pos", "g", "ctx", "n")).alias("want")))
    texts = long_docs.select("text", "did", "r1", "r2").mapInArrow(_blobs, "blob binary, did long, r1 long, r2 long")
    level = texts.join(wanted, ["did", "r1", "r2"]).select("blob", "r1", "r2", "want").mapInArrow(_contexts(length, gram), ROW)
    level = put(level, at("level-0"), ROW)

    k = 0
    while True:
        sizes = level.groupBy("key").agg(F.count("*").alias("size"))
        hot_keys = sizes.where(F.col("size") > limit).select("key")
        small = level.join(hot_keys, "key", "left_anti") if k or not hot_keys.isEmpty() else level
        spans = (small.select(*_NAMES).repartition(width, "key").sortWithinPartitions("key", "ctx")
                 .mapInArrow(_compare(length), "r1 long, r2 long, lo long, hi long"))
        covers.append(put(spans, at(f"spans-{k}"), "r1 long, r2 long, lo long, hi long"))
        if hot_keys.isEmpty():
            break
        k += 1
        hot = level.join(hot_keys, "key", "left_semi").select(*_NAMES)
        parts = put(hot.repartition(width, "key", "ctx").mapInArrow(_quarters(length), ROW), at(f"parts-{k}"), ROW, files)
        groups = parts.groupBy("key", "ctx").agg(F.sum("n").alias("n"), F.min(F.struct("r1", "r2", "pos")).alias("o"))
        groups = put(groups.select("key", "ctx", "n", "o.*"), at(f"groups-{k}"), "key long, ctx long, n long, r1 long, r2 long, pos long", files)
        equal = parts.join(groups.where("n > 1").select("key", "ctx"), ["key", "ctx"], "left_semi")
        covers.append(equal.select("r1", "r2", (F.col("pos") - F.octet_length("left")).alias("lo"), (F.col("pos") + F.octet_length("right")).alias("hi")))
        still = groups.groupBy("key").agg(F.count("*").alias("k"), F.sum((F.col("n") == 1).cast("long")).alias("s")).where("k > 1 AND s > 0").select("key")
        reps = groups.join(still, "key", "left_semi")
        level = put(parts.drop("n").join(reps, ["key", "ctx", "r1", "r2", "pos"]).select(*_NAMES), at(f"level-{k}"), ROW, files)
        if level.isEmpty():
            break
    out = covers[0]
    for c in covers[1:]:
        out = out.unionByName(c)
    return out


def _cut(batches):
    """(doc_id, blob, spans) -> digest of what is left."""
    un = zstandard.ZstdDecompressor()
    for batch in batches:
        sizes, removed, spans, shas, kept = [], [], [], [], []
        for blob, cover in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text = un.decompress(blob)
            at, gone, n, parts = 0, 0, 0, []
            lo = hi = None
            for s in sorted((c["lo"], c["hi"]) for c in cover or ()):
                if hi is not None and s[0] <= hi:
                    hi = max(hi, s[1])
                    continue
                if hi is not None:
                    parts.append(text[at:lo])
                    gone, n, at = gone + hi - lo, n + 1, hi
                lo, hi = s
            if hi is not None:
                parts.append(text[at:lo])
                gone, n, at = gone + hi - lo, n + 1, hi
            parts.append(text[at:])
            left = b"".join(parts)
            sizes.append(len(text))
            removed.append(gone)
            spans.append(n)
            shas.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(shas, pa.string()), pa.array(kept, pa.binary())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("doc_id").alias("did"), F.xxhash64("text").alias("r1"), F.xxhash64(F.lit(1), "text").alias("r2"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(rows.drop("doc_id"), length, gram, limit).groupBy("r1", "r2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    blobs = rows.select("text", "doc_id", "r1", "r2").mapInArrow(_blobs, f"blob binary, doc_id {kind}, r1 long, r2 long")
    return (blobs.join(spans, ["r1", "r2"], "left").select("doc_id", "blob", "spans")
            .mapInArrow(_cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
