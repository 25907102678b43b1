"""Near-duplicate documents by a chosen-path similarity join.

A document is its set of word shingles. Equal sets are collapsed first, so that
groups of copies cost one row. The rest have a signature of ``T`` min-wise
tokens. In each of ``trees`` independent trees a node chooses, by its own hash,
one or two token positions (1/threshold on average) and hands each document to
the children named by its tokens there. Nodes of up to ``CELL`` documents are
compared exhaustively on signatures; larger ones branch once more, to nodes of
up to ``BIG`` documents. What the trees join loosely (``LOOSE``, far below the
threshold) forms families; inside a family all pairs are confirmed exactly on
the full shingle sets, in cells of at most ``CELL`` documents.

Nodes and families beyond ``BIG`` documents go no deeper, as each level loses
pairs. Their documents are linked exactly inside dealt cells first, which joins
most copies at a linear cost; then all of them that share one of their rarest
shingles (the prefix that a linked pair must share) and are in different
components are compared, so that no link among them is missed. Links leave a
task as the edges of a spanning star, never as all pairs.

Recall: a pair survives a level in one tree with a probability of about 0.87 at
the threshold, and no path has more than ``GRID_LEVEL`` levels, so that 8 trees
miss 4e-5 of such pairs whatever the size of a group (``missed``). The
confirmation is exact, so there are no false links.

Defined results: null, empty and word-free text has an empty set and links with
nothing; repeated rows of one id are classes of that id; rows with a null id
link with nothing, have a null component and are kept; empty tables give empty
results. Only the id and the text column are read, so further columns never clash.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readerflow.session import scratch_path

from .common import few_files, put, slices, table
from .components import connected_components, join_counted
from .streams import sorted_groups
from .wordhash import Words, keyed, mix

SHINGLE = 5
T = 64
TREES = 8
LOOSE = 0.66
CELL = 512
BIG = 16_384
GRID_LEVEL = 2
SKETCH_BITS = 20
_RNG = np.random.default_rng(20240607)
_XOR = _RNG.integers(0, 1 << 63, T, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, T, dtype=np.uint64) | np.uint64(1)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, shingle) pairs, distinct and sorted, and the number of texts. Fewer words than ``size`` are one shingle."""
    w = Words(column, fold=True)
    g, at = w.grams(size)
    doc = w.doc[at]
    short = np.flatnonzero((w.count > 0) & (w.count < size))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short.tolist()):
            h = np.uint64(0)
            for x in w.hash[w.first[d]:w.first[d + 1]]:
                h = np.uint64((int(h) * 0xD6E8FEB86659FD93 + int(x)) & 0xFFFFFFFFFFFFFFFF)
            extra[i] = h
        extra = mix(extra + w.count[short].astype(np.uint64))
        g, doc = np.concatenate([g, extra]), np.concatenate([doc, short])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], g[new], w.n


def _signatures(batches):
    for batch in batches:
        for b in slices(batch, "text", 512 << 10):
            doc, g, n = shingles(b.column(1))
            size = np.bincount(doc, minlength=n)[:n]
            start = np.searchsorted(doc, np.arange(n))
            full = np.flatnonzero(size)
            h = np.zeros((2, n), np.uint64)
            sig = np.zeros((n, T), np.uint32)
            if len(full):
                h[0, full] = np.add.reduceat(mix(g), start[full])
                h[1, full] = np.bitwise_xor.reduceat(mix(g + np.uint64(0xA0761D6478BD642F)), start[full])
                buf = np.empty_like(g)
                for k in range(T):
                    np.bitwise_xor(g, _XOR[k], out=buf)
                    np.multiply(buf, _MUL[k], out=buf)
                    sig[full, k] = (np.minimum.reduceat(buf, start[full]) >> np.uint64(32)).astype(np.uint32)
            h = h.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(h[0]), pa.array(h[1]), pa.array([s.tobytes() for s in sig], pa.binary())],
                names=["doc_id", "n", "h1", "h2", "sig"])


def _choose(node: np.ndarray, sig: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) pairs: each node picks one position by its hash, and a second one with probability 1/threshold - 1."""
    r = mix(node ^ np.uint64(0x8EBC6AF09C88C6E3))
    rows, kids = [], []
    one = (r % np.uint64(T)).astype(np.int64)
    two = (one + 1 + ((r >> np.uint64(16)) % np.uint64(T - 1)).astype(np.int64)) % T
    also = (r >> np.uint64(40)).astype(np.float64) / float(1 << 24) < 1 / threshold - 1
    me = np.arange(len(node))
    for at, use in ((one, np.ones(len(node), bool)), (two, also)):
        rows.append(me[use])
        kids.append(mix(node[use] * np.uint64(0x9FB21C651E98DF25) + (at[use].astype(np.uint64) << np.uint64(32)) + sig[me[use], at[use]].astype(np.uint64)))
    return np.concatenate(rows), np.concatenate(kids)


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, T)


def _roots(trees: int, threshold: float):
    """(rep, sig) -> (node, rep) of the first level of all trees."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig, rep = _sigs(b.column(1)), b.column(0)
            for t in range(trees):
                root = np.full(b.num_rows, mix(np.array([t + 1], np.uint64))[0], np.uint64)
                rows, kids = _choose(root, sig, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(kids.view(np.int64)), rep.take(pa.array(rows))], names=["node", "rep"])

    return run


def _branch(threshold: float):
    """(node, rep, sig) -> (node, rep) of the next level."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                rows, kids = _choose(b.column(0).to_numpy().view(np.uint64), _sigs(b.column(2)), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(kids.view(np.int64)), b.column(1).take(pa.array(rows))], names=["node", "rep"])

    return run


def missed(trees: int, threshold: float) -> float:
    """Chance that a pair at the threshold meets in no node of GRID_LEVEL; its tokens agree by a binomial law."""
    k = np.arange(T + 1)
    q, also = k / T, 1 / threshold - 1
    weight = np.array([comb(T, int(i)) for i in k], float) * threshold**k * (1 - threshold) ** (T - k)
    x = np.zeros(T + 1)
    for _ in range(GRID_LEVEL):
        y = 1 - q + q * x
        x = (1 - also) * y + also * y * y
    return float((weight * x**trees).sum())


class _Sets:
    """Union-find over 0..n-1 whose heads are the smallest members."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def head(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.head(x), self.head(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _stars(uf: _Sets, ids) -> tuple[list, list]:
    a, b = [], []
    for x in range(len(ids)):
        h = uf.head(x)
        if h != x:
            a.append(ids[h])
            b.append(ids[x])
    return a, b


def _loose_links(loose: float):
    """(cell, rep, sig) sorted by cell -> spanning stars of the loose similarity of signatures."""
    need = int(np.ceil(loose * T))

    def run(batches):
        a, b = [], []
        for g in sorted_groups(batches):
            n = g.num_rows
            if n < 2:
                continue
            sig, ids = _sigs(g.column(2)), g.column(1).to_pylist()
            uf = _Sets(n)
            for i in range(n - 1):
                for j in np.flatnonzero((sig[i + 1:] == sig[i]).sum(1) >= need).tolist():
                    uf.join(i, i + 1 + j)
            x, y = _stars(uf, ids)
            a += x
            b += y
            if len(a) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _exact_links(num: int, den: int):
    """(cell, rep, set) sorted by cell -> spanning stars of num/den <= exact similarity, through the postings of the cell."""

    def run(batches):
        for g in sorted_groups(batches):
            n = g.num_rows
            if n < 2:
                continue
            ids = g.column(1).to_pylist()
            sets = [np.frombuffer(s, np.uint64) for s in g.column(2).to_pylist()]
            size = np.array([len(s) for s in sets])
            doc = np.repeat(np.arange(n), size)
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            flat, doc = flat[order], doc[order]
            edge = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]])) if len(flat) else np.zeros(1, np.int64)
            count = np.diff(edge)
            many = count > 1
            # postings of the shingles that two documents or more hold
            lists = np.flatnonzero(many)
            which = np.repeat(np.arange(len(count)), count)
            use = many[which]
            o2 = np.argsort(doc[use], kind="stable")
            dd, ww = doc[use][o2], which[use][o2]
            cut = np.searchsorted(dd, np.arange(n + 1))
            uf = _Sets(n)
            if len(lists):
                for i in range(n - 1):
                    mine = ww[cut[i]:cut[i + 1]]
                    if not len(mine):
                        continue
                    lo, ln = edge[mine], count[mine]
                    take = np.repeat(lo - np.concatenate([[0], np.cumsum(ln)[:-1]]), ln) + np.arange(int(ln.sum()))
                    common = np.bincount(doc[take], minlength=n)
                    union = size[i] + size - common
                    hit = den * common >= num * union
                    hit[: i + 1] = False
                    for j in np.flatnonzero(hit).tolist():
                        uf.join(i, j)
            a, b = _stars(uf, ids)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _sketch(batches):
    """(rep, set) -> (bucket, n): shingles counted in 2**SKETCH_BITS buckets, one array a task."""
    n = np.zeros(1 << SKETCH_BITS, np.int64)
    for b in batches:
        for x in b.column(1).to_pylist():
            np.add.at(n, _bucket(np.frombuffer(x, np.uint64)), 1)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])


def _bucket(g: np.ndarray) -> np.ndarray:
    return (mix(g) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _prefix(often: np.ndarray, num: int, den: int):
    """(rep, set) -> (rep, shingle): the rarest shingles, of which two sets at num/den have one in common at least."""

    def run(batches):
        for b in batches:
            for i, x in enumerate(b.column(1).to_pylist()):
                g = np.frombuffer(x, np.uint64)
                if len(g):
                    g = g[np.lexsort((g, often[_bucket(g)]))[: len(g) + (-num * len(g)) // den + 1]]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.full(len(g), i))), pa.array(g.view(np.int64))], names=["rep", "shingle"])

    return run


def _rare_cells(sets: DataFrame, comps: DataFrame, num: int, den: int, at, files: int) -> DataFrame:
    """(cell, rep): cells in which all documents meet that share a rare shingle and have different components.

    Shingles are ordered by their counts in a sketch; any order that all sets
    share is right, a better one only makes smaller groups. Groups of the same
    documents are compared once. In a large group, the largest component is
    compared with the rest, and the rest with itself.
    """
    often = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in sets.mapInArrow(_sketch, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        often[r["bucket"]] = r["n"]
    kind = sets.schema["rep"].dataType.simpleString()
    often = np.minimum(often, 2**31 - 1).astype(np.int32)
    groups = (sets.mapInArrow(_prefix(often, num, den), f"rep {kind}, shingle long")
              .join(comps.select(F.col("id").alias("rep"), F.col("component").alias("part")), "rep", "left")
              .select(F.col("shingle").alias("node"), "rep", F.coalesce("part", "rep").alias("part")).distinct())
    groups = put(groups, at("rare"), f"node long, rep {kind}, part {kind}", files)
    stats = (groups.groupBy("node", "part").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"))
             .groupBy("node").agg(F.sum("n").alias("size"), F.max(F.struct("n", "part")).alias("top"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.count("*").alias("parts"))
             .where("parts > 1").groupBy("size", "x", "y").agg(F.min(F.struct("node", "top")).alias("m")).select("m.node", "m.top", "size"))
    rows = groups.join(stats, "node").withColumn("main", F.col("part") == F.col("top.part"))
    step = CELL // 2
    rows = rows.withColumn("a", F.ceil(F.col("top.n") / step).cast("long")).withColumn("b", F.ceil((F.col("size") - F.col("top.n")) / step).cast("long"))
    rows = rows.withColumn("i", F.pmod(F.xxhash64("rep"), F.when(F.col("main"), F.col("a")).otherwise(F.col("b"))))
    to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    place = lambda side, x, y: F.struct(F.lit(side).alias("side"), x.alias("x"), y.alias("y"))
    zero = F.lit(0).cast("long")
    places = (F.when(F.col("size") <= CELL, F.array(place(0, zero, zero)))
              .when(F.col("main"), F.transform(to("b"), lambda j: place(1, F.col("i"), j)))
              .otherwise(F.concat(F.transform(to("a"), lambda j: place(1, j, F.col("i"))), F.transform(to("b"), lambda j: place(2, F.least(F.col("i"), j), F.greatest(F.col("i"), j))))))
    rows = rows.select("node", "rep", F.explode(places).alias("p"))
    return rows.select(F.xxhash64("node", "p.side", "p.x", "p.y").alias("cell"), "rep")


def _full_sets(batches):
    for batch in batches:
        for b in slices(batch, "text", 1 << 20):
            doc, g, n = shingles(b.column(1))
            cut = np.searchsorted(doc, np.arange(n + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary())], names=["rep", "set"])


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 85, den: int = 100, trees: int = TREES) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Links are den * intersection >= num * union."""
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "near-dedup")
    threshold = num / den
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    files = few_files(spark)
    at = lambda name: f"{root}/{name}"

    sig_schema = f"doc_id {kind}, n long, h1 long, h2 long, sig binary"
    all_rows = put(rows.mapInArrow(_signatures, sig_schema), at("signatures"), sig_schema)

    # one representative for each distinct set
    some = all_rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = put(some.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), at("classes"), f"n long, h1 long, h2 long, rep {kind}, copies long", files)
    reps = some.join(classes.select("n", "h1", "h2", F.col("rep").alias("doc_id")), ["n", "h1", "h2", "doc_id"], "left_semi") \
        .select(F.col("doc_id").alias("rep"), "sig").distinct()
    reps = put(reps, at("reps"), f"rep {kind}, sig binary", files)

    # trees: levels of nodes until all leaves are small enough
    node_schema = f"node long, rep {kind}"
    level, leaves = reps.mapInArrow(_roots(trees, threshold), node_schema), None
    for k in range(1, GRID_LEVEL + 1):
        level = put(level, at(f"paths-{k}"), node_schema, files)
        counts = level.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        nodes = put(level.join(counts, "node"), at(f"level-{k}"), f"{node_schema}, size long", files)
        limit = CELL if k < GRID_LEVEL else BIG
        done = nodes.where(F.col("size") <= limit)
        leaves = done if leaves is None else leaves.unionByName(done)
        more = nodes.where(F.col("size") > limit)
        if k == GRID_LEVEL or more.isEmpty():
            break
        level = more.select("node", "rep").join(reps, "rep").select("node", "rep", "sig").mapInArrow(_branch(threshold), node_schema)
    hot = more  # beyond BIG; empty if a level before had none

    link_schema = f"a {kind}, b {kind}"
    loose = (_cells(leaves, "node").join(reps, "rep").select("cell", "rep", "sig")
             .repartition(width, "cell").sortWithinPartitions("cell", "rep").mapInArrow(_loose_links(LOOSE), link_schema))
    families = put(connected_components(put(loose.distinct(), at("loose"), link_schema, files)).withColumnRenamed("id", "rep"), at("families"), f"rep {kind}, component {kind}", files)

    # exact confirmation, each family in cells; what is in a very large family or node in dealt cells, and then by its rarest shingles
    sizes = families.groupBy("component").agg(F.count("*").alias("size"))
    sized = join_counted(families, sizes, "component", "size", families.count())
    cells = _cells(sized.where(F.col("size") <= BIG).withColumnRenamed("component", "node"), "node")
    giant = sized.where(F.col("size") > BIG).select("rep")
    cells = cells.unionByName(_dealt(hot.unionByName(leaves.join(giant, "rep", "left_semi"))))
    heavy = put(hot.select("rep").union(giant).distinct(), at("heavy"), f"rep {kind}", files)
    set_schema = f"rep {kind}, set binary"

    def sets_of(ids: DataFrame) -> DataFrame:
        return rows.join(ids.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").mapInArrow(_full_sets, set_schema)

    def confirm(cells: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        exact = (cells.join(sets, "rep").select("cell", "rep", "set")
                 .repartition(width, "cell").sortWithinPartitions("cell", "rep").mapInArrow(_exact_links(num, den), link_schema))
        return put(exact.distinct(), at(name), link_schema, files)

    links = confirm(cells, sets_of(families.select("rep").union(heavy)), "links")
    comps = connected_components(links)
    if not heavy.isEmpty():
        sets = put(sets_of(heavy), at("heavy-sets"), set_schema)
        stars = comps.select(F.col("id").alias("a"), F.col("component").alias("b"))
        comps = connected_components(stars.unionByName(confirm(_rare_cells(sets, comps, num, den, at, files), sets, "heavy-links")))

    out = (all_rows.drop("sig").join(classes.where("copies > 1").drop("copies"), ["n", "h1", "h2"], "left")
           .withColumn("rep", F.coalesce("rep", "doc_id"))
           .join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
           .withColumn("component_id", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).otherwise(F.col("doc_id"))))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _cells(members: DataFrame, group: str) -> DataFrame:
    """(cell, rep): a group of up to CELL rows is a cell; a larger one is dealt to chunks, and each pair of chunks is a cell."""
    chunks = F.ceil(F.col("size") / (CELL // 2)).cast("long")
    rows = members.withColumn("__n", F.when(F.col("size") <= CELL, F.lit(1).cast("long")).otherwise(chunks))
    rows = rows.withColumn("__i", F.pmod(F.xxhash64("rep"), F.col("__n")))
    rows = rows.withColumn("__j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    return rows.select(F.xxhash64(group, F.least("__i", "__j"), F.greatest("__i", "__j")).alias("cell"), "rep").where("rep IS NOT NULL")


def _dealt(members: DataFrame) -> DataFrame:
    """(cell, rep): each node is dealt to cells of about CELL rows; not all its pairs meet."""
    chunks = F.ceil(F.col("size") / CELL).cast("long")
    return members.select(F.xxhash64("node", F.pmod(F.xxhash64("node", "rep"), chunks), F.lit("dealt")).alias("cell"), "rep").where("rep IS NOT NULL")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))
