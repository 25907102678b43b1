"""Line, suffix and near-duplicate removal, decontamination and packing against brute force."""

import random

import pyarrow as pa
import pytest
from brute_path import brute
from pyspark.sql import functions as F

from readerflow.llm import op3_line_dedup as op3
from readerflow.llm import op6_suffix_dedup as op6
from readerflow.llm import op7_packing as op7
from readerflow.llm import op8_decontaminate as op8
from readerflow.llm import op10_near_dedup as op10
from readerflow.llm.components import connected_components, join_counted

VOCAB = [f"w{i}" for i in range(300)]


def _say(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


# --- lines

def test_lines_equal_brute_force(documents):
    rng = random.Random(1)
    lines = ["  Shared Line number ONE\t", "shared line number one", "short", "ÄHNLICHE Zeile mit Ä", "ähnliche zeile mit ä", "ÄHNLICHE zeile mit Ä", "", "another frequent line"]
    rows = [(i, "\n".join(rng.choice([*lines, _say(rng, 4)]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "\n".join(f"line no {i} of many lines" for i in range(3000))), (104, "\n".join(f"line no {i} of many lines" for i in range(0, 3000, 2)))]
    want = brute.line_dedup(rows)
    for batches, fanout in ((1, 2), (4, 2), (7, 3)):
        got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in op3.dedup_lines(documents(rows), n_batches=batches, fanout=fanout).collect()}
        assert got == want


def test_lines_odd_rows(documents):
    rows = [(5, "a repeated long line\nx"), (5, "a repeated long line\nx"), (None, "a repeated long line"), (9, "x\nA REPEATED long line")]
    got = sorted((str(r["doc_id"]), r["n_dropped"], r["text"]) for r in op3.dedup_lines(documents(rows)).collect())
    assert got == [("5", 0, rows[0][1]), ("5", 0, rows[0][1]), ("9", 1, "x"), ("None", 0, "a repeated long line")]
    assert op3.dedup_lines(documents([])).count() == 0


def test_lines_of_text_ids(spark):
    rng = random.Random(8)
    lines = ["a line of the first kind", "a line of the second kind", "short", "a third line with words"]
    ids = ["", "é", "a", "a:1", "abcdefgh1", "abcdefgh2", "abcdefg", "Z", "\U0001f600", "￿", *(f"doc-{k}" for k in range(30)), *(str(k) for k in range(20))]
    rows = [(i, "\n".join(rng.choice([*lines, _say(rng, 4)]) for _ in range(rng.randint(1, 8)))) for i in ids]
    want = brute.line_dedup([(i.encode(), t) for i, t in rows])
    before = {t.name for t in spark.catalog.listTables()}
    got = {r["doc_id"].encode(): (r["n_lines"], r["n_dropped"], r["text"]) for r in op3.dedup_lines(spark.createDataFrame(rows, "doc_id string, text string"), n_batches=5).collect()}
    assert got == want
    assert {t.name for t in spark.catalog.listTables()} == before


def test_runs_compact(spark, tmp_path):
    runs = op3.LineRuns(spark, str(tmp_path), fanout=2, buckets=2)
    for k in range(5):
        runs.admit(spark.createDataFrame([(k, 1, 1), (k, k + 10, 2)], "doc_id long, h1 long, h2 long"))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    assert sorted(tuple(r) for r in runs.owners().collect()) == [(1, 1, 0), *((k + 10, 2, k) for k in range(5))]


# --- contamination in blocks

def test_contaminated_rows_go_whatever_the_blocks(spark, documents):
    rng = random.Random(11)
    items = [_say(rng, 20) for _ in range(12)]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")
    rows = [(k, _say(rng, 30) + " " + items[k % 12] + " " + _say(rng, 5)) for k in range(24)] + [(k, _say(rng, 60)) for k in range(30, 50)]
    rows += [(60, None), (61, ""), (None, rows[0][1]), (None, "clean text"), (3, rows[3][1])]
    want = sorted((str(i), t) for i, t in rows if not any(op8.normal(x) in op8.normal(t) for x in items))
    for size in (10**6, 300, 1):
        out = op8.drop_contaminated(documents(rows), bench, block_chars=size)
        assert out.columns == documents(rows).columns and out._jdf.queryExecution().toString().count("MapInArrow") == 0
        assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == want
    assert op8.drop_contaminated(documents(rows), bench.limit(0)).count() == len(rows)
    assert op8.drop_contaminated(documents([]), bench).count() == 0


# --- repeated strings

def _repeat_rows(rng):
    shared = [_say(rng, 60) for _ in range(4)]
    rows = []
    for i in range(50):
        t = _say(rng, rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            a = rng.randint(0, 80)
            t += rng.choice([" ", "\n", "é"]) + s[a:a + rng.randint(20, 200)] + rng.choice(["", " x "]) + _say(rng, rng.randint(0, 10))
        rows.append((i, t))
    return rows + [(100, None), (101, ""), (102, "For " * 300), (103, "x For " + "For " * 200 + "end"), (104, rows[3][1]), (104, rows[3][1]), (None, rows[5][1]), (106, "ab" * 90)]


@pytest.mark.parametrize("limit", [2048, 3])
def test_repeats_equal_brute_force(documents, limit):
    rows = _repeat_rows(random.Random(2))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op6.remove_repeats(documents(rows), length=60, gram=12, limit=limit).collect())
    assert got == sorted((str(i), *x) for (i, _), x in zip(rows, brute.repeats([t for _, t in rows], 60)))


def test_repeats_periodic(documents, monkeypatch):
    """Runs of all kinds of periods, texts that hold one of a run's strings once, a text over several slices."""
    rng = random.Random(7)
    run = ("abcde" * 100)[:240]
    rows = [(0, "a" * 300), (1, "zz" + "a" * 61), (2, "a" * 60), (3, "b" * 60), (4, "x" + run + "y"), (5, _say(rng, 9) + run[3:63] + _say(rng, 9)), (6, "cd" * 31 + "c"), (7, "cd" * 30),
            (8, "q" + "cd" * 30), (9, ("p" * 30 + "q") * 9 + "r" + ("p" * 30 + "q") * 2), (10, "é" * 200), (11, "w" + "é" * 30 + "v"), (12, "ab" * 20 + "ba" * 40 + "ab" * 15), (13, "k" * 59), (14, "fghij" * 12)]
    rows += [(20 + k, "".join(rng.choice(["a" * 70, "ab" * 40, "abc" * 25, "x", "a" * 20, "ab" * 10, "yz"]) for _ in range(rng.randint(1, 6)))) for k in range(60)]
    rows += [(100, "".join(rng.choice("abcdefgh") for _ in range(3000)) + "t" * 3000 + _say(rng, 500))]
    want = sorted((str(i), *x) for (i, _), x in zip(rows, brute.repeats([t for _, t in rows], 60)))
    for size, limit in ((op6.SLICE, 2048), (700, 3)):
        monkeypatch.setattr(op6, "SLICE", size)
        got = op6.remove_repeats(documents(rows), length=60, gram=12, limit=limit).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_repeats_periodic_long(documents):
    """A run of one letter, longer than a slice of texts, has few anchors and goes whole."""
    for text, most in (("a" * 600_000, 2), ("lorem ipsum dolor " * 34_000, 40)):
        chosen, runs = op6.anchors(op6.Bytes(pa.array([text])), 400, 128)
        assert len(chosen) <= most and [(a, b) for a, b, _ in runs] == [(0, len(text))]
    got = op6.remove_repeats(documents([(1, "a" * 600_000), (2, "x" + "a" * 400 + "y"), (3, "u" + "a" * 399 + "v")])).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["n_spans"]) for r in got) == [(1, 600_000, 1), (2, 400, 1), (3, 0, 0)]


def test_repeats_odd_tables(documents):
    assert op6.remove_repeats(documents([])).count() == 0
    assert [r["n_removed"] for r in op6.remove_repeats(documents([(1, None), (2, "short")])).collect()] == [0, 0]


def test_interval_tree_gives_all_occurrences():
    # three suffixes share 4 bytes to the right, two of them also 3 to the left
    groups = list(op6.repeat_groups([b"xxabc", b"yyabc", b"zzzzc"], [b"gramA", b"gramB", b"gramC"], 7))
    assert [(sorted(m.tolist()), right) for m, _, right in groups] == [([0, 1], 4)]
    groups = list(op6.repeat_groups([b"xxabc", b"yyabc", b"zzzzc"], [b"gramA", b"gramB", b"gramC"], 5))
    assert [(sorted(m.tolist()), right) for m, _, right in groups] == [([0, 1, 2], 4)]


def test_stack_scan_intervals():
    assert sorted(op6.intervals([2, 3, 1])) == [(0, 0, 3), (1, 0, 3), (2, 0, 2), (3, 1, 2)]


# --- near duplicates

def _near_rows(rng):
    rows, n = [], 0
    for _ in range(12):
        base = _say(rng, rng.randint(30, 160)).split()
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            rows.append((n, " ".join(w)))
            n += 1
    rng.shuffle(rows)
    return rows + [(1000, None), (1001, " \n"), (1002, "two words"), (1003, "TWO  Words"), (1004, "two"), (1005, rows[0][1].upper())]


def test_near_equal_brute_force(documents):
    rows = _near_rows(random.Random(3))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in op10.near_components(documents(rows)).collect()}
    assert got == brute.near_components(rows)


def test_near_large_family(documents, monkeypatch):
    """Nodes and families beyond a cell branch and are confirmed on the grid of their cells."""
    rng = random.Random(4)
    base = _say(rng, 120).split()
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice([1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(VOCAB)
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(op10, "CELL", 16)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in op10.near_components(documents(rows), trees=12).collect()}
    assert got == brute.near_components(rows)


@pytest.mark.parametrize("share, lowered", [(0.7, 24), (0.97, 24), (0.97, 200)])
def test_near_links_in_hot_groups(documents, monkeypatch, share, lowered):
    """Lone pairs inside a template below the threshold, and its near copies, beyond BIG documents a node or a family."""
    rng = random.Random(12)
    template, rows = _say(rng, 140).split(), []
    for i in range(150):
        own = int(140 * (1 - share)) + rng.randint(0, 6)
        w = [*template[: 140 - own], *(f"own{i}x{k}" for k in range(own))]
        rows.append((2 * i, " ".join(w)))
        if i % 2 == 0:
            w[rng.randint(5, 100)] = "other"
            w[-1] = "end"
            rows.append((2 * i + 1, " ".join(w[: rng.choice([140, 135])])))
    monkeypatch.setattr(op10, "CELL", 16)
    monkeypatch.setattr(op10, "BIG", lowered)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in op10.near_components(documents(rows)).collect()}
    assert got == brute.near_components(rows)


def test_near_recall_of_the_trees():
    assert op10.missed(op10.TREES, 0.85) < 1e-4


def test_near_odd_rows(documents):
    assert op10.near_components(documents([])).count() == 0
    rows = [(7, "a b c d e f g"), (7, "a b c d e f g"), (None, "a b c d e f g"), (3, "A b c d e f g")]
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in op10.near_components(documents(rows)).collect())
    assert got == [("3", 3, True), ("7", 3, False), ("7", 3, False), ("None", None, True)]


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    up = {}

    def head(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = head(a), head(b)
            up[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: head(x) for x in up}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination

def test_edit_distance_search():
    rng = random.Random(7)
    for _ in range(60):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 40)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 80)))
        d, _ = op8.best_distance(item, text, len(item))
        assert d == brute.edit_search(item, text)


def test_matches_equal_brute_force(spark, documents):
    rng = random.Random(8)
    items = [(i, _say(rng, rng.randint(3, 30))) for i in range(25)] + [(90, None), (91, ""), (92, "tiny"), (93, items_text := "equal items here and there again"), (94, items_text)]
    rows = []
    for i in range(120):
        t = _say(rng, rng.randint(0, 60))
        if rng.random() < 0.6:
            x = list(rng.choice(items[:25])[1])
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9, 15])):
                k = rng.randrange(len(x))
                x[k:k + rng.choice([0, 1])] = rng.choice(["", "z", "Q"])
            t += " " + "".join(x).upper() + "\n" + _say(rng, 5)
        rows.append((i, t))
    rows += [(500, None), (501, ""), (502, "TINY"), (503, items_text), (503, items_text), (None, items_text), (504, "x" * 200_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in rows:
        for j, x in items:
            n = op8.normal(x)
            if n and t and len(t) < 100_000 and brute.edit_search(n, op8.normal(t)) <= op8.budget(len(n)):
                want.add((i, j))
    docs = documents(rows)
    for chars in (op8.BLOCK_CHARS, 400):
        assert {(r["doc_id"], r["item_id"]) for r in op8.find_matches(docs, bench, block_chars=chars).collect()} == want
    assert op8.find_matches(docs, bench).count() == len(want)
    left = op8.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, _ in rows if i not in {d for d, _ in want})
    assert op8.find_matches(documents([]), bench).count() == 0
    assert op8.find_matches(docs, bench.limit(0)).count() == 0
    assert op8.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


# --- packing

def test_best_fit_equals_search_over_all_bins():
    rng = random.Random(9)
    for _ in range(40):
        cap = rng.choice([10, 100])
        ps = [(rng.randint(1, cap), rng.choice([None, "a", "a", "b", "c"]), rng.choice([None, *range(8)])) for _ in range(rng.randint(0, 80))]
        ps.sort(key=lambda p: -p[0])
        assert op7.best_fit(ps, cap) == brute.best_fit(ps, cap)


def test_packing_is_whole_and_free_of_conflicts(documents):
    rng = random.Random(10)
    rows = [(i, _say(rng, rng.choice([1, 3, 20, 64, 65, 300]))) for i in range(200)] + [(900, None), (901, ""), (902, " "), (903, "same"), (904, "same"), (905, "same"), (905, "same"), (None, "no id")]
    docs = documents(rows)
    for shard in (1_000_000, 50):
        out = op7.pack_documents(docs, capacity=64, shard_docs=shard).collect()
        by_doc, by_bin = {}, {}
        for r in out:
            by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
            if r["bin_id"] is not None:
                by_bin.setdefault(r["bin_id"], []).append((r["bin_offset"], r["length"], r["doc_id"]))
        for i, t in rows:
            n = len(brute.words(t))
            assert sum(x for _, x in by_doc[i]) == n * (2 if i == 905 else 1)
        for held in by_bin.values():
            held.sort()
            assert held[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(held, held[1:])) and held[-1][0] + held[-1][1] <= 64
            assert len({(i or 0) % 3 for _, _, i in held}) == len(held)
        assert sorted(r["doc_id"] for r in out if r["bin_id"] is None) == [900, 901, 902]
        assert len({r["bin_id"] for r in out if r["doc_id"] in (903, 904, 905)}) == 4
    assert op7.pack_documents(documents([])).count() == 0


def test_hubs_are_joined_where_they_are(spark):
    """Stars far over the bound of one task, a chain between them and small parts: the same components, with and without hubs."""
    edges = [(0, k) for k in range(1, 3000)] + [(9000, 3000 + k) for k in range(2000)] + [(2999, 6000), (6000, 6001), (6001, 4999)] + [(20_000 + 2 * k, 20_001 + 2 * k) for k in range(50)]
    frame = spark.createDataFrame(edges, "a long, b long")
    want = {k: 0 for k in [*range(5000), 6000, 6001, 9000]} | {20_000 + k: 20_000 + k - k % 2 for k in range(100)}
    for hub in (16, 10**6):
        assert {r["id"]: r["component"] for r in connected_components(frame, hub=hub).collect()} == want


def test_counted_join_sends_only_large_keys(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("u"), F.col("id").alias("v"))
    stats = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
    plain = sorted(map(tuple, rows.join(stats, "u").collect()))
    assert sorted(map(tuple, join_counted(rows, stats, "u", "d", 1000, hub=10).collect())) == plain
    assert sorted(map(tuple, join_counted(rows, stats, "u", "d", 1000, hub=1000).collect())) == plain
    assert join_counted(rows.limit(0), stats.limit(0), "u", "d", 1000, hub=10).count() == 0
