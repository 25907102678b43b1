"""S6 atomic tables, S7 failed reloads, X1 windows, C4 numbered turns in batch and as a stream."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readerflow import constants as K
from readerflow.operators import chapters as CH
from readerflow.operators import conversation as C
from readerflow.sources import books as B
from readerflow.sources import media as M
from readerflow.sources import tables
from readerflow.streaming import chat as CHAT


# --- S6
def _rows(spark, rows):
    return spark.createDataFrame(rows, "book_id long, n int, v string")


def _held(t, version=None):
    return sorted((tuple(r) for r in t.read(version).collect()), key=str)


def test_atomic_replace(spark, tmp_path):
    t = tables.KeyedTable(spark, str(tmp_path / "t"))
    old = [(i, j, f"{i}-{j}") for i in range(30) for j in range(3)] + [(None, 0, "null")]
    assert t.replace(_rows(spark, old), "book_id", 4) == 1
    new = [(3, 0, "new"), (4, 0, "new")]
    assert t.replace(_rows(spark, new), "book_id", 4, gone=spark.createDataFrame([(7,), (99,)], "book_id long")) == 2
    want = sorted([r for r in old if r[0] not in (3, 4, 7)] + new, key=str)
    assert sorted(_held(t), key=str) == want and sorted(_held(t, 1), key=str) == sorted(old, key=str)
    t.vacuum()
    assert sorted(_held(t), key=str) == want and t.versions() == [2]
    t.replace(_rows(spark, []), "book_id", 4, gone=spark.createDataFrame([(i,) for i in [*range(30), None]], "book_id long"))
    assert _held(t) == []


def test_atomic_replace_cut_off_at_each_step(spark, tmp_path, monkeypatch):
    """A write that breaks before the switch changes nothing, and the next one succeeds."""
    t = tables.KeyedTable(spark, str(tmp_path / "t"))
    t.replace(_rows(spark, [(1, 0, "a"), (2, 0, "b")]), "book_id", 2)

    def broken(*a, **k):
        raise RuntimeError("cut off")

    real = tables.KeyedTable._switch
    bad = _rows(spark, [(1, 0, "x")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        t.replace(bad, "book_id", 2)  # while the data are written
    monkeypatch.setattr(tables.KeyedTable, "_switch", broken)
    with pytest.raises(RuntimeError):
        t.replace(_rows(spark, [(1, 0, "x")]), "book_id", 2)  # before the switch
    monkeypatch.setattr(tables.KeyedTable, "_switch", real)
    assert _held(t) == [(1, 0, "a"), (2, 0, "b")]
    t.replace(_rows(spark, [(1, 0, "x")]), "book_id", 2)
    t.vacuum()
    assert _held(t) == [(1, 0, "x"), (2, 0, "b")] and sum(1 for _ in (tmp_path / "t" / "data").rglob("bucket=*")) <= 2


def test_reader_and_second_writer_during_a_write(spark, tmp_path, monkeypatch):
    t = tables.KeyedTable(spark, str(tmp_path / "t"))
    t.replace(_rows(spark, [(1, 0, "a"), (2, 0, "b")]), "book_id", 2)
    before = t.read()
    seen, real = [], tables.KeyedTable._switch

    def between(self, manifest):
        monkeypatch.setattr(tables.KeyedTable, "_switch", real)
        seen.append(_held(t))  # all data of the first writer are there, the switch is not
        tables.KeyedTable(spark, t.path).replace(_rows(spark, [(2, 0, "second")]), "book_id", 2)
        real(self, manifest)

    monkeypatch.setattr(tables.KeyedTable, "_switch", between)
    with pytest.raises(tables.ConcurrentWrite):
        t.replace(_rows(spark, [(1, 0, "first"), (2, 0, "first")]), "book_id", 2)
    assert seen == [[(1, 0, "a"), (2, 0, "b")]] and _held(t) == [(1, 0, "a"), (2, 0, "second")]
    assert sorted(tuple(r) for r in before.collect()) == [(1, 0, "a"), (2, 0, "b")]  # a reader that began earlier


def test_another_bucket_number_raises(spark, tmp_path):
    t = tables.KeyedTable(spark, str(tmp_path / "t"))
    t.replace(_rows(spark, [(1, 0, "a")]), "book_id", 4)
    with pytest.raises(ValueError, match="4 buckets"):
        t.replace(_rows(spark, [(1, 0, "b")]), "book_id", 7)
    M.write_keyed(_rows(spark, [(i, 0, "a") for i in range(9)]), str(tmp_path / "p"), "book_id", 4)
    with pytest.raises(ValueError, match="4 buckets"):
        M.write_keyed(_rows(spark, [(1, 0, "b")]), str(tmp_path / "p"), "book_id", 7)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 9


# --- S7
def test_reload_without_a_text_keeps_the_old_one(spark):
    marked = f"x\n{K.START_MARKERS[0]} T ***\n \t\n{K.END_MARKERS[0]} T ***\nfooter"
    loads = spark.createDataFrame([(1, 1, "good text"), (1, 2, " \n\t"), (1, 3, marked), (1, 4, None), (2, 1, ""), (3, 1, "a"), (3, 2, "b")], "book_id long, load_seq int, raw_text string")
    assert sorted(tuple(r) for r in B.latest_loads(loads).collect()) == [(1, 1, "good text"), (3, 2, "b")]


# --- X1
def _windows(spark, bodies, budget):
    clean = spark.createDataFrame([(i, "CHAPTER I\n" + b) for i, b in enumerate(bodies)], "book_id long, text string")
    out = {}
    for r in CH.chapter_windows(clean, budget).orderBy("book_id", "window_no").collect():
        assert r["window_no"] == len(out.setdefault(r["book_id"], []))
        out[r["book_id"]].append(r["window"])
    return [out.get(i, []) for i in range(len(bodies))]


def _check(body, windows, budget):
    assert "".join(windows) == body and all(0 < len(w) <= budget for w in windows)
    cuts, at = set(), 0
    for w in windows[:-1]:
        at += len(w)
        cuts.add(at)
    # no paragraph that fits is cut
    for p in re.finditer(r"(?s).*?(?:\n{2,}|\Z)", body):
        if 0 < len(p.group()) <= budget:
            assert not any(p.start() < c < p.end() for c in cuts)
        else:  # no quotation in it that fits either
            for q in re.finditer('"[^"]*"|“[^”]*”', p.group()):
                if len(q.group()) <= budget and p.group()[:q.start()].count('"') % 2 == 0 and "“" not in p.group():
                    assert not any(p.start() + q.start() < c < p.start() + q.end() for c in cuts)


def test_windows_at_natural_borders(spark):
    quote = '"' + "that is cut " * 5 + '"'
    bodies = ["short.", "a " * 60 + quote + " said Ann.", ("One two three. " * 6 + "\n\n") * 8, "x" * 350, "“" + "é " * 30 + "” she said. " * 9, '"' + "open " * 100, quote * 6, "a\n\n\n\nb", ". " * 200,
              "w " * 20_000 + "\n\n" + "Long. " * 9000]
    for budget in (100, 4000):
        for body, w in zip(bodies, _windows(spark, bodies, budget)):
            _check(body.strip(), w, budget)
    assert _windows(spark, ["a " * 40 + quote], 100)[0] == ["a " * 40, quote]
    assert _windows(spark, [""], 100) == [[]]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(bodies=st.lists(st.text(alphabet='ab "“”.!\né', min_size=1, max_size=300), min_size=8, max_size=25), budget=st.integers(5, 60))
def test_windows_property(spark, bodies, budget):
    bodies = ["x" + re.sub(r"\s+\Z", "", b) for b in bodies]
    for body, w in zip(bodies, _windows(spark, bodies, budget)):
        assert "".join(w) == body and all(0 < len(x) <= budget for x in w)
        if '"' not in body and "“" not in body:
            _check(body, w, budget)


# --- C4
def _chat(spark):
    setups = spark.createDataFrame([(1, "s", "Hero", ["A", "B"], "o", []), (2, "s", None, None, "o", [])],
                                   "conv_id long, scenario string, user_role string, ai_roles array<string>, opening_line string, vocabulary_tips array<string>")
    history = spark.createDataFrame([(1, 0, "assistant", "o"), (1, 1, "user", "u")], "conv_id long, turn long, role string, content string")
    rows = [(c, k, f"in {c}.{k}", f"out {c}.{k}") for c in (1, 2, 3) for k in range(1, 9)]
    return setups, history, rows


def test_several_inputs_are_numbered(spark):
    setups, history, rows = _chat(spark)
    got = C.append_turns(history, spark.createDataFrame(rows, CHAT.INPUT_SCHEMA), setups, "input_seq", block_size=3).orderBy("conv_id", "turn").collect()
    assert [(r["conv_id"], r["turn"]) for r in got] == [(c, base + k) for c, base in ((1, 2), (2, 0), (3, 0)) for k in range(16)]
    assert [r["content"] for r in got if r["conv_id"] == 1][:4] == ["in 1.1", "out 1.1", "in 1.2", "out 1.2"]
    assert {(r["conv_id"], r["role"], r["display_role"]) for r in got} == {(1, "user", "Hero"), (1, "assistant", "A, B"), *((c, r, d) for c in (2, 3) for r, d in (("user", K.DEFAULT_USER_ROLE), ("assistant", K.DEFAULT_AI_ROLE)))}


def test_stream_of_turns_equals_batch(spark, tmp_path):
    """Any order of files, repeats, restarts with new files, and a gap that is filled late."""
    setups, history, rows = _chat(spark)
    want = sorted(tuple(r) for r in C.append_turns(history, spark.createDataFrame(rows, CHAT.INPUT_SCHEMA), setups, "input_seq").collect())
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rng = random.Random(8)
    late = [r for r in rows if r[1] == 2]
    first = [r for r in rows if r[1] != 2]
    rng.shuffle(first)
    heads = history.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))

    def arrive(part):
        spark.createDataFrame(part, CHAT.INPUT_SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(CHAT.INPUT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        q = CHAT.start_turns(stream, heads, setups, out, check)
        assert q.awaitTermination(300)
        return sorted(tuple(r) for r in CHAT.read_turns(spark, out).collect())

    arrive(first[:10])
    arrive(first[10:] + first[:3] + [(None, 1, "x", "y"), (1, None, "x", "y")])
    got = run()
    assert got == [r for r in want if r[1] < (4 if r[0] == 1 else 2)]  # what comes after the gap waits
    arrive(late + late)
    assert run() == want
    arrive(rows[:5])
    assert run() == want
