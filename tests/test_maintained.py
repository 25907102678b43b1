"""S7 + A1-A3: maintained tables equal a full recomputation, and only touched buckets are read."""

import random
import shutil

import pytest

from readerflow.operators.maintained import MaintainedDialogues
from readerflow.sources.media import key_bucket

LOAD = "book_id long, load_seq int, raw_text string"
ROW = "book_id long, load_seq int, dlg_ord long, speaker string, difficulty string, line string"
LEVELS = ["Beginner", "Intermediate", "Advanced"]


def _facts(t):
    return {r["book_id"]: (r["load_seq"], r["n_dialogues"], {x["difficulty"]: x["n"] for x in r["n_by_difficulty"]}, r["speakers"]) for r in t.facts.read().collect()}


def _want(loads, rows):
    latest = {}
    for b, s, text in loads:
        if text and text.strip() and s > latest.get(b, -1):
            latest[b] = s
    mine = {b: [r for r in rows if r[0] == b and r[1] == s] for b, s in latest.items()}
    return {b: (s, len(mine[b]), {x: sum((r[4] or LEVELS[1]) == x for r in mine[b]) for x in LEVELS}, sorted({r[3] or "Unknown" for r in mine[b]})) for b, s in latest.items()}


def test_any_sequence_of_reloads(spark, tmp_path):
    rng = random.Random(2)
    t, loads, rows = MaintainedDialogues(spark, str(tmp_path), 5), [], []
    for step in range(1, 5):
        new = [(b, rng.choice([step, step, step - 1]), rng.choice(["text", "text", "text", " \n", None])) for b in rng.sample(range(12), 7)]
        new += [(new[0][0], step + 100, "")]
        d = [(b, s, k, rng.choice(["Ann", "Bob", None]), rng.choice([*LEVELS, None]), f"{b}.{s}.{k}") for b, s, _ in new[:-1] for k in range(rng.choice([0, 2, 3]))]
        # a load that was taken in before keeps what it brought then
        held = {(b, s) for b, s, x in loads if x and x.strip()}
        t.reload(spark.createDataFrame(new, LOAD), spark.createDataFrame(d, ROW))
        best = {b: v[0] for b, v in _want(loads, rows).items()}
        rows += [r for r in d if (r[0], r[1]) not in held and r[1] > best.get(r[0], -1)]
        loads += new
        assert _facts(t) == _want(loads, rows)
    want = _want(loads, rows)
    assert {r["line"] for r in t.dialogues.read().collect()} == {r[5] for r in rows if r[0] in want and want[r[0]][0] == r[1]}
    assert {r["metric"]: r["n"] for r in t.totals().collect()} == {
        "books": len(want), "dialogues": sum(v[1] for v in want.values()), "speakers": len({s for v in want.values() for s in v[3]})}


def test_untouched_buckets_are_not_read(spark, tmp_path):
    t = MaintainedDialogues(spark, str(tmp_path), 8)
    rows = [(b, 1, 0, "Ann", None, "x") for b in range(40)]
    t.reload(spark.createDataFrame([(b, 1, "t") for b in range(40)], LOAD), spark.createDataFrame(rows, ROW))
    before = t.dialogues.manifest()["buckets"]
    touched = {str(r[0]) for r in spark.createDataFrame([(3,), (4,)], "book_id long").select(key_bucket("book_id", 8)).collect()}
    for table in (t.dialogues, t.facts):
        for b, v in table.manifest()["buckets"].items():
            if b not in touched:
                shutil.rmtree(f"{table.path}/data/version={v}/bucket={b}")  # reading it would fail
    t.reload(spark.createDataFrame([(3, 2, "t"), (4, 2, "t")], LOAD), spark.createDataFrame([(3, 2, 0, "Bob", None, "y")], ROW))
    after = t.dialogues.manifest()["buckets"]
    assert {b for b in before if before[b] != after.get(b)} == touched
    got = {r["book_id"]: r["n_dialogues"] for r in t.facts.read_keys(spark.createDataFrame([(3,), (4,)], "book_id long"), "book_id").collect()}
    assert got == {3: 1, 4: 0}


def test_run_that_breaks_off_between_the_tables(spark, tmp_path, monkeypatch):
    t = MaintainedDialogues(spark, str(tmp_path), 4)
    one = (spark.createDataFrame([(1, 1, "t"), (2, 1, "t")], LOAD), spark.createDataFrame([(1, 1, 0, "Ann", None, "a"), (2, 1, 0, "Ann", None, "b")], ROW))
    two = (spark.createDataFrame([(1, 2, "t"), (2, 2, "t")], LOAD), spark.createDataFrame([(1, 2, 0, "Bob", None, "c"), (1, 2, 1, "Bob", None, "d")], ROW))
    t.reload(*one)

    def broken(*a):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        m.setattr(MaintainedDialogues, "_facts", broken)
        with pytest.raises(RuntimeError):
            t.reload(*two)
    assert {b: v[1] for b, v in _facts(t).items()} == {1: 1, 2: 1}  # still those of the first load
    t.reload(*two)
    assert {b: (v[0], v[1]) for b, v in _facts(t).items()} == {1: (2, 2), 2: (2, 0)}
