"""Classifiers: held-out accuracy; rules: brute force; odd inputs."""

import math
import random
import re
import time

import numpy as np
import pytest
from brute_path import brute
from pyspark.sql import functions as F

from readerflow.llm import op1_quality_fm as op1
from readerflow.llm import op2_quality_rules as op2
from readerflow.llm import op9_toxicity as op9
from readerflow.llm.common import table

SF = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "long " * 60_000), (6, "é ü ñ " * 40), (6, "é ü ñ " * 40), (None, "no id here at all"), (7, "a\nb\na\nb\n" * 30)]


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def _rates(scored, labels, column):
    rows = scored.join(labels, "doc_id").where("held_out").groupBy(F.col(column).alias("y"), "predicted").count().collect()
    n = {(r["y"], r["predicted"]): r["count"] for r in rows}
    return n.get((1, 1), 0) / max(1, n.get((1, 1), 0) + n.get((1, 0), 0)), n.get((0, 0), 0) / max(1, n.get((0, 0), 0) + n.get((0, 1), 0))


def test_quality_held_out(spark):
    scored = op1.op1(spark, SF).cache()
    good, bad = _rates(scored, table(spark, SF, "labels"), "quality")
    assert good >= 0.98 and bad >= 0.9
    assert scored.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.3)").count() == 0


def test_toxicity_held_out(spark):
    scored = op9.op9(spark, SF).cache()
    toxic, clean = _rates(scored, table(spark, SF, "labels"), "toxic")
    assert toxic >= 0.9 and clean >= 0.98
    assert scored.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0


def test_factorisation_identity():
    rng = np.random.default_rng(3)
    size = (1 << op1.BITS) + 200
    m = op1.Machine(0.3, rng.normal(size=size).astype(np.float32), rng.normal(size=(size, 4)).astype(np.float32))
    idx, val = rng.choice(size, 12, replace=False), rng.normal(size=12)
    pairs = sum(float(m.factors[i] @ m.factors[j]) * val[a] * val[b] for a, i in enumerate(idx) for b, j in enumerate(idx) if a < b)
    want = 0.3 + float((m.linear[idx] * val).sum()) + pairs
    assert m.logits(np.zeros(12, np.int64), idx, val, 1)[0] == pytest.approx(want, rel=1e-4)


def test_quality_odd_rows(spark, documents):
    docs = documents(ODD)
    machine = op1.fit(docs, _labels(spark, [(4, 1, 0), (5, 0, 0), (6, 1, 0), (7, 0, 0), (1, None, None)]), metadata=("n_chars",))
    rows = op1.quality_scores(docs, machine).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert op1.keep_good(docs, machine, 0.0).columns == docs.columns
    assert op1.keep_good(docs, machine, 0.0).count() == len(ODD)
    none = op1.fit(docs, _labels(spark, []))
    assert {r["score"] for r in op1.quality_scores(docs, none).collect()} == {0.5}
    assert op1.quality_scores(documents([]), none).count() == 0


def test_rules_equal_brute_force(spark, documents):
    rng = random.Random(5)
    vocab = ["alpha", "béta", "gamma***", "d", "e#", "<f>", "zwölf"]
    rows = [(i, "".join(rng.choice(vocab) + rng.choice([" ", "\n", "\t", " \n\n", "\x0b"]) for _ in range(rng.choice([0, 3, 40, 60, 200])))) for i in range(60)] + ODD
    out = op2.judge(documents(rows), np.zeros(1 << 10, np.float32)).collect()
    want = sorted(((i, *b.values()) for i, b in ((i, brute.base_rules(t)) for i, t in rows)), key=str)
    keys = list(brute.base_rules("").keys())
    assert sorted(((r["doc_id"], *(r[k] for k in keys)) for r in out), key=str) == want
    assert all(r["kept"] == (not r["base_failed"]) for r in out)  # all ratios are 0 here


def test_ratio_equals_plain_counts(spark, documents):
    rows = [(i, t) for i, t in enumerate(["a b c a b", "x y z", "a b", None, "", "x x x y"] * 3)]
    docs = documents(rows)
    trusted = docs.where("doc_id % 2 = 0").select("doc_id")
    bits = 16
    ratios = op2.ratio_table(op2.ngram_counts(docs, trusted, bits=bits), bits)
    corpus, target = brute.ngram_counts(t for _, t in rows), brute.ngram_counts(t for i, t in rows if i % 2 == 0)
    size, a = 1 << bits, op2.ALPHA
    nc, nt = sum(corpus.values()), sum(target.values())
    of = {g: math.log((target.get(g, 0) + a) / (nt + a * size)) - math.log((n + a) / (nc + a * size)) for g, n in corpus.items()}
    got = {r["doc_id"]: r["llr"] for r in op2.judge(docs, ratios).collect()}
    for i, t in rows:
        w = brute.words(t)
        grams = [*((x,) for x in w), *zip(w, w[1:])]
        assert got[i] == pytest.approx(sum(of[g] for g in grams) / max(1, len(grams)), abs=1e-5)
    assert not op2.ratio_table(op2.ngram_counts(docs, trusted.limit(0), bits=8), 8).any()
    assert op2.judge(documents([]), ratios).count() == 0


def test_ratio_counts_every_trusted_document(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('w', id % 7) AS text")
    want = spark.range(1, 30_000).selectExpr("id AS doc_id")
    n = op2.ngram_counts(docs, want, bits=10).agg(F.sum("corpus"), F.sum("target")).first()
    assert tuple(n) == (30_000, 29_999)
    # rows without an id and repeated rows are counted; so is a trusted id given twice, once
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a"), (1, "a"), (2, "c")], "doc_id long, text string")
    n = op2.ngram_counts(odd, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long"), bits=10).agg(F.sum("corpus"), F.sum("target")).first()
    assert tuple(n) == (9, 2)


def test_trusted_ids_beyond_the_filter(spark, monkeypatch):
    monkeypatch.setattr(op2, "FILTER_BITS", 64)  # nearly all bits are set: the join alone decides
    docs = spark.range(2_000).selectExpr("id AS doc_id", "concat('w', id % 7) AS text")
    n = op2.ngram_counts(docs, spark.range(0, 2_000, 5).selectExpr("int(id) AS doc_id"), bits=10).agg(F.sum("corpus"), F.sum("target")).first()
    assert tuple(n) == (2_000, 400)


def test_rules_keep_good_documents(spark):
    out = op2.op2(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("NOT base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.01 * n[(1, True)]
    assert n.get((0, False), 0) > 5 * n.get((0, True), 0)


def test_toxicity_folding_and_exceptions():
    lex = op9.Lexicon({"idiot": 3.0, "trash": 2.0})
    assert lex.evidence("You 1d10t, TRАSH!")[:2] == (5.0, 2)  # digits and a Cyrillic letter
    assert lex.evidence("put it into the trash can")[:2] == (0.0, 0)
    assert lex.evidence("ideas and strashing")[:2] == (0.0, 0)  # stems begin words
    assert lex.evidence(None) == (0.0, 0, 0)


def test_toxicity_matcher_equals_plain_search():
    """Heaviest stem of each word, no word that begins inside an exception phrase."""
    rng = random.Random(9)
    stems = {"tra": 1.0, "trash": 2.5, "clow": 3.0, "scum": 1.5, "lo": 0.5, "loser": 2.0}
    lex = op9.Lexicon(stems)
    vocab = ["trash", "TR4SH", "can", "bin", "class", "clown", "fish", "car", "sore", "loser", "rule", "pond", "scum", "local", "ok", "trace", "-", "clowns"]
    for _ in range(300):
        t = op9.fold(" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))))
        spans = [(m.start(), m.start() + len(p)) for p in map(op9.fold, op9.EXCEPTIONS) for m in re.finditer(f"(?={re.escape(p)})", t)]
        hits = []
        for m in re.finditer(r"(?<= )\S+", t):
            fit = [w for s, w in stems.items() if m.group().startswith(s)]
            if fit and not any(a < m.start() < b for a, b in spans):
                hits.append(max(fit))
        assert lex.evidence(t[1:])[:2] == (sum(hits), len(hits))


def test_toxicity_time_is_linear():
    text = "trash trash can clown fish " * 60_000
    t = time.perf_counter()
    lex = op9.Lexicon({"trash": 2.0, "clow": 1.0})
    assert lex.evidence(text)[1] == 60_000 and time.perf_counter() - t < 10


def test_toxicity_odd_rows(spark, documents):
    docs = documents(ODD)
    for lex in (op9.Lexicon({}), op9.fit_lexicon(docs, _labels(spark, [])), op9.fit_lexicon(docs, _labels(spark, [(4, 1, 1), (5, 1, 0), (6, 1, 0), (2, 0, None)]), min_docs=1)):
        rows = op9.toxicity_scores(docs, lex).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert op9.toxicity_scores(documents([]), op9.Lexicon({})).count() == 0


def test_toxicity_learns_exceptions(spark, documents):
    """A pair that clean rows share is no hit and no longer counts against its stem; a pair of toxic rows stays one."""
    rng = random.Random(4)
    words = ["".join(rng.choice("bdlmnpr") + rng.choice("aeiou") for _ in range(3)) for _ in range(60)]
    body = lambda: " ".join(rng.choice(words) for _ in range(12))
    rows, marks = [], []
    for k in range(600):
        toxic = k % 3 == 0
        extra = "you vermix fool" if toxic else "the vermix plant" if k % 60 == 1 else "calm"
        rows.append((k, f"{body()} {extra} {body()}"))
        marks.append((k, 1, int(toxic)))
    lex = op9.fit_lexicon(documents(rows), _labels(spark, marks))
    assert "vermix plant" in lex.exceptions and "the vermix" in lex.exceptions and not any("you" in p.split() for p in lex.exceptions)
    assert set(op9.EXCEPTIONS) < set(lex.exceptions)
    assert lex.evidence("A Verm1x, plant")[1] == 1 and lex.evidence("a VERM1X plant grew")[1] == 0 and lex.evidence("you vermix")[1] >= 1
    assert lex.judge("you vermix fool")[3] > 0.5 > lex.judge("a vermix plant grew there")[3]
    plain = op9.fit_lexicon(documents(rows), _labels(spark, marks), max_exceptions=0)
    stem = next(t for t in lex.weights if "vermix".startswith(t))
    assert plain.exceptions == op9.EXCEPTIONS and lex.weights[stem] > plain.weights.get(stem, 0.0)
