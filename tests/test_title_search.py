"""Approximate search equals comparing all pairs."""

import random

from pyspark.sql import functions as F

from readerflow import constants as K
from readerflow.functions.text import first_words
from readerflow.sources import title_search as TS


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _key(s):
    return " ".join((s or "").split()).lower()


def _budget(key, most=3):
    p = f"  {key}  "
    return min(most, (len({p[i:i + 3] for i in range(len(key) + 2)}) - 1) // 3)


def test_misspelt_titles_and_authors(spark):
    asked = ["Prid and Prejudise", "jane  AUSTIN", "Pride and Prejudice (Jane Austen)", "something else", "", None]
    got = TS.catalog_search_approximate(spark.createDataFrame([(a,) for a in asked], "q string")).collect()
    by = {}
    for r in got:
        by.setdefault(r["q"], set()).add((r["title"], r["distance"]))
    austen = next(t for t, _ in K.CATALOG if "Pride" in t)
    assert by == {asked[0]: {(austen, 2)}, asked[1]: {(t, 1) for t, _ in K.CATALOG if "Jane Austen" in t}, asked[2]: {(austen, 0)}}


def test_equal_to_all_pairs(spark):
    rng = random.Random(4)
    names = ["".join(rng.choice("abé ") for _ in range(rng.randint(0, 14))) for _ in range(150)] + ["a", "aa", "aaaaaaaaaaaa", "AB  ab", None]
    asked = []
    for n in names[:100]:
        s = list(n)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(s))
            s[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "c"])
        asked.append("".join(s))
    asked += ["aaaaaaaaaaa", "", None, asked[0]]
    got = TS.approximate_matches(spark.createDataFrame([(a,) for a in asked], "q string"), spark.createDataFrame([(n,) for n in names], "name string")).collect()
    want = {(a, n, d) for a in set(asked) for n in set(names) if _key(a) and _key(n) for d in [_distance(_key(a), _key(n))] if d <= _budget(_key(a))}
    assert sorted(map(tuple, got)) == sorted(want)


def test_no_pairs_of_all(spark):
    q = spark.range(10).selectExpr("concat('title number ', id) AS q")
    plan = TS.approximate_matches(q, q.withColumnRenamed("q", "name"))._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_few_titles_are_compared(spark):
    # titles of few words share their trigrams: what is compared is what shares a quarter of a title at its place
    rng = random.Random(7)
    few = ["the", "and", "of", "old", "sea", "house", "river"]
    names = sorted({" ".join(rng.choice(few) for _ in range(7)) for _ in range(400)})
    asked = [n[:3] + n[4:] for n in names[::8]]
    q = spark.createDataFrame([(a,) for a in asked], "q string").withColumnRenamed("q", "q_key").withColumn("k", TS.edit_budget(F.col("q_key")))
    n = spark.createDataFrame([(a,) for a in names], "name_key string")
    met = TS.search_segments(q).join(TS.title_segments(n), "segment").count()
    assert met < len(asked) * len(names) / 20
    got = TS.approximate_matches(q, n, "q_key", "name_key").collect()
    want = {(a, b, _distance(a, b)) for a in asked for b in names if abs(len(a) - len(b)) <= 3 and _distance(a, b) <= _budget(a)}
    assert sorted(map(tuple, got)) == sorted(want)


def test_first_words(spark):
    texts = ["", "  ", "a", " a b\tc ", "a\u3000b\u00a0c d", "\u2003x y z", None, "a\x1fb c" * 3]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", first_words("t", 2).alias("w")).collect()
    assert {r.k: r.w for r in got} == {k: None if t is None else t.split()[:2] for k, t in enumerate(texts)}
