"""F3 over a stored table: the rows of the plain filter, from fewer files."""
import random

import pytest
from pyspark.sql import functions as F

from readerflow.operators import dialogues as D
from readerflow.sources.line_index import RUN, LineIndex, keyword_grams

SCHEMA = "book_id long, dlg_ord long, speaker string, line string"


def rows_of(df):
    return sorted(((r.book_id, r.dlg_ord, r.speaker, r.line) for r in df.collect()), key=str)


def files_read(df):
    """Files of ``rows`` that the scans of the executed plan read."""
    jdf = df._jdf
    jdf.collectToPython()
    total, todo = 0, [jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        elif kind == "FileSourceScanExec" and "/rows" in p.relation().location().rootPaths().head().toString():
            total += p.metrics().apply("numFiles").value()
        else:
            kids = p.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_equal_to_the_filter_and_fewer_files(spark, tmpdir_fresh):
    rng = random.Random(3)
    names = ["Heathcliff", "Queequeg", "Dorothea", "Ωmega Straße", "İnci", "a😀bc", "50%_x", "new\nline"]
    made = [(b, o, rng.choice(["A", None]), " ".join(rng.choice(["the", "sea", "said", "house", names[b % 8]]) for _ in range(6)))
            for b in range(40) for o in range(30)]
    made += [(1, 900, "A", None), (2, 900, "A", ""), (3, 900, "A", "ab"), (3, 900, "A", "ab"), (4, RUN * 5, None, "far away Queequeg"), (5, 901, "A", "long " * 40_000 + "Zanzibar")]
    df = spark.createDataFrame(made, SCHEMA)
    t = LineIndex(spark, f"{tmpdir_fresh}/t", df.schema, parts=64)
    t.add(df.filter("book_id < 20"))
    t.add(df.filter("book_id >= 20"))  # a second load
    assert rows_of(t.read()) == rows_of(df)
    everything = files_read(t.search(""))
    for word in ("QUEEQUEG", "heathcliff", "sea said", "Ωmega strasse", "straße", "inci", "😀bc", "50%_", "w\nli", "zanzibar", "ab", "", None, "nowhere", "the the the the the the the"):
        assert rows_of(t.search(word)) == rows_of(df.filter(D.keyword_contains(word))), word
    assert files_read(t.search("nowhere")) == 0
    assert files_read(t.search("zanzibar")) <= 2  # the loads' files of one part
    assert 0 < files_read(t.search("queequeg")) < everything / 3
    assert files_read(t.search("ab")) == everything


def test_every_keyword_gram_is_in_the_line(spark):
    lines = ["abcabcabc", "ÀÉÎ õü", "a😀😀b", "tab\tand\nbreak", "ſtraße", "ΣΑΣ ς"]
    from readerflow.sources.line_index import line_grams

    for r in spark.createDataFrame([(x,) for x in lines], "line string").select(F.lower("line").alias("low"), line_grams("line").alias("g")).collect():
        assert set(keyword_grams(r.low)) <= set(r.g), r


def test_empty_table_broken_load_and_clash(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, 1, "A", "Ishmael")], SCHEMA)
    t = LineIndex(spark, f"{tmpdir_fresh}/t", df.schema, parts=4)
    t.add(df.limit(0))
    assert t.search("ishmael").count() == 0 and t.search("").count() == 0
    t.add(df)
    # trigrams of a load whose rows were never written: more parts are looked at, no row is missed or made up
    spark.createDataFrame([(p, g) for p in range(4) for g in keyword_grams("ishmael")], "part int, gram string").write.mode("append").parquet(f"{t.path}/grams")
    assert rows_of(t.search("ishmael")) == rows_of(df)
    with pytest.raises(ValueError):
        LineIndex(spark, f"{tmpdir_fresh}/u", df.withColumn("part", F.lit(1)).schema)
