"""Property tests: Spark text semantics vs Python built-ins on random input.

Each property runs one Spark job over a whole batch of generated examples.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readerflow.functions import text as T
from readerflow.operators import chapters as CH
from readerflow.operators import practice as P

ALPHABET = st.sampled_from(list("ab c\t\n\r\x0b\x0c\x1c\x85\xa0  　xyzCHAPTERchapter IVX12") + ["﻿"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=20, max_size=60)
CFG = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@CFG
@given(TEXTS)
def test_strip_and_split_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", T.strip_ws("s").alias("st"), T.words("s").alias("w")).collect()
    for r in got:
        assert r.st == r.s.strip()
        assert list(r.w) == r.s.split()


@CFG
@given(TEXTS)
def test_cleaning_invariants(spark, texts):
    """No long newline or blank runs remain, cleaning again changes nothing, and all else is kept in order."""
    df = spark.createDataFrame([(t,) for t in texts], "s string").withColumn("p", T.preprocess("s")).withColumn("again", T.preprocess("p"))
    for r in df.collect():
        assert "\n\n\n" not in r.p and "  " not in r.p and "\t" not in r.p and "\r\n" not in r.p
        assert r.again == r.p
        solid = lambda x: [c for c in x if c not in " \t\r\n"]
        assert solid(r.p) == solid(r.s)
        assert r.p.count("\r") <= r.s.count("\r")


@CFG
@given(st.lists(st.tuples(st.text(alphabet=ALPHABET, max_size=30), st.text(alphabet=ALPHABET, max_size=30)), min_size=20, max_size=40))
def test_word_overlap_bounds(spark, pairs):
    df = spark.createDataFrame(pairs, "target string, answer string")
    rows = df.select(
        P.word_overlap("target", "answer").alias("p"),
        P.word_overlap("target", F.concat_ws(" ", "answer", "target")).alias("full"),
        "target",
    ).collect()
    for r in rows:
        assert 0.0 <= r.p <= 100.0
        if r.target.split():
            assert r.full == 100.0


UNI = st.sampled_from(list("ab \nCHAPTERchapterIVX1") + ["ı", "İ", "٣", " ", "\x85", "\xa0", "\u3000", "\x1c", "\r", "\t"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=UNI, max_size=60), min_size=20, max_size=40))
def test_chapter_split_invariants(spark, texts):
    """Titles hold the heading word, follow each other in the text, and with the bodies and the preface rebuild it."""
    df = spark.createDataFrame(list(enumerate(texts)), "book_id bigint, text string")
    split = {r.book_id: [(c.title, c.body) for c in r.chapters] for r in CH.with_chapter_array(df).collect()}
    parts = {r.book_id: (list(r.t), list(r.p)) for r in df.select("book_id", T.heading_titles("text").alias("t"), T.heading_pieces("text").alias("p")).collect()}
    for i, t in enumerate(texts):
        titles, pieces = parts[i]
        assert len(pieces) == len(titles) + 1
        rebuilt = pieces[0] + "".join(a + b for a, b in zip(titles, pieces[1:]))
        assert rebuilt == t
        if not titles:
            assert split[i] == [("Full Text", t)]
            continue
        assert [x for x, _ in split[i]] == [x.strip() for x in titles]
        assert [x for _, x in split[i]] == [x.strip() for x in pieces[1:]]
        for x in titles:
            assert x[:7].upper() in ("CHAPTER", "CHAPTER") and any(c.isspace() for c in x)


HEADING_CASES = [  # (text, [(title, body)]), worked out by hand
    ("no heads", [("Full Text", "no heads")]),
    ("pre\nChapter 2\nb", [("Chapter 2", "b")]),
    ("CHAPTER I", [("CHAPTER I", "")]),
    ("see chapter called x\nmore", [("chapter called x", "more")]),
    ("CHAPTER\n\nItem z", [("CHAPTER\n\nItem z", "")]),
    ("CHAPTER Q\nx", [("Full Text", "CHAPTER Q\nx")]),
    ("chapter\u3000v: go\nbody\nCHAPTER 12\n end ", [("chapter\u3000v: go", "body"), ("CHAPTER 12", "end")]),
    ("CHAPTER I. One CHAPTER II. Two\nb", [("CHAPTER I. One CHAPTER II. Two", "b")]),
]


def test_chapter_split_by_hand(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HEADING_CASES)], "book_id bigint, text string")
    got = {r.book_id: [(c.title, c.body) for c in r.chapters] for r in CH.with_chapter_array(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(HEADING_CASES)}


ROWS = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", None]),
        st.sampled_from(["Beginner", "Intermediate", "Advanced", "Expert", None]),
        st.text(alphabet=st.sampled_from(list("abc ABC%")), max_size=12),
    ),
    min_size=10, max_size=40,
)
CHOICE = st.tuples(
    st.lists(st.sampled_from(["Beginner", "Intermediate", "Advanced"]), unique=True),
    st.sampled_from([["전체"], [], ["A"], ["전체", "B"], ["Unknown"], ["A", "Unknown"]]),
    st.sampled_from(["", "a", "AB", "%", "c a"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, CHOICE)
def test_dialogue_filter_is_monotone_and_a_conjunction(spark, rows, choice):
    """More levels or speakers never lose a row, a longer keyword never gains one, and the whole filter is the cut of its parts."""
    from readerflow.operators import dialogues as D

    levels, speakers, kw = choice
    data = [(1, i, s, d, ln) for i, (s, d, ln) in enumerate(rows)]
    df = spark.createDataFrame(data, "book_id bigint, dlg_ord bigint, speaker string, difficulty string, line string")

    def kept(lv, sp, k):
        return {r.dlg_ord for r in D.filter_dialogues(df, lv, sp, k).collect()}

    every, all_levels = ["전체"], ["Beginner", "Intermediate", "Advanced"]
    got = kept(levels, speakers, kw)
    assert got == kept(levels, every, "") & kept(all_levels, speakers, "") & kept(all_levels, every, kw)
    assert got <= kept(all_levels, speakers, kw) and got <= kept(levels, every, kw) and got <= kept(levels, speakers, "")
    assert kept(levels, speakers, kw + "a") <= got
    assert kept(levels, speakers, kw.upper()) == kept(levels, speakers, kw.lower())
    assert kept([], speakers, kw) == set() == kept(levels, [], kw)


FILTER_CASES = [  # (speaker, difficulty, line), (levels, speakers, keyword), kept
    (("A", None, "Pay 50% now"), (["Intermediate"], ["A"], "50%"), True),
    (("A", "Expert", "x"), (["Beginner", "Intermediate", "Advanced"], ["전체"], ""), False),
    ((None, "Beginner", "x"), (["Beginner"], ["Unknown"], ""), True),
    (("B", "Beginner", "x"), (["Beginner"], ["전체", "A"], ""), False),
    (("A", "Beginner", "Hello THERE"), (["Beginner"], ["A"], "there"), True),
]


def test_dialogue_filter_by_hand(spark):
    from readerflow.operators import dialogues as D

    for (s, d, ln), (levels, speakers, kw), want in FILTER_CASES:
        df = spark.createDataFrame([(1, 0, s, d, ln)], "book_id bigint, dlg_ord bigint, speaker string, difficulty string, line string")
        assert (D.filter_dialogues(df, levels, speakers, kw).count() == 1) == want, (s, d, ln)


WORDS = st.lists(st.sampled_from(["the", "The", "CAT", "cat,", "dog", "Éte", "éte", "a", " ", "\t", "\n", " "]), max_size=12).map(" ".join)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(WORDS, WORDS), min_size=20, max_size=40))
def test_word_overlap_ignores_order_repeats_and_extra_words(spark, pairs):
    df = spark.createDataFrame(pairs, "target string, answer string")
    turned = F.array_join(F.reverse(T.words("answer")), " ")
    rows = df.select(
        P.word_overlap("target", "answer").alias("p"), P.word_overlap("target", turned).alias("turned"),
        P.word_overlap("target", F.concat_ws(" ", "answer", "answer")).alias("twice"),
        P.word_overlap("target", F.concat_ws(" ", "answer", F.lit("zzz"))).alias("extra"),
        P.word_overlap(F.concat_ws(" ", "target", F.lit("zzz")), "answer").alias("harder"), P.word_overlap("target", F.lit("")).alias("none"),
    ).collect()
    for r in rows:
        assert r.p == r.turned == r.twice == r.extra and r.harder <= r.p and r.none == 0


HEADS = st.lists(st.tuples(st.sampled_from(["CHAPTER I", "CHAPTER II", "Chapter 3", "CHAPTER IV x"]),
                           st.sampled_from(["a", "b", "c d", ""])), min_size=1, max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(HEADS, min_size=10, max_size=25))
def test_dedup_is_insertion_ordered_dict(spark, books):
    texts = ["\n".join(f"{h}\n{b}" for h, b in pairs) for pairs in books]
    df = spark.createDataFrame(list(enumerate(texts)), "book_id bigint, text string")
    got = {}
    for r in CH.chapters(df).collect():
        got.setdefault(r.book_id, []).append((r.chapter_ord, r.title, r.body))
    for i, pairs in enumerate(books):
        exp = dict(pairs)  # first position, last body
        rows = sorted(got[i])
        assert [(t, b) for _, t, b in rows] == list(exp.items())
        assert [o for o, _, _ in rows] == list(range(1, len(exp) + 1))
