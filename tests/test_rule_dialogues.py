"""U2 over whole books: hand-worked pages and a plain reader of one paragraph after the other."""

import random
import re

from readerflow.operators import ordinal as O
from readerflow.operators import rules as R
from pyspark.sql import functions as F

SCHEMA = "book_id bigint, para_ord bigint, text string"


def _read(rows):
    """One paragraph after the other, with the state carried along."""
    out = []
    books = {}
    for b, o, t in rows:
        if b is not None and o is not None:
            books.setdefault(b, []).append((o, t or ""))
    def name(piece, pattern):
        m = re.search(pattern.replace(r"\p{Lu}", "[A-ZÉÀ]").replace(r"\p{L}", r"A-Za-zéàÉÀ"), piece)
        words = m.group(1).split() if m else []
        while words and words[0] in R.NO_NAMES.split("|"):
            words.pop(0)
        return " ".join(words) or None
    for b, paras in books.items():
        open_, run, turn, turns, lines = False, 0, 0, {}, []
        for o, t in sorted(paras):
            pieces = re.split(R.QUOTE_MARKS, t)
            n = len(pieces) - 1
            if n == 0:
                open_, run = False, run + 1
                continue
            lead = pieces[0].strip() == ""
            inside = open_ and not lead and n % 2 == 1
            if not (open_ and (lead or inside)):
                turn += 1
                turns[turn] = [run, None]
            quoted = [i for i in range(n + 1) if (i % 2 == 1) != inside]
            plain = [i for i in range(n + 1) if i not in quoted]
            tags = [name(pieces[i], R.VERB_NAME) or name(pieces[i], R.NAME_VERB) for i in plain if i > 0] + [name(pieces[i], R.NAME_VERB_BEFORE) for i in plain if i < n]
            turns[turn][1] = turns[turn][1] or next((x for x in tags if x), None)
            context = " ".join(x for x in (pieces[i].strip() for i in plain) if x)
            lines += [(o, k, turn, pieces[i].strip(), context) for k, i in enumerate(quoted) if pieces[i].strip()]
            open_ = (n % 2 == 1) != inside
        for o, k, t, line, context in lines:
            r, tag = turns[t]
            same = {x: v[1] for x, v in turns.items() if v[0] == r and x % 2 == t % 2 and v[1]}
            near = max((x for x in same if x < t), default=min((x for x in same if x > t), default=None))
            who, how = (tag, "tag") if tag else (same[near], "alternation") if near else ("Unknown", "none")
            out.append((b, o, k, t, who, how, line, context))
    return sorted(out)


def _got(spark, rows, **kw):
    return sorted(tuple(r) for r in R.rule_dialogues(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw).collect())


def test_a_page_by_hand(spark):
    page = [
        "It was late.",
        '"Who is there?" asked Anne.',
        "“Only me,” Mr. Grey replied, “your neighbour.”",
        '"At this hour?"',
        '"I saw a light.',
        '"And I heard a noise."',
        "Then Anne said, \"Come in.\"",
        "He came in.",
        '"Sit down," she said.',
        '"Thank you."',
        '"Tea?" cried Anne. "Or wine?"',
        '"Neither, and this goes on',
        'and on to here," he added.',
    ]
    got = [(o, t, who, how, line) for _, o, _, t, who, how, line, _ in _got(spark, [(1, k, p) for k, p in enumerate(page)])]
    assert got == [
        (1, 1, "Anne", "tag", "Who is there?"),
        (2, 2, "Mr. Grey", "tag", "Only me,"), (2, 2, "Mr. Grey", "tag", "your neighbour."),
        (3, 3, "Anne", "alternation", "At this hour?"),
        (4, 4, "Mr. Grey", "alternation", "I saw a light."), (5, 4, "Mr. Grey", "alternation", "And I heard a noise."),
        (6, 5, "Anne", "tag", "Come in."),
        (8, 6, "Anne", "alternation", "Sit down,"),
        (9, 7, "Unknown", "none", "Thank you."),
        (10, 8, "Anne", "tag", "Tea?"), (10, 8, "Anne", "tag", "Or wine?"),
        (11, 9, "Unknown", "none", "Neither, and this goes on"), (12, 9, "Unknown", "none", "and on to here,"),
    ]


def test_equal_to_reading_in_order(spark):
    rng = random.Random(5)
    bits = ['"', "“", "”", "yes", " said Ann. ", " Élie Brown cried, ", "Then Bo said: ", " he asked. ", "\n", " ", "So The Lady Grey replied "]
    rows = [(b, 3 * o - 50, "".join(rng.choice(bits) for _ in range(rng.randint(0, 7)))) for b in range(6) for o in range(160 if b == 3 else 40)]
    rows += [(9, 0, None), (9, 1, ""), (9, 2, '"'), (9, 3, '"" said Cy'), (9, 4, 'x"'), (None, 1, '"lost"'), (9, None, '"lost"')]
    want = _read(rows)
    assert {r[5] for r in want} == {"tag", "alternation", "none"}
    assert _got(spark, rows) == want
    assert _got(spark, rows, block_size=7) == want


def test_empty_and_extra_columns(spark):
    assert _got(spark, []) == []
    d = spark.createDataFrame([(1, 1, '"Yes," said Ann.', 5, "x")], SCHEMA + ", turn int, k string")
    assert [(r["turn"], r["speaker"]) for r in R.rule_dialogues(d).collect()] == [(1, "Ann")]


def test_running_last(spark):
    rng = random.Random(2)
    rows = [(k, o, rng.choice([None, o])) for k in ("a", "b") for o in rng.sample(range(1000), 60)]
    d = spark.createDataFrame(rows, "k string, o bigint, v bigint")
    for inclusive in (False, True):
        got = O.running_last(d, "k", "o", {"last": F.col("v")}, block_size=5, inclusive=inclusive).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["last"] == max((v for k, o, v in rows if k == r["k"] and v is not None and (o < r["o"] or inclusive and o == r["o"])), default=None)
