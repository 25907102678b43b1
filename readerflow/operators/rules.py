"""Offline, rule-based stand-ins for the model's extraction task.

These are ours, not a reproduction of the hosted model: quoted spans become
lines, an adjacent ``said <Name>`` gives the speaker, and a difficulty tier
comes from sentence length and mean word length (thresholds in constants).
``rule_dialogues`` reads whole books: speeches over several paragraphs, and
speakers by tags and by alternation. All built-in Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import text as T
from ..session import scratch_path
from .ordinal import DEFAULT_BLOCK, running_last, running_totals, with_blocks

QUOTE_PATTERN = r'"([^"\n]+)"(\s*,?\s*said\s+(\w+))?'
CONTEXT_PATTERN = r'^([^"]*)"'


def rule_extract(paragraphs: DataFrame, key: str = "book_id", order: str = "para_ord") -> DataFrame:
    """(key, order, text) -> (key, order, span_ord, speaker, line, context)."""
    d = paragraphs.select(
        key,
        order,
        F.arrays_zip(
            F.regexp_extract_all("text", F.lit(QUOTE_PATTERN), 1).alias("line"),
            F.regexp_extract_all("text", F.lit(QUOTE_PATTERN), 3).alias("speaker"),
        ).alias("spans"),
        T.strip_ws(F.regexp_extract("text", CONTEXT_PATTERN, 1)).alias("context"),
    )
    # posexplode_outer + a filter on its output: no inferred size(spans) > 0 pushdown
    e = d.select(key, order, "context", F.posexplode_outer("spans").alias("span_ord", "s")).filter(
        F.col("s").isNotNull()
    )
    return e.select(
        key,
        order,
        F.col("span_ord").cast("bigint").alias("span_ord"),
        F.when(F.col("s.speaker") == "", F.lit(K.UNKNOWN_SPEAKER)).otherwise(F.col("s.speaker")).alias("speaker"),
        F.col("s.line").alias("line"),
        "context",
    )


QUOTE_MARKS = '["\u201c\u201d]'
SPEECH_VERBS = "said|says|asked|cried|replied|answered|exclaimed|whispered|murmured|shouted|returned|remarked|observed|added|continued"
# words that begin a sentence before a name, or stand for one
NO_NAMES = "Then|And|But|So|The|When|Now|At|He|She|It|They|We|You|I|Who"
NAME_PATTERN = r"((?:(?:Mr|Mrs|Ms|Miss|Dr|Sir|Lady|Lord|Captain)\.?[ \t\n]+)?\p{Lu}[\p{L}'’-]*(?:[ \t\n]+\p{Lu}[\p{L}'’-]*)*)"
VERB_NAME = rf"^[ ,\t\n]*(?:{SPEECH_VERBS})[ \t\n]+{NAME_PATTERN}"
NAME_VERB = rf"^[ ,\t\n]*{NAME_PATTERN}[ \t\n]+(?:{SPEECH_VERBS})\b"
NAME_VERB_BEFORE = rf"{NAME_PATTERN}[ \t\n]+(?:{SPEECH_VERBS})[ ,:\t\n]*$"
LEADING_NO_NAMES = rf"^(?:(?:{NO_NAMES})(?:[ \t\n]+|$))+"


def _named(piece: Column, pattern: str) -> Column:
    """The name a piece of narration gives by ``pattern``; null if none, or only a pronoun."""
    name = F.regexp_replace(F.regexp_extract(piece, pattern, 1), LEADING_NO_NAMES, "")
    return F.nullif(F.regexp_replace(name, r"[ \t\n]+", " "), F.lit(""))


def _tag(pieces: Column, inside: int) -> Column:
    """Who speaks in a paragraph cut at its quotation marks: the first name behind a quote, else the first before one.

    Pieces are quoted and not by turns; ``inside`` says that the first is quoted.
    """
    numbered = F.filter(F.transform(pieces, lambda p, i: F.struct(i.alias("i"), p.alias("p"))), lambda x: x["i"] % 2 == inside)
    behind = F.transform(F.filter(numbered, lambda x: x["i"] > 0), lambda x: F.coalesce(_named(x["p"], VERB_NAME), _named(x["p"], NAME_VERB)))
    before = F.transform(F.filter(numbered, lambda x: x["i"] < F.size(pieces) - 1), lambda x: _named(x["p"], NAME_VERB_BEFORE))
    return F.get(F.filter(F.concat(behind, before), lambda n: n.isNotNull()), F.lit(0))


def rule_dialogues(paragraphs: DataFrame, key: str = "book_id", order: str = "para_ord", block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """U2 over whole books: (key, order, text) -> (key, order, span_ord, turn, speaker, how, line, context).

    Quotation marks are straight or curly and open and close by turns. A speech
    left open at a paragraph's end goes on in the next one if that begins with a
    mark, or has an odd number of marks (it then begins inside the quotation); otherwise the closing
    mark is taken as forgotten. All quotes of one paragraph, and of those it
    goes on in, are one ``turn`` (numbered in the book) of one speaker. ``how``
    the speaker is known: ``tag`` (a name with a verb of speech behind a quote,
    else before one), or ``alternation``: in a stretch of paragraphs that all hold quotes two
    speakers take turns, so an untagged turn has the speaker of the nearest
    earlier tagged turn an even number of turns before, else the nearest such later
    one; else ``none`` and Unknown. ``context`` is the paragraph's narration.

    ``order`` is integral and unique within ``key``; rows with a null in either
    are left out; a null text is an empty one. What a paragraph takes over
    from those before it are running counts and last values over blocks of a
    book (``ordinal``), on short rows without texts, so that no book is one
    task; one join brings the texts back.
    """
    spark = paragraphs.sparkSession
    text = F.coalesce("text", F.lit(""))
    given = paragraphs.filter(F.col(key).isNotNull() & F.col(order).isNotNull())

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"rule_{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    cut = given.select(F.col(key).alias("k"), F.col(order).cast("bigint").alias("o"), F.split(text, QUOTE_MARKS, -1).alias("pieces"))
    marks = F.size("pieces") - 1
    short = cut.select(
        "k", "o", marks.alias("marks"), ((marks > 0) & (T.strip_ws(F.get("pieces", F.lit(0))) == "")).alias("lead"),
        _tag(F.col("pieces"), 0).alias("tag0"), F.when(marks % 2 == 1, _tag(F.col("pieces"), 1)).alias("tag1"))
    short = kept(with_blocks(kept(short, "marks"), "k", "o", block_size), "blocks")

    # a paragraph that flips: its odd number of marks closes an open speech, or leaves one open
    flips = (F.col("marks") % 2 == 1) & ~F.col("lead")
    d = running_totals(short.withColumn("flip", flips.cast("int")).withColumn("silent", (F.col("marks") == 0).cast("int")), "k", "o", {"flips": "flip", "run": "silent"})
    # whether the paragraph before ends open: by the last one that does not flip, and the flips since
    base = F.when(~flips, F.struct((F.col("marks") % 2).alias("odd"), F.col("flips").alias("flips")))
    d = running_last(d, "k", "o", {"base": base})
    was_open = (F.coalesce("base.odd", F.lit(0)) + F.col("flips") - F.coalesce("base.flips", F.lit(0))) % 2 == 1
    inside = was_open & flips
    goes_on = was_open & (flips | F.col("lead"))
    d = kept(d.select(
        "k", "o", "__blk", "marks", "run", inside.alias("inside"), F.when(inside, F.col("tag1")).otherwise(F.col("tag0")).alias("tag"),
        ((F.col("marks") > 0) & ~goes_on).cast("int").alias("start")), "open")
    d = running_totals(d, "k", "o", {"turns": "start"}).filter(F.col("marks") > 0)
    d = kept(d.select("k", "o", "run", "inside", "tag", (F.col("turns") + F.col("start")).cast("bigint").alias("turn")), "turns")

    # "run" and the turn's parity name one of the two speakers of a stretch
    turns = d.groupBy("k", "run", "turn").agg(F.min_by("tag", F.when(F.col("tag").isNotNull(), F.col("o"))).alias("tag"))
    turns = turns.withColumn("side", F.struct("k", "run", (F.col("turn") % 2).alias("parity"))).withColumn("back", -F.col("turn"))
    turns = kept(turns, "sides")
    turns = running_last(turns, "side", "turn", {"earlier": F.col("tag")}, block_size)
    turns = running_last(kept(turns, "earlier"), "side", "back", {"later": F.col("tag")}, block_size)
    guess = F.coalesce("earlier", "later")
    turns = turns.select(
        "k", "turn", F.coalesce("tag", guess, F.lit(K.UNKNOWN_SPEAKER)).alias("speaker"),
        F.when(F.col("tag").isNotNull(), "tag").when(guess.isNotNull(), "alternation").otherwise("none").alias("how"))
    known = d.join(turns, ["k", "turn"]).select(F.col("k").alias("__k"), F.col("o").alias("__o"), "turn", "inside", "speaker", "how")

    e = given.select(key, order, F.split(text, QUOTE_MARKS, -1).alias("pieces")).join(known, (F.col(key) == F.col("__k")) & (F.col(order) == F.col("__o")))
    quoted = F.filter(F.transform("pieces", lambda p, i: F.when((i % 2 == 1) != F.col("inside"), T.strip_ws(p))), lambda p: p.isNotNull())
    context = T.strip_ws(F.array_join(F.filter(F.transform("pieces", lambda p, i: F.when((i % 2 == 1) == F.col("inside"), T.strip_ws(p))), lambda p: p != ""), " "))
    e = e.select(key, order, "turn", "speaker", "how", context.alias("context"), F.posexplode_outer(quoted).alias("span_ord", "line")).filter(F.col("line") != "")
    return e.select(key, order, F.col("span_ord").cast("bigint").alias("span_ord"), "turn", "speaker", "how", "line", "context")


def word_stats(line: Column | str) -> tuple[Column, Column]:
    """(number of words, mean word length) of a line."""
    w = T.words(F.coalesce(F.col(line) if isinstance(line, str) else line, F.lit("")))
    n = F.size(w)
    total = F.aggregate(w, F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x))
    return n, F.when(n > 0, total / n).otherwise(F.lit(0.0))


def rule_difficulty(line: Column | str) -> Column:
    """Beginner for short lines of short words, Advanced for long lines or
    long words, Intermediate otherwise."""
    n, mean = word_stats(line)
    return (
        F.when((n <= K.RULE_BEGINNER_MAX_WORDS) & (mean <= K.RULE_BEGINNER_MAX_WORD_LEN), "Beginner")
        .when((n >= K.RULE_ADVANCED_MIN_WORDS) | (mean >= K.RULE_ADVANCED_MIN_WORD_LEN), "Advanced")
        .otherwise("Intermediate")
    )
