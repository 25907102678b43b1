"""Fixture views over the driver tables, in Spark and in SQL.

The driver tables hold plain prose only; these deterministic wrappers add
the headings, markers, CRLF, tabs, nulls and JSON shapes the operators must
handle. Each view exists twice -- a DataFrame builder and an ANSI SQL
string -- and both must produce the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WS_CLASS, words


# Session setting of the benchmark: deal the documents over so many partitions.
# The test tables are one row group each, which a scan cannot split; real tables
# have more splits than cores and leave this unset.
SCAN_PARTITIONS = "readerflow.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ----------------------------------------------------------------------------
# fx_books(book_id, raw_text)
# ----------------------------------------------------------------------------

def fx_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books_from_documents(documents(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text), dealt out if the benchmark asks for it."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = spark.conf.get(SCAN_PARTITIONS, None)
    return d.repartition(int(n)) if n else d


def books_from_documents(documents: DataFrame) -> DataFrame:
    """The fx_books projection of a documents frame (batch or streaming)."""
    d = documents.select("doc_id", "text")
    bid = F.col("doc_id").cast("string")
    text = F.col("text")
    half = F.floor(F.length(text) / 2).cast("int")
    crlf = "\r\n"
    body = F.when(F.col("doc_id") % 7 == 0, text).otherwise(
        F.concat(
            F.lit("CHAPTER I. One" + crlf),
            F.substring(text, F.lit(1), half),
            F.lit("\n\n\n\n\t\tChapter 2\t  Two\n"),
            F.lit('"Well met, reader of book '), bid, F.lit(',"\tsaid Ann. "'), F.repeat(F.lit("Read on. "), (F.col("doc_id") % 40).cast("int")), F.lit('"\n'),
            F.substring(text, half + 1, F.lit(2**31 - 1)),
            F.when(
                F.col("doc_id") % 5 == 0,
                F.concat(F.lit("\nCHAPTER I. One\nRepeated body "), bid),
            ).otherwise(F.lit("")),
        )
    )
    raw = F.concat(
        F.lit("The Project Gutenberg eBook of Book "), bid, F.lit(crlf),
        F.lit("Release note: public domain." + crlf + crlf),
        F.lit("*** START OF "),
        F.when(F.col("doc_id") % 2 == 0, F.lit("THE")).otherwise(F.lit("THIS")),
        F.lit(" PROJECT GUTENBERG EBOOK BOOK "), bid, F.lit(" ***" + crlf),
        body,
        F.lit(crlf + "*** END OF THE PROJECT GUTENBERG EBOOK BOOK "), bid,
        F.lit(" ***" + crlf + "End of the Project Gutenberg eBook. Footer "), bid,
    )
    return d.select(F.col("doc_id").alias("book_id"), raw.alias("raw_text"))


FX_BOOKS_SQL = r"""
SELECT doc_id AS book_id,
  'The Project Gutenberg eBook of Book ' || CAST(doc_id AS VARCHAR) || chr(13) || chr(10)
  || 'Release note: public domain.' || chr(13) || chr(10) || chr(13) || chr(10)
  || '*** START OF ' || CASE WHEN doc_id % 2 = 0 THEN 'THE' ELSE 'THIS' END
  || ' PROJECT GUTENBERG EBOOK BOOK ' || CAST(doc_id AS VARCHAR) || ' ***' || chr(13) || chr(10)
  || CASE WHEN doc_id % 7 = 0 THEN text ELSE
       'CHAPTER I. One' || chr(13) || chr(10)
       || substring(text, 1, CAST(floor(length(text) / 2) AS INTEGER))
       || chr(10) || chr(10) || chr(10) || chr(10) || chr(9) || chr(9) || 'Chapter 2' || chr(9) || '  Two' || chr(10)
       || '"Well met, reader of book ' || CAST(doc_id AS VARCHAR) || ',"' || chr(9) || 'said Ann. "'
       || repeat('Read on. ', CAST(doc_id % 40 AS INTEGER)) || '"' || chr(10)
       || substring(text, CAST(floor(length(text) / 2) AS INTEGER) + 1)
       || CASE WHEN doc_id % 5 = 0
               THEN chr(10) || 'CHAPTER I. One' || chr(10) || 'Repeated body ' || CAST(doc_id AS VARCHAR)
               ELSE '' END
     END
  || chr(13) || chr(10) || '*** END OF THE PROJECT GUTENBERG EBOOK BOOK ' || CAST(doc_id AS VARCHAR)
  || ' ***' || chr(13) || chr(10) || 'End of the Project Gutenberg eBook. Footer ' || CAST(doc_id AS VARCHAR)
  AS raw_text
FROM documents
"""


# ----------------------------------------------------------------------------
# fx_dialogues(book_id, dlg_ord, speaker, line, context, difficulty,
#              modern_equivalent, key_expressions)
# ----------------------------------------------------------------------------

def fx_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    turn, cid = F.col("turn"), F.col("conv_id")
    difficulty = (
        F.when(turn % 4 == 0, "Beginner")
        .when(turn % 4 == 1, "Intermediate")
        .when((turn % 4 == 2) & (cid % 6 == 0), "Expert")
        .when(turn % 4 == 2, "Advanced")
    )
    return c.select(
        cid.alias("book_id"),
        turn.alias("dlg_ord"),
        F.when(turn % 5 == 4, F.lit(None).cast("string")).otherwise(F.col("role")).alias("speaker"),
        F.col("text").alias("line"),
        F.concat(F.lit("Scene "), cid.cast("string")).alias("context"),
        difficulty.alias("difficulty"),
        F.when(turn % 3 == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("In other words: "), "text"))
        .alias("modern_equivalent"),
        words("text").alias("key_expressions"),
    )


FX_DIALOGUES_SQL = r"""
SELECT conv_id AS book_id, turn AS dlg_ord,
  CASE WHEN turn % 5 = 4 THEN NULL ELSE role END AS speaker,
  text AS line,
  'Scene ' || CAST(conv_id AS VARCHAR) AS context,
  CASE WHEN turn % 4 = 0 THEN 'Beginner' WHEN turn % 4 = 1 THEN 'Intermediate'
       WHEN turn % 4 = 2 AND conv_id % 6 = 0 THEN 'Expert'
       WHEN turn % 4 = 2 THEN 'Advanced' END AS difficulty,
  CASE WHEN turn % 3 = 2 THEN NULL ELSE 'In other words: ' || text END AS modern_equivalent,
  list_filter(string_split_regex(text, '\s+'), lambda t: t <> '') AS key_expressions
FROM conversations
"""


# ----------------------------------------------------------------------------
# fx_attempts(learner_id, book_id, dlg_ord, target, answer)
# ----------------------------------------------------------------------------

def fx_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    a = c.alias("a")
    b = c.alias("b")
    j = a.join(b, (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("a.turn") == F.col("b.turn") + 1))
    bt = F.col("b.text")
    answer = (
        F.when(F.col("b.turn") % 4 == 0, bt)
        .when(F.col("b.turn") % 4 == 1, F.substring(bt, F.lit(1), F.floor(F.length(bt) / 2).cast("int")))
        .when(F.col("b.turn") % 4 == 2, F.col("a.text"))
        .otherwise(F.lit(" \t"))
    )
    return j.select(
        (F.col("b.conv_id") % 50).alias("learner_id"),
        F.col("b.conv_id").alias("book_id"),
        F.col("b.turn").alias("dlg_ord"),
        bt.alias("target"),
        answer.alias("answer"),
    )


FX_ATTEMPTS_SQL = r"""
SELECT b.conv_id % 50 AS learner_id, b.conv_id AS book_id, b.turn AS dlg_ord,
  b.text AS target,
  CASE WHEN b.turn % 4 = 0 THEN b.text
       WHEN b.turn % 4 = 1 THEN substring(b.text, 1, CAST(floor(length(b.text) / 2) AS INTEGER))
       WHEN b.turn % 4 = 2 THEN a.text
       ELSE ' ' || chr(9) END AS answer
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
"""


# ----------------------------------------------------------------------------
# fx_feedback(learner_id, ts, mode, accuracy_score, pronunciation_issues,
#             fluency_feedback, grammar_note, encouragement)
# ----------------------------------------------------------------------------

def fx_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback_from_events(table(spark, sf_dir, "events"))


def feedback_from_events(e: DataFrame) -> DataFrame:
    """The fx_feedback projection of an events frame (batch or streaming)."""
    eid = F.col("event_id")
    issues = (
        F.when(F.col("value") >= 100, F.array(F.concat(F.lit("w"), (eid % 7).cast("string")),
                                               F.concat(F.lit("w"), (eid % 3).cast("string"))))
        .when(F.col("value") >= 50, F.array(F.concat(F.lit("w"), (eid % 7).cast("string"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return e.select(
        F.col("user_id").alias("learner_id"),
        F.col("ts"),
        F.when(F.col("event_type") == "view", "dictation").otherwise("shadowing").alias("mode"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("int"))
        .otherwise(F.least(F.lit(100), F.floor("value")).cast("int"))
        .alias("accuracy_score"),
        issues.alias("pronunciation_issues"),
        F.concat(F.lit("Fluency "), F.col("event_type")).alias("fluency_feedback"),
        F.when(eid % 4 == 0, F.lit("Check tense")).alias("grammar_note"),
        F.lit("Keep going!").alias("encouragement"),
    )


FX_FEEDBACK_SQL = r"""
SELECT user_id AS learner_id, ts,
  CASE WHEN event_type = 'view' THEN 'dictation' ELSE 'shadowing' END AS mode,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(least(100, floor(value)) AS INTEGER) END AS accuracy_score,
  CASE WHEN value >= 100 THEN ['w' || CAST(event_id % 7 AS VARCHAR), 'w' || CAST(event_id % 3 AS VARCHAR)]
       WHEN value >= 50 THEN ['w' || CAST(event_id % 7 AS VARCHAR)]
       ELSE CAST([] AS VARCHAR[]) END AS pronunciation_issues,
  'Fluency ' || event_type AS fluency_feedback,
  CASE WHEN event_id % 4 = 0 THEN 'Check tense' END AS grammar_note,
  'Keep going!' AS encouragement
FROM events
"""


# ----------------------------------------------------------------------------
# fx_responses(prompt_hash, book_id, turn, raw): model answers of five shapes
# ----------------------------------------------------------------------------

def fx_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id"), F.col("turn")
    difficulty = (
        F.when(turn % 4 == 0, "Beginner").when(turn % 4 == 1, "Intermediate").when(turn % 4 == 2, "Advanced")
    )
    obj = F.to_json(
        F.struct(
            F.col("role").alias("speaker"),
            F.col("text").alias("line"),
            F.concat(F.lit("Scene "), cid.cast("string")).alias("context"),
            difficulty.alias("difficulty"),
            words("text").alias("key_expressions"),
        )
    )
    shape = (cid + turn) % 5
    raw = (
        F.when((shape == 0) & (turn % 2 == 1), F.concat(F.lit("["), obj, F.lit(", 5]")))
        .when(shape == 0, F.concat(F.lit("["), obj, F.lit("]")))
        .when(shape == 1, F.concat(F.lit('{"dialogues": ['), obj, F.lit("]}")))
        .when((shape == 2) & (cid % 2 == 0), F.concat(F.lit('{"tips": ["x"], "dialogues": ['), obj, F.lit("]}")))
        .when(shape == 2, F.concat(F.lit('{"note": "[x]", "n": 3, "dialogues": ['), obj, F.lit('], "z": [1]}')))
        .when(shape == 3, F.lit('{"a": 1}'))
        .when(turn % 2 == 0, F.concat(F.lit("oops "), cid.cast("string")))
        .otherwise(F.lit("5"))
    )
    key = F.concat(F.lit("resp-"), cid.cast("string"), F.lit("-"), turn.cast("string"))
    return c.select(F.sha2(key, 256).alias("prompt_hash"), cid.alias("book_id"), turn, raw.alias("raw"))


FX_RESPONSES_SQL = r"""
SELECT sha256('resp-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)) AS prompt_hash,
  conv_id AS book_id, turn,
  CASE
    WHEN (conv_id + turn) % 5 = 0 AND turn % 2 = 1 THEN '[' || obj || ', 5]'
    WHEN (conv_id + turn) % 5 = 0 THEN '[' || obj || ']'
    WHEN (conv_id + turn) % 5 = 1 THEN '{"dialogues": [' || obj || ']}'
    WHEN (conv_id + turn) % 5 = 2 AND conv_id % 2 = 0 THEN '{"tips": ["x"], "dialogues": [' || obj || ']}'
    WHEN (conv_id + turn) % 5 = 2 THEN '{"note": "[x]", "n": 3, "dialogues": [' || obj || '], "z": [1]}'
    WHEN (conv_id + turn) % 5 = 3 THEN '{"a": 1}'
    WHEN turn % 2 = 0 THEN 'oops ' || CAST(conv_id AS VARCHAR)
    ELSE '5' END AS raw
FROM (
  SELECT *, CAST(json_object(
      'speaker', role, 'line', text, 'context', 'Scene ' || CAST(conv_id AS VARCHAR),
      'difficulty', CASE WHEN turn % 4 = 0 THEN 'Beginner' WHEN turn % 4 = 1 THEN 'Intermediate'
                         WHEN turn % 4 = 2 THEN 'Advanced' END,
      'key_expressions', list_filter(string_split_regex(text, '\s+'), lambda t: t <> '')) AS VARCHAR) AS obj
  FROM conversations)
"""


# ----------------------------------------------------------------------------
# fx_messages(conv_id, turn, role, content): stored chat messages
# fx_setups(conv_id, scenario, user_role, ai_roles, opening_line, vocabulary_tips)
# ----------------------------------------------------------------------------

def fx_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.filter(F.col("role").isin("user", "assistant")).select(
        "conv_id", "turn", "role", F.col("text").alias("content")
    )


FX_MESSAGES_SQL = """
SELECT conv_id, turn, role, text AS content FROM conversations WHERE role IN ('user', 'assistant')
"""


def _setup_cols(cid, scenario):
    m6 = cid % 6
    roles = (
        F.when(m6 == 0, F.lit(None).cast("array<string>"))
        .when(m6 == 3, F.array().cast("array<string>"))
        .when(m6.isin(1, 4), F.array(F.lit("Narrator")))
        .otherwise(F.array(F.lit("Mr. A"), F.lit("Ms. B")))
    )
    return [
        cid.alias("conv_id"),
        scenario.alias("scenario"),
        F.when(cid % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Learner "), cid.cast("string"))).alias("user_role"),
        roles.alias("ai_roles"),
        F.when(cid % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Welcome to scene "), cid.cast("string"))).alias("opening_line"),
        F.array(F.concat(F.lit("tip "), cid.cast("string"))).alias("vocabulary_tips"),
    ]


def fx_setups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One setup per conversation (from its turn-0 row) plus three ids past the
    largest one, which have no messages."""
    c = table(spark, sf_dir, "conversations")
    first = c.filter(F.col("turn") == 0).select(
        *_setup_cols(F.col("conv_id"), F.when(F.col("role") == "system", F.col("text")).otherwise(F.lit("A quiet scene.")))
    )
    extra = c.agg(F.max("conv_id").alias("m")).select(F.explode(F.sequence(F.col("m") + 1, F.col("m") + 3)).alias("conv_id"))
    extra = extra.select(*_setup_cols(F.col("conv_id"), F.lit("Empty scene")))
    return first.unionByName(extra)


_SETUP_COLS_SQL = """
  CASE WHEN cid % 4 = 0 THEN NULL ELSE 'Learner ' || CAST(cid AS VARCHAR) END AS user_role,
  CASE WHEN cid % 6 = 0 THEN NULL WHEN cid % 6 = 3 THEN CAST([] AS VARCHAR[])
       WHEN cid % 6 IN (1, 4) THEN ['Narrator'] ELSE ['Mr. A', 'Ms. B'] END AS ai_roles,
  CASE WHEN cid % 5 = 0 THEN NULL ELSE 'Welcome to scene ' || CAST(cid AS VARCHAR) END AS opening_line,
  ['tip ' || CAST(cid AS VARCHAR)] AS vocabulary_tips"""

FX_SETUPS_SQL = f"""
SELECT cid AS conv_id, scenario, {_SETUP_COLS_SQL}
FROM (SELECT conv_id AS cid, CASE WHEN role = 'system' THEN text ELSE 'A quiet scene.' END AS scenario
      FROM conversations WHERE turn = 0)
UNION ALL
SELECT cid AS conv_id, 'Empty scene' AS scenario, {_SETUP_COLS_SQL}
FROM (SELECT unnest(range(max(conv_id) + 1, max(conv_id) + 4)) AS cid FROM conversations)
"""


FIXTURE_SQL = {
    "fx_books": FX_BOOKS_SQL,
    "fx_dialogues": FX_DIALOGUES_SQL,
    "fx_attempts": FX_ATTEMPTS_SQL,
    "fx_feedback": FX_FEEDBACK_SQL,
    "fx_responses": FX_RESPONSES_SQL,
    "fx_messages": FX_MESSAGES_SQL,
    "fx_setups": FX_SETUPS_SQL,
}

FIXTURE_DF = {
    "fx_books": fx_books,
    "fx_dialogues": fx_dialogues,
    "fx_attempts": fx_attempts,
    "fx_feedback": fx_feedback,
    "fx_responses": fx_responses,
    "fx_messages": fx_messages,
    "fx_setups": fx_setups,
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it reads, as CTEs."""
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{sql}" if names else sql


__all__ = [
    "FIXTURE_DF",
    "FIXTURE_SQL",
    "WS_CLASS",
    "fx_attempts",
    "fx_books",
    "fx_dialogues",
    "fx_feedback",
    "fx_messages",
    "fx_responses",
    "fx_setups",
    "table",
    "with_fixtures",
]


# ----------------------------------------------------------------------------
# fx_novel(book_id, para_ord, text): whole texts as paragraphs with speech
# ----------------------------------------------------------------------------

NOVEL_BOOKS = 20
# (before the text, behind it), by (doc_id * 7 + doc_id // 20) % 11
NOVEL_FORMS = [
    ("", ""),
    ('"', '," said Ann.'),
    ('"', '"'),
    ("\u201c", "\u201d Mr. Brown replied, \u201cYes.\u201d"),
    ('Then Ben said, "', '"'),
    ("\u201c", ""),
    ("\u201c", "\u201d"),
    ("", "\u201d"),
    ("", '" he said.'),
    ('"', '" she cried. "Well."'),
    (' "', '" '),
]


def fx_novel(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    form = (F.col("doc_id") * 7 + F.floor(F.col("doc_id") / NOVEL_BOOKS)) % len(NOVEL_FORMS)
    before, behind = (F.get(F.array(*[F.lit(f[k]) for f in NOVEL_FORMS]), form.cast("int")) for k in (0, 1))
    return d.select((F.col("doc_id") % NOVEL_BOOKS).alias("book_id"), F.floor(F.col("doc_id") / NOVEL_BOOKS).alias("para_ord"), F.concat(before, F.coalesce("text", F.lit("")), behind).alias("text"))


_NOVEL_LISTS = [", ".join("'" + f[k] + "'" for f in NOVEL_FORMS) for k in (0, 1)]
FX_NOVEL_SQL = f"""fx_novel AS (
SELECT doc_id % {NOVEL_BOOKS} AS book_id, doc_id // {NOVEL_BOOKS} AS para_ord,
  [{_NOVEL_LISTS[0]}][(doc_id * 7 + doc_id // {NOVEL_BOOKS}) % {len(NOVEL_FORMS)} + 1] || coalesce(text, '') ||
  [{_NOVEL_LISTS[1]}][(doc_id * 7 + doc_id // {NOVEL_BOOKS}) % {len(NOVEL_FORMS)} + 1] AS text
FROM documents)"""
