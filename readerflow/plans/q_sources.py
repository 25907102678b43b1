"""Queries for sources (S1-S4, S7), voice manifests (J2, V1-V3) and offline
rules (U2, U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import first_words, sql_literal, sql_text, words
from ..operators import rules as R
from ..operators.maintained import MaintainedDialogues
from ..operators import voice as V
from ..session import scratch_path
from ..sources import books as B
from ..sources import media as M
from ..sources import title_search as TS
from ..sources.fixtures import FX_NOVEL_SQL, documents, fx_books, fx_dialogues, fx_novel, table, with_fixtures
from ..sources.tables import KeyedTable
from . import sqlgen as S
from .registry import query

CATALOG_SQL = "(VALUES " + ", ".join(f"({sql_literal(t)}, CAST({i} AS BIGINT))" for t, i in K.CATALOG) + ") cat(title, book_id)"
UNKNOWN_TITLE = "Unknown Book (Nobody)"
REQUESTABLE = [t for t, _ in K.CATALOG] + [UNKNOWN_TITLE]


# ------------------------------------------------------------------ S1, S2
def _requests(spark, sf):
    d = table(spark, sf, "documents")
    titles = F.array(*[F.lit(t) for t in REQUESTABLE])
    return d.select("doc_id", F.element_at(titles, (F.col("doc_id") % len(REQUESTABLE) + 1).cast("int")).alias("title"))


REQUESTS_SQL = (
    "SELECT doc_id, ([" + ", ".join(sql_literal(t) for t in REQUESTABLE) + f"])[doc_id % {len(REQUESTABLE)} + 1] AS title "
    "FROM documents"
)


@query(
    "catalog_lookup",
    f"SELECT r.doc_id, r.title, cat.book_id AS catalog_id FROM ({REQUESTS_SQL}) r JOIN {CATALOG_SQL} ON r.title = cat.title",
)
def q_catalog_lookup(spark, sf):
    return B.catalog_lookup(_requests(spark, sf)).select("doc_id", "title", "catalog_id")


@query(
    "catalog_search",
    f"""SELECT q.doc_id, q.q, cat.title, cat.book_id FROM
  (SELECT DISTINCT doc_id, lower(w) AS q FROM (SELECT doc_id, unnest({S.words('text')}) AS w FROM documents)) q
  JOIN {CATALOG_SQL} ON contains(lower(cat.title), q.q)""",
)
def q_catalog_search(spark, sf):
    d = documents(spark, sf)
    queries = d.select("doc_id", F.explode(F.filter(F.array_distinct(F.transform(words("text"), F.lower)), B.may_match)).alias("q"))
    return B.catalog_search(queries).select("doc_id", "q", "title", "book_id")


# titles are the first five words of the documents (other than ASCII characters shown as x, for the oracle compares bytes); each is asked for with a letter left out and, for odd ids, another one changed
_TITLE_SQL = f"regexp_replace(array_to_string(list_slice({S.words('text')}, 1, 5), ' '), '[^ -~]', 'x', 'g')"


@query(
    "catalog_search_approximate",
    f"""WITH t AS (SELECT doc_id, {_TITLE_SQL} AS name FROM documents),
n AS (SELECT DISTINCT name, lower(name) AS name_key FROM t WHERE name <> ''),
q AS (SELECT DISTINCT q, lower(q) AS q_key FROM (SELECT substring(name, 1, 3) || CASE WHEN doc_id % 2 = 1 THEN substring(name, 5, 6) || 'q' || substring(name, 12) ELSE substring(name, 5) END AS q FROM t) WHERE trim(q) <> ''),
b AS (SELECT *, least(3, (len(list_distinct(list_transform(range(1, length(q_key) + 3), lambda i: substring('  ' || q_key || '  ', i, 3)))) - 1) // 3) AS k FROM q)
SELECT q, name, CAST(levenshtein(q_key, name_key) AS INTEGER) AS distance FROM b JOIN n ON levenshtein(q_key, name_key) <= k""",
)
def q_catalog_search_approximate(spark, sf):
    """Misspelt titles found among the titles of all documents."""
    t = documents(spark, sf).select("doc_id", F.regexp_replace(F.array_join(first_words("text", 5), " "), "[^ -~]", "x").alias("name"))
    changed = F.concat(F.substring("name", 5, 6), F.lit("q"), F.substring("name", 12, 1 << 20))
    q = t.select(F.concat(F.substring("name", 1, 3), F.when(F.col("doc_id") % 2 == 1, changed).otherwise(F.substring("name", 5, 1 << 20))).alias("q"))
    return TS.approximate_matches(q, t)


# ------------------------------------------------------------------ S3, S4, S7
HOLLOW = K.START_MARKERS[0] + " EBOOK ***\n \n" + K.END_MARKERS[0] + " EBOOK ***"
_HOLLOW_SQL = f"""CASE WHEN book_id % 13 = 5 THEN CASE WHEN book_id % 2 = 0 THEN ' ' || chr(10) || chr(9) || chr(10)
  ELSE {sql_text(HOLLOW)} END ELSE raw_text END"""


def _candidates(spark, sf):
    """Landed copies per book: location 1 when id % 3 <> 0, location 2 for even
    ids, location 3 always; books with id % 11 = 0 only have an empty copy, and
    the best copy of those with id % 13 = 5 holds white space or markers only."""
    b = fx_books(spark, sf)
    bad = F.col("book_id") % 11 == 0
    hollow = F.when(F.col("book_id") % 13 == 5, F.when(F.col("book_id") % 2 == 0, F.lit(" \n\t\n")).otherwise(F.lit(HOLLOW))).otherwise(F.col("raw_text"))
    p1 = b.filter((F.col("book_id") % 3 != 0) & ~bad).select("book_id", F.lit(1).alias("priority"), hollow.alias("raw_text"))
    p2 = b.filter((F.col("book_id") % 2 == 0) & ~bad).select(
        "book_id", F.lit(2).alias("priority"), F.concat(F.lit("MIRROR COPY "), "raw_text").alias("raw_text")
    )
    p3 = b.select(
        "book_id", F.lit(3).alias("priority"),
        F.when(bad, F.lit("")).otherwise(F.concat(F.lit("CACHE COPY "), "raw_text")).alias("raw_text"),
    )
    return p1.unionByName(p2).unionByName(p3)


CANDIDATES_SQL = f"""
cands AS (
  SELECT book_id, 1 AS priority, {_HOLLOW_SQL} AS raw_text FROM fx_books WHERE book_id % 3 <> 0 AND book_id % 11 <> 0
  UNION ALL SELECT book_id, 2, 'MIRROR COPY ' || raw_text FROM fx_books WHERE book_id % 2 = 0 AND book_id % 11 <> 0
  UNION ALL SELECT book_id, 3, CASE WHEN book_id % 11 = 0 THEN '' ELSE 'CACHE COPY ' || raw_text END FROM fx_books),
best AS (
  SELECT book_id, arg_min(priority, CASE WHEN length(raw_text) > 0 THEN priority END) AS priority,
         coalesce(arg_min(raw_text, CASE WHEN length(raw_text) > 0 THEN priority END), '') AS raw_text
  FROM cands GROUP BY book_id)
"""


@query(
    "book_scan_fallback",
    with_fixtures("", "fx_books") + ",\n" + CANDIDATES_SQL
    + "SELECT book_id, priority, CAST(length(raw_text) AS BIGINT) AS n_chars, sha256(raw_text) AS text_hash FROM best",
)
def q_book_scan_fallback(spark, sf):
    best = B.book_scan_fallback(_candidates(spark, sf))
    return best.select("book_id", "priority", F.length("raw_text").cast("bigint").alias("n_chars"), F.sha2("raw_text", 256).alias("text_hash"))


@query(
    "empty_book_reject",
    with_fixtures("", "fx_books") + ",\n" + CANDIDATES_SQL + f"SELECT book_id, 'empty text' AS reason FROM best WHERE {S.strip_markers('raw_text')} = ''",
)
def q_empty_book_reject(spark, sf):
    _, errors = B.split_loaded(B.book_scan_fallback(_candidates(spark, sf)))
    return errors


# reloads that bring no text: nothing, white space, markers with white space between
FAILED_LOADS = ["", " \n\t\n", f"head\n{K.START_MARKERS[0]} X ***\n \n{K.END_MARKERS[0]} X ***\nfoot\n"]


@query(
    "replace_on_reload",
    with_fixtures("", "fx_books") + f""",
loads AS (SELECT book_id, 1 AS load_seq, 'CACHE COPY ' || raw_text AS raw_text FROM fx_books
      UNION ALL SELECT book_id, 2, raw_text FROM fx_books
      UNION ALL SELECT book_id, 3 + k, t FROM fx_books, (VALUES {', '.join(f"({k}, {sql_literal(t)})" for k, t in enumerate(FAILED_LOADS))}) f(k, t) WHERE (book_id + k) % 9 = 0),
good AS (SELECT * FROM loads WHERE {S.strip_markers('raw_text')} <> '')
SELECT book_id, max(load_seq) AS load_seq, CAST(length(arg_max(raw_text, load_seq)) AS BIGINT) AS n_chars, sha256(arg_max(raw_text, load_seq)) AS text_hash FROM good GROUP BY book_id
""",
)
def q_replace_on_reload(spark, sf):
    b = fx_books(spark, sf)
    loads = (
        b.select("book_id", F.lit(1).alias("load_seq"), F.concat(F.lit("CACHE COPY "), "raw_text").alias("raw_text"))
        .unionByName(b.select("book_id", F.lit(2).alias("load_seq"), "raw_text"))
    )
    for k, t in enumerate(FAILED_LOADS):
        loads = loads.unionByName(b.filter((F.col("book_id") + k) % 9 == 0).select("book_id", F.lit(3 + k).alias("load_seq"), F.lit(t).alias("raw_text")))
    latest = B.latest_loads(loads)
    return latest.select("book_id", "load_seq", F.length("raw_text").cast("bigint").alias("n_chars"), F.sha2("raw_text", 256).alias("text_hash"))


# dialogues carry the load that they were extracted from: odd lines the first, even lines the second
_LOADED_SQL = "SELECT book_id, dlg_ord, line, 1 + (dlg_ord + 1) % 2 AS load_seq FROM fx_dialogues"


@query(
    "reload_clears_dialogues",
    with_fixtures(
        f"""SELECT d.book_id, d.dlg_ord, d.line FROM ({_LOADED_SQL}) d
JOIN (SELECT book_id, CASE WHEN book_id % 4 = 0 THEN 1 ELSE 2 END AS load_seq FROM (SELECT DISTINCT book_id FROM fx_dialogues)) l
ON d.book_id = l.book_id AND d.load_seq = l.load_seq""",
        "fx_dialogues",
    ),
)
def q_reload_clears_dialogues(spark, sf):
    """The dialogues of a replaced load go; a failed reload (every fourth book) clears nothing."""
    d = fx_dialogues(spark, sf).withColumn("load_seq", (1 + (F.col("dlg_ord") + 1) % 2).cast("int"))
    books = d.select("book_id").distinct()
    loads = books.select("book_id", F.lit(1).alias("load_seq"), F.lit("first").alias("raw_text")).unionByName(
        books.select("book_id", F.lit(2).alias("load_seq"), F.when(F.col("book_id") % 4 == 0, F.lit("")).otherwise(F.lit("second")).alias("raw_text")))
    return B.drop_superseded(d, B.latest_loads(loads)).select("book_id", "dlg_ord", "line")


# ------------------------------------------------------------------ S6
@query(
    "write_keyed_reload",
    with_fixtures(
        "SELECT book_id, dlg_ord, CASE WHEN book_id % 5 = 0 THEN 'again: ' || line ELSE line END AS line FROM fx_dialogues "
        "WHERE book_id % 7 <> 3 AND (book_id % 5 <> 0 OR dlg_ord % 2 = 0)",
        "fx_dialogues",
    ),
)
def q_write_keyed_reload(spark, sf):
    """A keyed table after a reload of some books (fewer lines, other text),
    some of which come back without any line; all other books stay."""
    path = scratch_path(spark, "keyed")
    d = fx_dialogues(spark, sf).select("book_id", "dlg_ord", "line")
    M.write_keyed(d, path, "book_id", 16)
    again = d.filter((F.col("book_id") % 5 == 0) & (F.col("book_id") % 7 != 3) & (F.col("dlg_ord") % 2 == 0)).withColumn("line", F.concat(F.lit("again: "), "line"))
    reloaded = d.select("book_id").distinct().filter((F.col("book_id") % 5 == 0) | (F.col("book_id") % 7 == 3))
    M.write_keyed(again, path, "book_id", 16, replace=reloaded)
    return spark.read.parquet(path).select("book_id", "dlg_ord", "line")


@query(
    "atomic_reload",
    with_fixtures(
        "SELECT book_id, dlg_ord, CASE WHEN book_id % 5 = 0 THEN 'again: ' || line ELSE line END AS line, true AS seen_old FROM fx_dialogues "
        "WHERE book_id % 7 <> 3 AND (book_id % 5 <> 0 OR dlg_ord % 2 = 0)",
        "fx_dialogues",
    ),
)
def q_atomic_reload(spark, sf):
    """As ``write_keyed_reload``, switched at once: the version before the reload is still whole beside the new one."""
    d = fx_dialogues(spark, sf).select("book_id", "dlg_ord", "line")
    t = KeyedTable(spark, scratch_path(spark, "atomic"))
    first = t.replace(d, "book_id", 16)
    again = d.filter((F.col("book_id") % 5 == 0) & (F.col("book_id") % 7 != 3) & (F.col("dlg_ord") % 2 == 0)).withColumn("line", F.concat(F.lit("again: "), "line"))
    t.replace(again, "book_id", 16, gone=d.select("book_id").distinct().filter((F.col("book_id") % 5 == 0) | (F.col("book_id") % 7 == 3)))
    before = t.read(first).select("book_id", "dlg_ord").withColumn("__was", F.lit(True))
    return t.read().join(before, ["book_id", "dlg_ord"], "left").select("book_id", "dlg_ord", "line", F.coalesce("__was", F.lit(False)).alias("seen_old"))


@query(
    "maintained_counts",
    with_fixtures("", "fx_dialogues") + f""",
books AS (SELECT book_id, CASE WHEN book_id % 4 = 0 THEN 1 ELSE 2 END AS load_seq FROM (SELECT DISTINCT book_id FROM fx_dialogues)),
d AS (SELECT b.book_id, b.load_seq, coalesce(difficulty, {sql_literal(K.DEFAULT_DIFFICULTY)}) AS difficulty, coalesce(speaker, {sql_literal(K.UNKNOWN_SPEAKER)}) AS speaker
      FROM books b JOIN ({_LOADED_SQL.replace("line,", "line, difficulty, speaker,")}) f ON b.book_id = f.book_id AND b.load_seq = f.load_seq)
SELECT books.book_id, CAST(books.load_seq AS BIGINT) AS load_seq, count(d.book_id) AS n_dialogues, count(*) FILTER (difficulty = 'Beginner') AS n_beginner,
  count(*) FILTER (difficulty = 'Advanced') AS n_advanced, coalesce(string_agg(DISTINCT speaker, ', ' ORDER BY speaker), '') AS speakers
FROM books LEFT JOIN d ON books.book_id = d.book_id GROUP BY books.book_id, books.load_seq
""",
)
def q_maintained_counts(spark, sf):
    """S7 + A1-A3: facts kept under two reloads, the second of which fails for every fourth book."""
    d = fx_dialogues(spark, sf).withColumn("load_seq", (1 + (F.col("dlg_ord") + 1) % 2).cast("int"))
    d = d.select("book_id", "load_seq", "dlg_ord", "speaker", "difficulty", "line")
    books = d.select("book_id").distinct()
    t = MaintainedDialogues(spark, scratch_path(spark, "maintained"), 16)
    t.reload(books.select("book_id", F.lit(1).alias("load_seq"), F.lit("first").alias("raw_text")), d.filter("load_seq = 1"))
    again = F.when(F.col("book_id") % 4 == 0, F.lit(" ")).otherwise(F.lit("second"))
    t.reload(books.select("book_id", F.lit(2).alias("load_seq"), again.alias("raw_text")), d.filter("load_seq = 2"))
    by = F.map_from_entries("n_by_difficulty")
    return t.facts.read().select("book_id", "load_seq", "n_dialogues", by["Beginner"].alias("n_beginner"), by["Advanced"].alias("n_advanced"), F.array_join("speakers", ", ").alias("speakers"))


# ------------------------------------------------------------------ J2, V1-V3
VOICE_CHOICES = [k for k, _, _ in K.VOICES] + ["Robot Voice (Unknown)"]
VOICES_SQL = "(VALUES " + ", ".join(f"({sql_literal(k)}, {sql_literal(n)}, {sql_literal(g)})" for k, n, g in K.VOICES) + ") v(voice_key, voice_name, gender)"
_DEF = {k: (n, g) for k, n, g in K.VOICES}[K.DEFAULT_VOICE]


def _voice_lines(spark, sf):
    d = fx_dialogues(spark, sf)
    keys = F.array(*[F.lit(k) for k in VOICE_CHOICES])
    return d.select(
        "book_id", "dlg_ord", "line",
        F.element_at(keys, ((F.col("book_id") + F.col("dlg_ord")) % len(VOICE_CHOICES) + 1).cast("int")).alias("voice_key"),
        (F.lit(0.25) + (F.col("dlg_ord") % 17) / F.lit(8.0)).alias("rate"),
    )


VOICE_LINES_SQL = f"""
vl AS (SELECT book_id, dlg_ord, line,
  ([{", ".join(sql_literal(k) for k in VOICE_CHOICES)}])[(book_id + dlg_ord) % {len(VOICE_CHOICES)} + 1] AS voice_key,
  CAST(0.25 AS DOUBLE) + (dlg_ord % 17) / CAST(8.0 AS DOUBLE) AS rate FROM fx_dialogues),
vj AS (SELECT vl.*, coalesce(v.voice_name, {sql_literal(_DEF[0])}) AS voice_name, coalesce(v.gender, {sql_literal(_DEF[1])}) AS gender
       FROM vl LEFT JOIN {VOICES_SQL} ON vl.voice_key = v.voice_key)
"""
SQL_LOCALE = "CASE WHEN contains(voice_name, 'US') THEN 'en-US' WHEN contains(voice_name, 'GB') THEN 'en-GB' ELSE 'en-AU' END"
SQL_RATE = "rate"
SQL_RATE_OK = f"rate BETWEEN CAST({K.MIN_RATE} AS DOUBLE) AND CAST({K.MAX_RATE} AS DOUBLE)"
SQL_SLOW = f"greatest(CAST({K.MIN_RATE} AS DOUBLE), {SQL_RATE} - CAST({K.SLOW_RATE_STEP} AS DOUBLE))"


def _vsql(body: str) -> str:
    return with_fixtures("", "fx_dialogues") + ",\n" + VOICE_LINES_SQL + body


@query("voice_lookup", _vsql("SELECT book_id, dlg_ord, voice_key, voice_name, gender FROM vj"))
def q_voice_lookup(spark, sf):
    return V.lookup_voices(_voice_lines(spark, sf)).select("book_id", "dlg_ord", "voice_key", "voice_name", "gender")


@query("voice_locale", _vsql(f"SELECT book_id, dlg_ord, voice_name, {SQL_LOCALE} AS locale FROM vj"))
def q_voice_locale(spark, sf):
    v = V.lookup_voices(_voice_lines(spark, sf))
    return v.select("book_id", "dlg_ord", "voice_name", V.voice_locale("voice_name").alias("locale"))


@query("slow_rate", _vsql(f"SELECT book_id, dlg_ord, {SQL_RATE} AS rate, {SQL_SLOW} AS slow_rate FROM vl"))
def q_slow_rate(spark, sf):
    v = _voice_lines(spark, sf)
    return v.select("book_id", "dlg_ord", "rate", V.slow_rate("rate").alias("slow_rate"))


@query(
    "voice_manifest",
    _vsql(
        f"SELECT book_id, dlg_ord, line AS text, voice_name, {SQL_LOCALE} AS locale, gender, "
        f"{sql_literal(K.AUDIO_ENCODING)} AS encoding, {SQL_RATE} AS rate, {SQL_RATE_OK} AS rate_in_range, {SQL_SLOW} AS slow_rate, "
        f"CAST({K.DEFAULT_PITCH} AS DOUBLE) AS pitch FROM vj"
    ),
)
def q_voice_manifest(spark, sf):
    return V.voice_manifest(_voice_lines(spark, sf))


# ------------------------------------------------------------------ U2, U3
ROLE_CAP = {"user": "User", "assistant": "Assistant", "system": "System"}


def fx_quoted(spark, sf):
    """Narrative paragraphs rendered from whole conversation turns: a quoted
    line with "said <Role>", two quotes without a speaker, or no quote."""
    c = table(spark, sf, "conversations")
    sentence = F.translate(F.col("text"), "\n\"", " '")
    role = F.coalesce(*[F.when(F.col("role") == k, F.lit(v)) for k, v in ROLE_CAP.items()], F.lit("Someone"))
    text = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Scene "), F.col("conv_id").cast("string"), F.lit('. "'), sentence, F.lit('," said '), role, F.lit(".")))
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("The "), F.col("role"), F.lit(' paused. "'), sentence, F.lit('" "Yes."')))
        .otherwise(F.concat(F.lit("No dialogue here: "), sentence))
    )
    return c.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("para_ord"), text.alias("text"))


SQL_SENTENCE = "translate(text, chr(10) || chr(34), ' ' || chr(39))"
SQL_ROLE = "CASE role " + " ".join(f"WHEN {sql_literal(k)} THEN {sql_literal(v)}" for k, v in ROLE_CAP.items()) + " ELSE 'Someone' END"
FX_QUOTED_SQL = f"""
fx_quoted AS (SELECT conv_id AS book_id, turn AS para_ord,
  CASE WHEN turn % 3 = 0 THEN 'Scene ' || CAST(conv_id AS VARCHAR) || '. "' || {SQL_SENTENCE} || '," said ' || {SQL_ROLE} || '.'
       WHEN turn % 3 = 1 THEN 'The ' || role || ' paused. "' || {SQL_SENTENCE} || '" "Yes."'
       ELSE 'No dialogue here: ' || {SQL_SENTENCE} END AS text
  FROM conversations)
"""
SQL_QUOTE = R.QUOTE_PATTERN.replace("'", "''")


@query(
    "rule_extract",
    "WITH " + FX_QUOTED_SQL + f""",
sp AS (SELECT book_id, para_ord, {S.strip_ws("regexp_extract(text, '^([^\"]*)\"', 1)")} AS context,
              regexp_extract_all(text, '{SQL_QUOTE}', 1) AS lines, regexp_extract_all(text, '{SQL_QUOTE}', 3) AS speakers
       FROM fx_quoted),
e AS (SELECT book_id, para_ord, context, unnest(lines) AS line, unnest(speakers) AS speaker,
             generate_subscripts(lines, 1) - 1 AS span_ord FROM sp WHERE len(lines) > 0)
SELECT book_id, para_ord, CAST(span_ord AS BIGINT) AS span_ord,
  coalesce(nullif(speaker, ''), {sql_literal(K.UNKNOWN_SPEAKER)}) AS speaker, line, context FROM e
""",
)
def q_rule_extract(spark, sf):
    return R.rule_extract(fx_quoted(spark, sf))


def _sql_name(piece: str, pattern: str) -> str:
    return f"nullif(regexp_replace(regexp_replace(regexp_extract({piece}, {sql_literal(pattern)}, 1), {sql_literal(R.LEADING_NO_NAMES)}, ''), '[ \\t\\n]+', ' ', 'g'), '')"


def _sql_tag(inside: str) -> str:
    behind = [f"list_transform(list_filter(range(1, len(pieces)), lambda i: i % 2 = {inside}), lambda i: coalesce({_sql_name('pieces[i + 1]', R.VERB_NAME)}, {_sql_name('pieces[i + 1]', R.NAME_VERB)}))",
              f"list_transform(list_filter(range(0, len(pieces) - 1), lambda i: i % 2 = {inside}), lambda i: {_sql_name('pieces[i + 1]', R.NAME_VERB_BEFORE)})"]
    return f"list_filter(list_concat({', '.join(behind)}), lambda n: n IS NOT NULL)[1]"


# the oracle reads every book one paragraph after the other, carrying its state
@query("rule_dialogues", f"""
WITH RECURSIVE {FX_NOVEL_SQL},
cut AS (SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY para_ord) AS pos, para_ord, string_split_regex(text, '{R.QUOTE_MARKS}') AS pieces FROM fx_novel),
p AS (SELECT *, len(pieces) - 1 AS marks, len(pieces) > 1 AND {S.strip_ws('pieces[1]')} = '' AS lead FROM cut),
m AS (SELECT book_id, pos, marks, lead FROM p),
s AS (
  SELECT book_id, CAST(0 AS BIGINT) AS pos, false AS open, false AS inside, CAST(0 AS BIGINT) AS run, CAST(0 AS BIGINT) AS turn FROM m WHERE pos = 1
  UNION ALL
  SELECT m.book_id, m.pos, (marks % 2 = 1) <> (s.open AND NOT lead AND marks % 2 = 1), s.open AND NOT lead AND marks % 2 = 1,
    s.run + CASE WHEN marks = 0 THEN 1 ELSE 0 END, s.turn + CASE WHEN marks > 0 AND NOT (s.open AND (lead OR marks % 2 = 1)) THEN 1 ELSE 0 END
  FROM s JOIN m ON m.book_id = s.book_id AND m.pos = s.pos + 1),
t AS (SELECT p.*, s.inside, s.run, s.turn, CAST(s.inside AS INTEGER) AS side FROM p JOIN s USING (book_id, pos) WHERE marks > 0),
g AS (SELECT *, {_sql_tag('side')} AS tag FROM t),
u AS (SELECT book_id, run, turn, arg_min(tag, pos) FILTER (tag IS NOT NULL) AS tag FROM g GROUP BY ALL),
w AS (SELECT *, last_value(tag IGNORE NULLS) OVER (PARTITION BY book_id, run, turn % 2 ORDER BY turn) AS earlier,
  first_value(tag IGNORE NULLS) OVER (PARTITION BY book_id, run, turn % 2 ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS later FROM u),
e AS (SELECT g.book_id, g.para_ord, g.turn, coalesce(w.tag, w.earlier, w.later, {sql_literal(K.UNKNOWN_SPEAKER)}) AS speaker,
  CASE WHEN w.tag IS NOT NULL THEN 'tag' WHEN coalesce(w.earlier, w.later) IS NOT NULL THEN 'alternation' ELSE 'none' END AS how,
  list_filter(range(len(pieces)), lambda i: i % 2 <> side) AS quoted, pieces,
  {S.strip_ws("array_to_string(list_filter(list_transform(list_filter(range(len(pieces)), lambda i: i % 2 = side), lambda i: " + S.strip_ws('pieces[i + 1]') + "), lambda x: x <> ''), ' ')")} AS context
  FROM g JOIN w ON g.book_id = w.book_id AND g.turn = w.turn),
l AS (SELECT *, unnest(quoted) AS i, generate_subscripts(quoted, 1) - 1 AS span_ord FROM e)
SELECT book_id, para_ord, CAST(span_ord AS BIGINT) AS span_ord, turn, speaker, how, sha256({S.strip_ws('pieces[i + 1]')}) AS line_hash, sha256(context) AS context_hash
FROM l WHERE {S.strip_ws('pieces[i + 1]')} <> ''
""")
def q_rule_dialogues(spark, sf):
    """Speeches of whole books, over several paragraphs, with speakers by tag and by alternation."""
    d = R.rule_dialogues(fx_novel(spark, sf))
    return d.select("book_id", "para_ord", "span_ord", "turn", "speaker", "how", F.sha2("line", 256).alias("line_hash"), F.sha2("context", 256).alias("context_hash"))


SQL_WORDS = S.words("coalesce(line, '')")
SQL_N = f"len({SQL_WORDS})"
SQL_MEAN = f"CASE WHEN {SQL_N} > 0 THEN list_sum(list_transform({SQL_WORDS}, lambda w: length(w))) / {SQL_N} ELSE 0.0 END"


@query(
    "rule_difficulty",
    with_fixtures(
        f"""SELECT book_id, dlg_ord, CAST({SQL_N} AS BIGINT) AS n_words, {SQL_MEAN} AS mean_word_len,
  CASE WHEN {SQL_N} <= {K.RULE_BEGINNER_MAX_WORDS} AND {SQL_MEAN} <= {K.RULE_BEGINNER_MAX_WORD_LEN} THEN 'Beginner'
       WHEN {SQL_N} >= {K.RULE_ADVANCED_MIN_WORDS} OR {SQL_MEAN} >= {K.RULE_ADVANCED_MIN_WORD_LEN} THEN 'Advanced'
       ELSE 'Intermediate' END AS difficulty_rule
FROM fx_dialogues""",
        "fx_dialogues",
    ),
)
def q_rule_difficulty(spark, sf):
    d = fx_dialogues(spark, sf)
    n, mean = R.word_stats("line")
    return d.select(
        "book_id", "dlg_ord", n.cast("bigint").alias("n_words"), mean.cast("double").alias("mean_word_len"),
        R.rule_difficulty("line").alias("difficulty_rule"),
    )
