"""Hand-made edge rows from FIXTURES.md §2 (dialogues, practice, conversations,
voice, sources)."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from readerflow import constants as K
from readerflow.operators import conversation as C
from readerflow.operators import dialogues as D
from readerflow.operators import inference as I
from readerflow.operators import ordinal as O
from readerflow.operators import practice as P
from readerflow.operators import voice as V
from readerflow.sources import books as B
from readerflow.sources import media as M

DLG_SCHEMA = "book_id bigint, dlg_ord bigint, speaker string, line string, context string, difficulty string"


def dlg(spark, rows):
    return spark.createDataFrame(rows, DLG_SCHEMA)


def test_difficulty_in(spark):
    df = dlg(spark, [(1, 0, "A", "x", "", None), (1, 1, "A", "x", "", "Expert"), (1, 2, "A", "x", "", "intermediate")])
    kept = [r.dlg_ord for r in df.filter(D.difficulty_in(["Intermediate"])).collect()]
    assert kept == [0]


def test_speaker_in(spark):
    df = dlg(spark, [(1, 0, "A", "x", "", None), (1, 1, "B", "x", "", None)])
    assert df.filter(D.speaker_in([K.ALL_SPEAKERS])).count() == 2
    assert [r.speaker for r in df.filter(D.speaker_in([K.ALL_SPEAKERS, "A"])).collect()] == ["A"]
    assert df.filter(D.speaker_in([])).count() == 0


def test_keyword_is_literal(spark):
    df = dlg(spark, [(1, 0, "A", "Pay 50% now", "", None), (1, 1, "A", "Pay 500 now", "", None)])
    assert [r.dlg_ord for r in df.filter(D.keyword_contains("50%")).collect()] == [0]
    assert df.filter(D.keyword_contains("")).count() == 2


def test_empty_fallback(spark):
    df = dlg(spark, [(1, 0, "A", "hello", "", None), (1, 1, "A", "bye", "", None), (2, 0, "B", "x", "", None), (2, 1, "B", "y", "", None)])
    out = sorted((r.book_id, r.dlg_ord) for r in D.empty_fallback(df, D.keyword_contains("hello")).collect())
    assert out == [(1, 0), (2, 0), (2, 1)]


def test_preview_label(spark):
    df = dlg(spark, [(1, 0, "A", "x" * 40, "", None)])
    assert D.preview_labels(df).first().label == "#1 A: " + "x" * 30 + "..."


def test_first_lines_and_slice(spark):
    df = dlg(spark, [(1, i, "A", f"l{i}", f"c{i}", None) for i in range(12)])
    s = D.roleplay_slice(df, 1, 10)
    assert s.count() == 10
    assert sorted(r.dlg_ord for r in D.first_lines(s, 1).collect()) == list(range(1, 9))
    assert D.first_context(s).first().context == "c1"


@pytest.mark.parametrize("block", [1, 2, 3, 1 << 16])
def test_ordered_positions_match_window(spark, block):
    rows = [(k, o) for k in range(3) for o in range(0, 3 * (k + 2), k + 1)]
    df = spark.createDataFrame(rows, "k bigint, o bigint")
    got = O.ordered_positions(df, "k", "o", block).collect()
    w = Window.partitionBy("k").orderBy("o")
    ref = df.select(
        "k", "o", F.row_number().over(w).alias("position"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("count"),
        F.lag("o").over(w).alias("prev"), F.lead("o").over(w).alias("next"),
    ).collect()
    key = lambda r: (r["k"], r["o"])
    assert sorted((r.k, r.o, r.position, r["count"], r.prev, r.next) for r in got) == sorted(
        (r.k, r.o, r.position, r["count"], r.prev, r.next) for r in ref
    )
    assert len(got) == len(ref) and key


@pytest.mark.parametrize("block", [1, 2, 1 << 16])
def test_running_totals_match_window(spark, block):
    rows = [(k, o, o * 10 + k) for k in range(3) for o in range(7)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, v bigint")
    got = O.running_totals(df, "k", "o", {"n": "*", "s": "v"}, block).collect()
    exp = {(k, o): (sum(1 for kk, oo, _ in rows if kk == k and oo < o), sum(v for kk, oo, v in rows if kk == k and oo < o)) for k, o, _ in rows}
    assert {(r.k, r.o): (r.n, r.s) for r in got} == exp


def overlap(spark, target, answer):
    df = spark.createDataFrame([(target, answer)], "target string, answer string")
    return df.select(P.word_overlap("target", "answer").alias("p"), P.display_round(P.word_overlap("target", "answer")).alias("d")).first()


def test_word_overlap(spark):
    r = overlap(spark, "the cat the dog", "The DOG")
    assert abs(r.p - 200 / 3) < 1e-9 and r.d == 67
    assert overlap(spark, "", "anything").p == 0
    assert overlap(spark, "hi, you", "hi you").p == 50


def test_nonblank_answer(spark):
    df = spark.createDataFrame([(" \t",), ("a",)], "answer string")
    assert [r[0] for r in df.select(P.nonblank("answer")).collect()] == [False, True]


FB = "learner_id bigint, ts timestamp, mode string, accuracy_score double, pronunciation_issues array<string>"


def test_avg_accuracy_missing_counts_zero(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, "shadowing", 80.0, []), (1, t, "shadowing", None, []), (1, t, "shadowing", 70.0, []), (1, t, "dictation", 10.0, [])], FB)
    r = P.learner_progress(df).first()
    assert (r.n_practice, r.avg_accuracy, r.avg_display) == (3, 50.0, 50)


def test_half_even_display(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "x double")
    assert [r[0] for r in df.select(P.display_round("x")).collect()] == [2, 4]


def test_score_band(spark):
    df = spark.createDataFrame([(80,), (79,), (60,), (59,), (None,)], "accuracy_score int")
    assert [r[0] for r in df.select(P.score_band()).collect()] == ["green", "yellow", "yellow", "red", "red"]


def test_transcript(spark):
    lines = spark.createDataFrame([(1, 0, "A", "hi", "ctx"), (1, 1, "B", "yo", "")], "book_id bigint, dlg_ord bigint, speaker string, line string, context string")
    assert C.transcripts(lines).first().transcript == 'A: "hi" \nB: "yo" '
    many = spark.createDataFrame([(1, i, "A", f"l{i}", "") for i in range(20)], "book_id bigint, dlg_ord bigint, speaker string, line string, context string")
    assert C.transcripts(many, 2, 10).first().n_lines == 8


SETUP = "conv_id bigint, scenario string, user_role string, ai_roles array<string>, opening_line string, vocabulary_tips array<string>"
MSG = "conv_id bigint, turn bigint, role string, content string"


def test_opening_turn_defaults(spark):
    setups = spark.createDataFrame([(1, None, None, None, None, None)], SETUP)
    msgs = spark.createDataFrame([], MSG)
    r = C.opening_turns(setups, msgs).first()
    assert (r.content, r.display_role, r.role) == (K.DEFAULT_OPENING_LINE, K.DEFAULT_AI_ROLE, "assistant")


def test_chat_history_counts(spark):
    setups = spark.createDataFrame([(1, "s", "U", ["R"], "open", [])], SETUP)
    msgs = spark.createDataFrame([(1, -1, "assistant", "open"), (1, 0, "user", "u1")], MSG)
    r = C.chat_requests(msgs, setups, block_size=1).first()
    sys_prompt = K.CHAT_SYSTEM_PROMPT.format(roles="R", scenario="s")
    assert (r.turn, r.n_messages, r.history_from) == (0, 3, -1)
    other = spark.createDataFrame([(1, -1, "assistant", "hello"), (1, 0, "user", "u1")], MSG)
    assert C.chat_requests(other, setups, block_size=1).first().history_digest != r.history_digest
    assert r.n_chars == len(sys_prompt) + len("open") + len("u1")
    assert r.system_prompt == sys_prompt


def test_min_messages_and_analysis(spark):
    msgs = spark.createDataFrame([(1, 0, "assistant", "a"), (2, 0, "assistant", "a"), (2, 1, "user", 'say "hi"')], MSG)
    counts = {r.conv_id: r.analysable for r in C.message_counts(msgs).collect()}
    assert counts == {1: False, 2: True}
    p = C.analysis_prompts(msgs).collect()
    assert [r.conv_id for r in p] == [2]
    import json

    assert p[0].chunk_no == 0
    lines = p[0].prompt.split("User's lines: ", 1)[1]
    assert json.loads(lines) == ['say "hi"']


def test_collect_user_lines_chunked(spark):
    msgs = spark.createDataFrame([(1, t, "user", f"l{t}") for t in range(7)], MSG)
    rows = C.collect_user_lines(msgs, chunk=2).orderBy("chunk_no").collect()
    import json

    assert [r.n_lines for r in rows] == [2, 2, 2, 1]
    assert [x for r in rows for x in json.loads(r.lines_json)] == [f"l{t}" for t in range(7)]


def test_voice_lookup_and_rates(spark):
    df = spark.createDataFrame([("nope", 1.0), (K.VOICES[4][0], 0.6)], "voice_key string, rate double")
    rows = V.lookup_voices(df).select("voice_key", "voice_name", V.voice_locale("voice_name").alias("loc"), V.slow_rate("rate").alias("slow")).collect()
    by = {r.voice_key: r for r in rows}
    assert (by["nope"].voice_name, by["nope"].loc) == ("en-US-Wavenet-F", "en-US")
    assert abs(by["nope"].slow - 0.7) < 1e-12 and by[K.VOICES[4][0]].slow == 0.5
    assert by[K.VOICES[4][0]].loc == "en-GB"


def test_book_scan_fallback_and_reject(spark):
    c = spark.createDataFrame([(1, 2, "two"), (1, 3, "three"), (2, 3, "")], "book_id bigint, priority int, raw_text string")
    best = {r.book_id: (r.priority, r.raw_text) for r in B.book_scan_fallback(c).collect()}
    assert best == {1: (2, "two"), 2: (None, "")}
    ok, errors = B.split_loaded(B.book_scan_fallback(c))
    assert [r.book_id for r in errors.collect()] == [2] and ok.count() == 1


def test_scan_landed_books(spark, tmp_path):
    d = tmp_path / "landed"
    d.mkdir()
    (d / "7-0.txt").write_text("")  # empty: skipped, next location wins
    (d / "7.txt").write_text("second\nline two\n")
    (d / "pg7.txt").write_text("third")
    (d / "pg8.txt").write_text("only\n\nbook")
    cands = B.scan_landed_books(spark, str(d))
    assert cands.count() == 3  # one row per non-empty file, whole text
    best = {r.book_id: (r.priority, r.raw_text) for r in B.book_scan_fallback(cands).collect()}
    assert best == {7: (2, "second\nline two\n"), 8: (3, "only\n\nbook")}


def test_catalog_lookup_and_search(spark):
    req = spark.createDataFrame([("Emma (Jane Austen)",), ("Nope",)], "title string")
    assert [r.catalog_id for r in B.catalog_lookup(req).collect()] == [158]
    q = spark.createDataFrame([(1, "AUSTEN")], "qid int, q string")
    assert sorted(r.book_id for r in B.catalog_search(q).collect()) == [158, 161, 1342]


def test_latest_loads(spark):
    loads = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (1, 3, "")], "book_id bigint, load_seq int, raw_text string")
    assert B.latest_loads(loads).first().raw_text == "new"


class FakeAudio:
    def transcribe(self, audio, *, model, language, file_ext):
        if audio == b"bad":
            raise RuntimeError("boom")
        return f"{len(audio)}:{language}:{file_ext}"


def test_audio_scan_and_transcribe(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"abcd")
    (tmp_path / "b.wav").write_bytes(b"bad")
    audio = M.scan_audio(spark, str(tmp_path))
    assert audio.count() == 2
    out = {os.path.basename(r.path): (r.text, r.status) for r in I.batch_transcribe(audio, FakeAudio).collect()}
    assert out["a.wav"] == ("4:en:wav", "ok")
    assert out["b.wav"][1] == "error"


def test_write_table_dynamic_overwrite(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "book_id bigint, v string")
    M.write_keyed(df, p, "book_id", 4)
    M.write_keyed(spark.createDataFrame([(1, "z")], "book_id bigint, v string"), p, "book_id", 4)
    got = sorted((r.book_id, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(1, "z"), (2, "b")]


def test_write_keyed_keeps_other_keys_of_a_bucket(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(i, j, f"{i}-{j}") for i in range(40) for j in range(3)], "book_id bigint, n int, v string")
    M.write_keyed(df, p, "book_id", 2)
    M.write_keyed(df.filter("book_id = 1 AND n < 2").withColumn("v", F.lit("new")), p, "book_id", 2)
    M.write_keyed(df.limit(0), p, "book_id", 2, replace=spark.createDataFrame([(6,), (77,)], "book_id bigint"))
    got = {(r.book_id, r.n): r.v for r in spark.read.parquet(p).collect()}
    want = {(i, j): f"{i}-{j}" for i in range(40) for j in range(3) if i not in (1, 6)} | {(1, 0): "new", (1, 1): "new"}
    assert got == want
    M.write_keyed(df.limit(0), p, "book_id", 2, replace=df.select("book_id"))
    assert spark.read.schema(df.schema).parquet(p).count() == 0
    assert [f for f in os.listdir(tmp_path) if "staged" in f] == []


class CountingClient:
    def complete(self, prompt, *, model, temperature, json_mode):
        return '{"dialogues": [{"speaker": "A", "line": "%s"}]}' % prompt[-3:]


def test_batch_infer_cache_and_dedup(spark, tmp_path):
    prompts = spark.createDataFrame([("h1", "p-1"), ("h1", "p-1"), ("h2", "p-2"), ("h3", "p-3")], "prompt_hash string, prompt string")
    key = prompts.filter("prompt_hash = 'h3'").select(I.request_key("prompt", "t", K.DEFAULT_MODEL, None, True).alias("request_key"))
    held = '{"dialogues": [{"speaker": "A", "line": "held"}]}'
    cache = key.select("request_key", F.lit("h3").alias("prompt_hash"), F.lit("t").alias("template"), F.lit(K.DEFAULT_MODEL).alias("model"),
                       F.lit(held).alias("raw"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))
    for out in (str(tmp_path / "res"), None):
        res = I.batch_infer(prompts, CountingClient, template="t", cache=cache, partitions=2, out_path=out)
        assert sorted(r.prompt_hash for r in res.collect()) == ["h1", "h2", "h3"]  # cached answers are in the result
        dlg, rej = I.explode_responses(res, ["prompt_hash"])
        assert sorted(r.line for r in dlg.collect()) == ["held", "p-1", "p-2"] and rej.count() == 0
    assert spark.read.parquet(str(tmp_path / "res")).count() == 2  # and were not asked for


class Limited:
    """Fails until the given file exists."""

    def __init__(self, flag):
        self.flag = flag

    def complete(self, prompt, *, model, temperature, json_mode):
        if not os.path.exists(self.flag):
            raise RuntimeError("rate limit")
        return f"{model}:{prompt}"


def test_batch_infer_asks_again_after_failure_and_for_other_models(spark, tmp_path):
    prompts = spark.createDataFrame([("h1", "p-1"), ("h2", "p-2")], "prompt_hash string, prompt string")
    out, flag = str(tmp_path / "res"), str(tmp_path / "flag")

    def run(**kw):
        res = I.batch_infer(prompts, lambda: Limited(flag), template="t", out_path=out, retries=1, wait_seconds=0.0, **kw)
        return sorted((r.prompt_hash, r.status, r.raw) for r in res.collect())

    assert [r[:2] for r in run()] == [("h1", "error"), ("h2", "error")]
    open(flag, "w").close()
    first = run()
    assert first == [("h1", "ok", f"{K.DEFAULT_MODEL}:p-1"), ("h2", "ok", f"{K.DEFAULT_MODEL}:p-2")]
    assert run(model="other") == [("h1", "ok", "other:p-1"), ("h2", "ok", "other:p-2")]
    os.remove(flag)
    assert run() == first  # held answers need no client


def test_transcripts_are_kept(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.wav").write_bytes(b"abcd")
    (tmp_path / "a" / "y.wav").write_bytes(b"bad")
    out = str(tmp_path / "t")
    for _ in range(2):
        rows = I.batch_transcribe(M.scan_audio(spark, str(tmp_path / "a")), FakeAudio, out_path=out, retries=0).collect()
        assert sorted((os.path.basename(r.path), r.status, r.text) for r in rows) == [("x.wav", "ok", "4:en:wav"), ("y.wav", "error", None)]
    assert spark.read.parquet(out).filter("status = 'ok'").count() == 1


def test_scores_are_kept_as_sent(spark):
    from readerflow.functions import model_json as J

    raws = [('{"accuracy_score": 87.5}', 87.5, "ok"), ('{"accuracy_score": "90"}', 90.0, "ok"), ('{"accuracy_score": "n/a"}', None, "bad_score"),
            ('{"accuracy_score": null}', None, "ok"), ("{}", None, "ok"), ("[1]", None, "malformed"), ("oops", None, "malformed")]
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(raws)], "i int, raw string")
    assert [(r.accuracy_score, r.status) for r in J.parse_feedback(df).orderBy("i").collect()] == [(s, t) for _, s, t in raws]


def test_repeated_json_keys(spark):
    from readerflow.functions import model_json as J

    raws = ['{"a": [1], "b": [2], "a": [3]}', '{"a": 1, "b": [2], "a": [3]}', '{"a": [1], "b": [2], "a": 4}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string").orderBy("i")
    rows = df.select(J.unwrap_dialogues("raw").alias("u")).select("u.status", F.to_json(F.col("u.items")).alias("j")).collect()
    assert [(r.status, r.j) for r in rows] == [("ok", "[3]"), ("ok", "[3]"), ("ok", "[2]")]


def test_progress_summary_shows_learners_without_practice(spark):
    learners = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "learner_id bigint, book_id bigint")
    fb = spark.createDataFrame([(1, "shadowing", 80.0), (1, "dictation", 0.0)], "learner_id bigint, mode string, accuracy_score double")
    counts = spark.createDataFrame([(10, 5), (11, 0)], "book_id bigint, n_dialogues bigint")
    got = sorted(tuple(r) for r in P.progress_summary(learners, fb, counts).collect())
    assert got == [(1, 10, 5, 1, 80), (2, 10, 5, 0, None)]


def test_feedback_card_defaults(spark):
    fb = spark.createDataFrame([(1, None, [], None, "", None), (2, 80.0, ["a", "b"], "f", "g", "e")],
                               "learner_id bigint, accuracy_score double, pronunciation_issues array<string>, fluency_feedback string, grammar_note string, encouragement string")
    got = sorted(tuple(r) for r in P.feedback_card(fb).collect())
    assert got == [(1, 0.0, "red", "#e17055", None, "", None, ""), (2, 80.0, "green", "#00b894", "`a`, `b`", "f", "g", "e")]


def test_lines_outside_the_range_raise(spark):
    df = dlg(spark, [(1, 0, "A", "x", "", None)])
    for n in (2, 11, 25):
        with pytest.raises(ValueError):
            D.roleplay_slice(df, 0, n)


def test_rates_are_passed_through(spark):
    df = spark.createDataFrame([(1, "x", "nope", 2.0), (2, "y", "nope", 0.6)], "i int, line string, voice_key string, rate double")
    assert sorted((r.rate, r.rate_in_range, r.slow_rate) for r in V.voice_manifest(df).collect()) == [(0.6, True, 0.5), (2.0, False, 1.7)]


def test_stand_in_model_keeps_long_quotes():
    import json

    prompt = 'Text: "' + "a" * 250 + '" x "b"'
    lines = [d["line"] for d in json.loads(I.EchoClient().complete(prompt, model="", temperature=None, json_mode=True))["dialogues"]]
    assert lines == ["a" * 250, "b"]


def test_empty_loads_are_rejected_on_stripped_text(spark):
    hollow = K.START_MARKERS[0] + " X ***\n \n" + K.END_MARKERS[0] + " X ***"
    books = spark.createDataFrame([(1, "text"), (2, " \n\t"), (3, hollow), (4, ""), (5, None)], "book_id bigint, raw_text string")
    ok, errors = B.split_loaded(books)
    assert [r.book_id for r in ok.collect()] == [1] and sorted(r.book_id for r in errors.collect()) == [2, 3, 4, 5]


def test_oversized_files_are_reported_not_read(spark, tmp_path):
    (tmp_path / "1-0.txt").write_text("x" * 100)
    (tmp_path / "2-0.txt").write_text("ok")
    assert [r.book_id for r in B.scan_landed_books(spark, str(tmp_path), 50).collect()] == [2]
    assert [(r.book_id, r.reason) for r in B.oversized_files(spark, str(tmp_path), 50).collect()] == [(1, "file too large: 100 bytes")]


def test_equal_copies_of_a_location(spark):
    c = spark.createDataFrame([(1, 2, "same"), (1, 2, "same"), (1, 3, "x")], "book_id bigint, priority int, raw_text string")
    assert [tuple(r) for r in B.book_scan_fallback(c, repeated=True).collect()] == [(1, 2, "same")]


def test_windows_hold_every_character(spark):
    from readerflow.operators import chapters as CH
    from readerflow.sources.fixtures import fx_books

    clean = CH.clean_books(fx_books(spark, "/root/testdata/sf0.01"))
    total = CH.chapters(clean).agg(F.sum(F.length("body"))).first()[0]
    w = CH.chapter_windows(clean)
    assert w.agg(F.sum(F.length("window")), F.max(F.length("window"))).first() == (total, K.MAX_PROMPT_CHARS)
    back = w.groupBy("book_id", "chapter_ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window_no", "window"))), lambda x: x["window"]), "").alias("body"))
    assert back.join(CH.chapters(clean), ["book_id", "chapter_ord", "body"], "left_anti").count() == 0


def test_batch_infer_resumes_without_duplicates(spark, tmp_path):
    out = str(tmp_path / "res")
    first = spark.createDataFrame([("h1", "p-1"), ("h2", "p-2")], "prompt_hash string, prompt string")
    I.batch_infer(first, CountingClient, template="t", out_path=out)
    more = spark.createDataFrame([("h1", "p-1"), ("h2", "p-2"), ("h4", "p-4")], "prompt_hash string, prompt string")
    res = I.batch_infer(more, CountingClient, template="t", out_path=out)
    assert sorted(r.prompt_hash for r in res.collect()) == ["h1", "h2", "h4"]
