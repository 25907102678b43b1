"""End-to-end flows through the table-level API with deterministic fake clients."""

import json

from pyspark.sql import functions as F

from readerflow import api
from readerflow.operators import conversation as C
from readerflow.operators import dialogues as D
from readerflow.operators.inference import EchoClient, EchoPartner, EchoTranscriber
from readerflow.sources.fixtures import fx_dialogues, fx_messages, fx_setups

SF = "/root/testdata/sf0.001"


class SetupClient:
    def complete(self, prompt, *, model, temperature, json_mode):
        return json.dumps({"scenario": "A hall.", "user_role": "Ann", "ai_roles": ["Bob"],
                           "opening_line": "Hello.", "vocabulary_tips": ["hi"]})


class Unreachable:
    def complete(self, prompt, *, model, temperature, json_mode):
        raise RuntimeError("not to be called")


class FeedbackClient:
    def complete(self, prompt, *, model, temperature, json_mode):
        return json.dumps({"accuracy_score": len(prompt) % 101, "pronunciation_issues": ["x"],
                           "fluency_feedback": "ok", "grammar_note": None, "encouragement": "go"})


def test_books_to_dialogues(spark, tmp_path):
    land = tmp_path / "landed"
    land.mkdir()
    (land / "1-0.txt").write_text(
        '*** START OF THE PROJECT GUTENBERG BOOK ***\nCHAPTER I\n"Hi," said Ann.\nCHAPTER II\n"Bye."\n'
        "*** END OF THE PROJECT GUTENBERG BOOK ***"
    )
    (land / "pg2.txt").write_text("")
    requested = spark.createDataFrame([(1,), (2,)], "book_id bigint")
    books, errors = api.fetch_books(spark, str(land), requested)
    assert [r.book_id for r in errors.collect()] == [2]
    clean = api.preprocess_books(books)
    assert [r.title for r in api.extract_chapters(clean).orderBy("chapter_ord").collect()] == ["CHAPTER I", "CHAPTER II"]
    dlg, rej = api.extract_dialogues(clean, EchoClient, str(tmp_path / "res"))
    assert sorted((r.chapter_ord, r.line) for r in dlg.collect()) == [(1, "Hi,"), (2, "Bye.")] and rej.count() == 0
    dlg, rej = api.extract_dialogues(clean, EchoClient, str(tmp_path / "first"), whole=False)
    assert sorted(r.line for r in dlg.collect()) == ["Bye.", "Hi,"] and rej.count() == 0
    # a book whose answers are cached is in the result like any other
    held = spark.read.parquet(str(tmp_path / "res"))
    dlg, _ = api.extract_dialogues(clean, Unreachable, str(tmp_path / "none"), cache=held)
    assert sorted(r.line for r in dlg.collect()) == ["Bye.", "Hi,"]


def test_roleplay_and_feedback(spark, tmp_path):
    setups = api.roleplay_setups(fx_dialogues(spark, SF), SetupClient, str(tmp_path / "s"))
    r = setups.first()
    assert r.status == "ok" and r.setup.ai_roles == ["Bob"]
    attempts = spark.createDataFrame([(1, 1, 0, "the cat", "the dog")], "learner_id bigint, book_id bigint, dlg_ord bigint, target string, answer string")
    fb = api.evaluate_responses(attempts, FeedbackClient, str(tmp_path / "f")).first()
    assert fb.status == "ok" and fb.pronunciation_issues == ["x"] and fb.accuracy_score >= 0


def test_new_scenario_keeps_old_rows(spark):
    s = fx_setups(spark, SF)
    moved = C.new_scenario(s, 1000)
    assert moved.select(F.min("conv_id")).first()[0] >= 1000 and s.count() == moved.count()


def test_chat_replies(spark, tmp_path):
    msgs = fx_messages(spark, SF)
    out = api.chat_replies(msgs, fx_setups(spark, SF), EchoPartner, str(tmp_path / "c"))
    waiting = msgs.groupBy("conv_id").agg(F.max_by("role", "turn").alias("r")).filter("r = 'user'")
    assert out.count() == waiting.count() > 0


def test_equal_last_lines_with_other_histories_get_two_calls(spark, tmp_path):
    setups = spark.createDataFrame([(c, "s", "U", ["R"], "o", []) for c in (1, 2, 3)],
                                   "conv_id bigint, scenario string, user_role string, ai_roles array<string>, opening_line string, vocabulary_tips array<string>")
    msgs = spark.createDataFrame([(1, 0, "assistant", "Tea?"), (1, 1, "user", "Yes."), (2, 0, "assistant", "War?"), (2, 1, "user", "Yes."),
                                  (3, 0, "user", "Yes."), (3, 1, "assistant", "Done.")], "conv_id bigint, turn bigint, role string, content string")
    out = {r.conv_id: (r.n_messages, r.raw) for r in api.chat_replies(msgs, setups, EchoPartner, str(tmp_path / "c")).collect()}
    assert set(out) == {1, 2} and out[1][0] == out[2][0] == 3 and out[1][1] != out[2][1]
    prompt = json.loads(C.open_requests(msgs, setups).filter("conv_id = 1").first().prompt)
    assert [m["role"] for m in prompt] == ["system", "assistant", "user"] and prompt[1]["content"] == "Tea?"


def test_practice_loop(spark, tmp_path):
    (tmp_path / "audio").mkdir()
    (tmp_path / "audio" / "1.wav").write_bytes(b"the dog")
    (tmp_path / "audio" / "2.wav").write_bytes(b"\xff")
    t = api.transcribe(spark, str(tmp_path / "audio"), EchoTranscriber, str(tmp_path / "t"))
    names = {r.path.rsplit("/", 1)[-1]: r.path for r in t.collect()}
    rec = spark.createDataFrame([(names["1.wav"], 7, 1, 0, "t1"), (names["2.wav"], 7, 1, 0, "t2")], "path string, learner_id bigint, book_id bigint, dlg_ord bigint, ts string")
    lines = spark.createDataFrame([(1, 0, "A", "the cat")], "book_id bigint, dlg_ord bigint, speaker string, line string")
    ev = api.spoken_practice(rec, t, lines, FeedbackClient, str(tmp_path / "f"))
    kept = api.record_practice(ev)
    assert [(r.learner_id, r.ts, r.mode, r.status) for r in kept.collect()] == [(7, "t1", "shadowing", "ok")]
    learners = spark.createDataFrame([(7, 1), (8, 1)], "learner_id bigint, book_id bigint")
    done = api.P.progress_summary(learners, kept, D.count_dialogues(lines)).orderBy("learner_id").collect()
    assert [(r.learner_id, r.n_practice) for r in done] == [(7, 1), (8, 0)]
    assert api.P.feedback_card(ev).count() == 1
    turns = api.spoken_turns(rec.withColumn("conv_id", F.lit(5)), t).collect()
    assert [(r.conv_id, r.user_input) for r in turns] == [(5, "the dog")]


def test_hints_modernise_analysis(spark, tmp_path):
    d = fx_dialogues(spark, SF)
    assert api.hints(d, EchoClient, str(tmp_path / "h")).count() == d.count()
    assert api.modernise(d, EchoClient, str(tmp_path / "m")).count() == d.count()
    a = api.analyse_conversations(fx_messages(spark, SF), EchoClient, str(tmp_path / "a"))
    assert a.count() == C.message_counts(fx_messages(spark, SF)).filter("analysable").count()
