"""Committed slices, the ledger, the bucketed cache, equal recordings."""

import os
import re

import pytest
from pyspark.sql import functions as F

from readerflow import api
from readerflow.operators import inference as I
from readerflow.operators.ledger import AnswerStore, slices


class Dying:
    """Counts its calls as files; from the n-th call on it takes its task down while ``flag`` exists."""

    def __init__(self, folder, n):
        self.folder, self.n = folder, n

    def complete(self, prompt, *, model, temperature, json_mode):
        if os.path.exists(f"{self.folder}/flag") and len(os.listdir(self.folder)) > self.n:
            raise SystemExit("gone")
        open(f"{self.folder}/{os.getpid()}-{len(prompt)}-{hash(prompt)}", "w").close()
        return f"answer to {prompt}"


def _prompts(spark, n):
    return spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("prompt_hash"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))


def test_broken_run_loses_one_slice_at_most(spark, tmp_path):
    calls, out, n, size = str(tmp_path / "calls"), str(tmp_path / "store"), 200, 20
    os.mkdir(calls)
    open(f"{calls}/flag", "w").close()

    def go():
        return I.batch_infer(_prompts(spark, n), lambda: Dying(calls, 0.9 * n), template="t", out_path=out, partitions=4, slice_requests=size, concurrency=1, retries=0)

    with pytest.raises(Exception):
        go()
    first = len(os.listdir(calls)) - 1
    kept = spark.read.parquet(out).count()
    assert 0.85 * n <= first < n and first - kept <= size and kept >= first - size
    ledger = I.infer_progress(spark, out).collect()
    assert sum(r["ok"] for r in ledger) == kept and {r["failed"] for r in ledger} == {0} and all(r["asked"] <= size for r in ledger)
    os.remove(f"{calls}/flag")
    res = go()
    assert sorted(r.raw for r in res.collect()) == sorted(f"answer to p{i}" for i in range(n))
    assert len(os.listdir(calls)) - first == n - kept  # the second run asked what was not kept, nothing else
    assert go().count() == n and len(os.listdir(calls)) - first == n - kept
    runs = I.infer_progress(spark, out).groupBy("run").agg(F.sum("asked").alias("n"), F.count("*").alias("k"), F.max("slices").alias("all")).orderBy("n").collect()
    assert [r["n"] for r in runs] == sorted([kept, n - kept]) and min(r["all"] - r["k"] for r in runs) == 0


def test_slices_cover_all_parts():
    assert slices([(3, 5), (1, 5), (2, 4), (9, 50), (10, 1)], 10) == [(1, 2, 9), (3, 3, 5), (9, 9, 50), (10, 10, 1)]
    assert slices([], 10) == []


def test_a_slice_writes_its_own_buckets_only(spark, tmp_path):
    out, n, size = str(tmp_path / "store"), 400, 50
    AnswerStore(spark, out, I.RESULT_SCHEMA, 64)
    res = I.batch_infer(_prompts(spark, n), I.EchoPartner, template="t", out_path=out, slice_requests=size)
    assert res.count() == n
    ledger = I.infer_progress(spark, out).collect()
    assert sum(r["asked"] for r in ledger) == n and all(r["asked"] <= size for r in ledger)
    # each bucket is in one slice or, at a border, in two: not a file of each bucket for each slice
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) <= 64 + 2 * len(ledger)
    store = AnswerStore(spark, out, I.RESULT_SCHEMA)
    assert store.rows().join(I.with_request_key(_prompts(spark, n), "t"), "request_key").count() == n  # each answer is in its key's bucket


def test_cache_side_is_not_shuffled(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "s"), I.RESULT_SCHEMA, 16)
    prompts = I.with_request_key(_prompts(spark, 50), "t")
    rows = prompts.limit(30).select("request_key", "prompt_hash", F.lit("t").alias("template"), F.lit("m").alias("model"), F.lit("x").alias("raw"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))
    store.append(rows)
    store.append(rows.limit(10))  # another commit: several files a bucket
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        left = I.new_prompts(prompts, store.answered(), "request_key")
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan, plan
    cache_side = plan[plan.index("FileScan") - 400:]
    assert "Exchange" not in cache_side[:400] and re.search("SelectedBucketsCount: 16 out of 16", plan)
    again = AnswerStore(spark, str(tmp_path / "s"), I.RESULT_SCHEMA, 5)
    assert again.buckets == 16 and again.rows().count() == 40


def test_folder_without_buckets_is_read_as_it_is(spark, tmp_path):
    out = str(tmp_path / "old")
    p = I.with_request_key(_prompts(spark, 3), "t")
    p.filter("prompt = 'p1'").select("request_key", "prompt_hash", F.lit("t").alias("template"), F.lit("m").alias("model"), F.lit("held").alias("raw"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error")).write.parquet(out)
    res = I.batch_infer(_prompts(spark, 3), I.EchoPartner, template="t", out_path=out)
    assert sorted(r.raw for r in res.collect())[0] == "held" and res.count() == 3


class Counted:
    def __init__(self, folder):
        self.folder = folder

    def transcribe(self, audio, *, model, language, file_ext):
        open(f"{self.folder}/{len(os.listdir(self.folder))}-{os.getpid()}-{len(audio)}", "w").close()
        return audio.decode()


def test_equal_recordings_are_sent_once(spark, tmp_path):
    calls = str(tmp_path / "calls")
    os.mkdir(calls)
    rows = [(f"/a/{k}.wav", w) for k, w in enumerate([b"one", b"two2", b"one", b"one"])]
    audio = spark.createDataFrame(rows, "path string, content binary")
    for out in (str(tmp_path / "t"), str(tmp_path / "t"), None):
        got = I.batch_transcribe(audio, lambda: Counted(calls), out_path=out, concurrency=1).collect()
        assert sorted((r.path, r.text) for r in got) == [(p, c.decode()) for p, c in rows]
    assert len(os.listdir(calls)) == 4  # two with the store, none on its second run, two without


class Down:
    def complete(self, prompt, *, model, temperature, json_mode):
        raise RuntimeError("down")


def test_failed_calls_are_told_from_answers(spark, tmp_path):
    lines = spark.createDataFrame([(1, 0, "Good day.")], "book_id bigint, dlg_ord bigint, line string")
    for k, call in enumerate((api.modernise, api.hints)):
        r = call(lines, Down, str(tmp_path / str(k))).first()
        assert (r["status"], r["error"]) == ("error", "RuntimeError: down")
    d = lines.selectExpr("*", "'A' AS speaker", "'c' AS context")
    r = api.roleplay_setups(d, Down, str(tmp_path / "setup")).first()
    assert (r["status"], r["error"]) == ("error", "RuntimeError: down")
