"""Prompts and batch model inference (X1, X3-X5, X7-X9 renders; U1, U4, J5).

A hosted model is an external service, so the engine never embeds one: the
caller injects ``client_factory`` (called once per partition on the
executors). Prompts are rendered JVM-side, de-duplicated by ``prompt_hash``,
checked against a bucketed store of answers, and only the new ones cross into
Python through ``mapInPandas`` (Arrow batches). Results should be written once
and read back (``out_path``): new answers are committed slice by slice (see
``ledger``), task retries may call the model again, but nothing downstream
re-evaluates the model. Only answers count as done; a failed request is asked
again on the next run.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import model_json as J
from ..functions import text as T
from ..session import scratch_path
from ..sources.audio import MAX_PART_BYTES, audio_parts
from .ledger import PARTS, AnswerStore, key_bucket, key_part, slices

# Ship this module's functions by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIALOGUE_COLUMNS = [*J.DIALOGUE_FIELDS, "key_expressions"]
RESULT_SCHEMA = "request_key string, prompt_hash string, template string, model string, raw string, status string, error string"
# A slice is dealt to more tasks than there are cores only if each gets so many requests.
TASK_REQUESTS = 1000
TRANSCRIPT_SCHEMA = "request_key string, path string, model string, text string, status string, error string"


class ModelClient(Protocol):
    def complete(self, prompt: str, *, model: str, temperature: float | None, json_mode: bool) -> str: ...


class TranscribeClient(Protocol):
    def transcribe(self, audio: bytes, *, model: str, language: str, file_ext: str) -> str: ...


# ------------------------------------------------------------------ prompt renders
def prompt_hash(prompt: Column | str) -> Column:
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.sha2(p, 256)


def extraction_prompt(text: Column | str) -> Column:
    """Extraction prompt over a text, all of it; callers pass windows (or,
    for the first window only, ``chapters.prompt_window``)."""
    t = F.col(text) if isinstance(text, str) else text
    return T.render(K.EXTRACTION_PROMPT, text=t)


def feedback_prompt(target: Column | str, user_input: Column | str) -> Column:
    """X4 prompt render."""
    t = F.col(target) if isinstance(target, str) else target
    u = F.col(user_input) if isinstance(user_input, str) else user_input
    return T.render(K.FEEDBACK_PROMPT, target=t, user_input=u)


def modernise_prompt(text: Column | str) -> Column:
    """Classic -> modern English rewrite request."""
    t = F.col(text) if isinstance(text, str) else text
    return T.render(K.MODERNISE_PROMPT, text=t)


def hint_prompt(line: Column | str) -> Column:
    """Translation-hint request for one line."""
    ln = F.col(line) if isinstance(line, str) else line
    return T.render(K.HINT_PROMPT, line=ln)


# ------------------------------------------------------------------ response parsing
def explode_responses(responses: DataFrame, key_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """X2 + X3: responses(raw, *key_cols) -> (dialogues, rejects).

    dialogues: key_cols + dlg_ord + D5 fields, one row per object element.
    rejects: key_cols + dlg_ord + reason for non-object elements, and one row
    (dlg_ord null) per malformed response.
    """
    e = exploded_items(responses, key_cols)
    dialogues = e.filter("is_object").select(*key_cols, "dlg_ord", *DIALOGUE_COLUMNS)
    return dialogues, e.filter("NOT is_object").select(*key_cols, "dlg_ord", "reason")


def exploded_items(responses: DataFrame, key_cols: list[str]) -> DataFrame:
    """X2 + X3 in one pass, each response parsed once: one row per list element
    (``is_object``, D5 fields or ``reason``) and one per malformed response
    (``dlg_ord`` null)."""
    u = responses.select(*key_cols, J.unwrap_dialogues("raw").alias("u"))
    # posexplode_outer: no inferred size(items) > 0 filter re-parsing the JSON below
    items = u.select(*key_cols, F.col("u.status").alias("__status"), F.posexplode_outer("u.items").alias("dlg_ord", "item")).filter(
        F.col("dlg_ord").isNotNull() | (F.col("__status") == J.STATUS_MALFORMED)
    )
    is_object = F.coalesce(J.variant_kind(F.col("item")) == "OBJECT", F.lit(False))
    reason = F.when(F.col("dlg_ord").isNull(), F.lit("malformed response")).when(~is_object, J.reject_reason(F.col("item")))
    return items.select(
        *key_cols, F.col("dlg_ord").cast("bigint").alias("dlg_ord"), is_object.alias("is_object"),
        *J.dialogue_fields(F.col("item")), reason.alias("reason"))


# ------------------------------------------------------------------ U1, J5
def request_key(prompt: Column | str, template: str, model: str, temperature: float | None, json_mode: bool) -> Column:
    """What an answer depends on: the prompt and every setting of the call."""
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.sha2(F.concat_ws("\x1f", F.lit(template), F.lit(model), F.lit(str(temperature)), F.lit(str(json_mode)), p), 256)


def new_prompts(prompts: DataFrame, cache: DataFrame | None, key: str = "prompt_hash") -> DataFrame:
    """Prompts whose key has no cached result (left-anti join on the keys).

    A cache that is bucketed by the key (``ledger.AnswerStore``) is read without a shuffle."""
    if cache is None:
        return prompts
    return prompts.join(cache.select(key), key, "left_anti")


def with_request_key(prompts: DataFrame, template: str, model: str = K.DEFAULT_MODEL, temperature: float | None = None, json_mode: bool = True) -> DataFrame:
    return prompts.withColumn("request_key", request_key("prompt", template, model, temperature, json_mode))


def best_results(results: DataFrame, key: str = "request_key") -> DataFrame:
    """One row per request: an answer where there is one, else an error."""
    rank = F.struct((F.col("status") != "ok").alias("failed"), *[F.col(c) for c in results.columns if c != key])
    best = results.groupBy(key).agg(F.min(rank).alias("b"))
    return best.select(*[F.col(key) if c == key else F.col(f"b.{c}").alias(c) for c in results.columns])


def _calls(items, call, concurrency: int, retries: int, wait_seconds: float):
    """(value, error) per item: ``concurrency`` calls at a time, each tried again ``retries`` times."""
    import time
    from concurrent.futures import ThreadPoolExecutor

    def one(item):
        for k in range(retries + 1):
            try:
                return call(item), None
            except Exception as e:  # noqa: BLE001 - one failed request must not fail the batch
                error = f"{type(e).__name__}: {e}"
                if k < retries:
                    time.sleep(wait_seconds * 2**k)
        return None, error

    if concurrency == 1:
        return [one(i) for i in items]
    with ThreadPoolExecutor(concurrency) as pool:
        return list(pool.map(one, items))


def batch_infer(
    prompts: DataFrame,
    client_factory: Callable[[], ModelClient],
    *,
    template: str,
    model: str = K.DEFAULT_MODEL,
    temperature: float | None = None,
    json_mode: bool = True,
    cache: DataFrame | None = None,
    partitions: int | None = None,
    out_path: str | None = None,
    slice_requests: int = 10_000,
    concurrency: int = 4,
    retries: int = 2,
    wait_seconds: float = 0.5,
) -> DataFrame:
    """Ask an injected model client once for each distinct new prompt.

    ``prompts(prompt_hash, prompt)``. The key of a request covers the template,
    model, temperature and mode besides the prompt, so results of other
    settings are never taken for it. Answers already held, in ``cache``
    (``RESULT_SCHEMA`` rows) or in the store at ``out_path``, are not asked for
    again; failures are, on the next run. ``partitions`` sets the number of
    tasks (and of buckets of a new store). By default a new store has the shuffle
    width of buckets and a slice is dealt to as many tasks as there are cores, or
    to one for each 1,000 requests, up to that width; each keeps ``concurrency`` calls in flight and tries a failed one ``retries``
    times more. The client must then be safe to share by threads.

    Returns one row per distinct prompt of ``prompts``: its answer, cached or
    new, or its error. With ``out_path``, which is what callers should use, the
    requests are evaluated and written once; then ranges of about
    ``slice_requests`` requests are asked and committed one after the other, so
    that a run which breaks off loses at most the answers of one slice.
    """
    asked = with_request_key(prompts.select("prompt_hash", "prompt"), template, model, temperature, json_mode)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for pdf in batches:
            got = _calls(pdf["prompt"], lambda p: client.complete(p, model=model, temperature=temperature, json_mode=json_mode), concurrency, retries, wait_seconds)
            yield pd.DataFrame({
                "request_key": pdf["request_key"], "prompt_hash": pdf["prompt_hash"], "template": template, "model": model,
                "raw": [v for v, _ in got], "status": ["ok" if e is None else "error" for _, e in got], "error": [e for _, e in got],
            })

    held = None if cache is None else cache.select(*_names(RESULT_SCHEMA)).filter(F.col("status") == "ok")
    if out_path is not None:
        return _infer_in_slices(asked, run, held, out_path, partitions, slice_requests)
    todo = new_prompts(asked, held, "request_key").dropDuplicates(["request_key"])
    new = (todo.repartition(int(partitions)) if partitions else todo).mapInPandas(run, RESULT_SCHEMA)
    if held is not None:
        new = new.unionByName(held)
    return best_results(new.join(asked.select("request_key").distinct(), "request_key", "left_semi"))


def _infer_in_slices(asked: DataFrame, run, held: DataFrame | None, out_path: str, partitions: int | None, slice_requests: int) -> DataFrame:
    spark = asked.sparkSession
    store = AnswerStore(spark, out_path, RESULT_SCHEMA, partitions)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = store.buckets or partitions or width
    path = scratch_path(spark, "requests")
    # one evaluation of the prompts: laid out by the store's buckets, so that a slice reads and writes its own buckets only
    marked = asked.dropDuplicates(["request_key"])
    if buckets != width:
        marked = marked.repartition(buckets, "request_key")
    marked = marked.join(store.answered().distinct().withColumn("__held", F.lit(True)), "request_key", "left")
    if held is not None:
        marked = marked.join(held.select("request_key").distinct().withColumn("__cached", F.lit(True)), "request_key", "left").withColumn("__held", F.coalesce("__held", "__cached"))
    marked = marked.select(
        key_bucket(buckets).alias("bucket"), key_part(buckets).alias("part"), "request_key", "prompt_hash", F.col("__held").isNotNull().alias("held"), F.when(F.col("__held").isNull(), F.col("prompt")).alias("prompt"))
    marked.sortWithinPartitions("bucket", "part").write.partitionBy("bucket").parquet(path)
    requests = spark.read.schema(marked.schema).parquet(path)
    todo = requests.filter(~F.col("held"))
    counts = [(r["part"], r["n"]) for r in todo.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()]  # about 65,536 numbers at most, or one a bucket
    name, plan, each = uuid.uuid4().hex[:12], slices(counts, slice_requests), max(1, PARTS // buckets)
    for k, (first, last, n) in enumerate(plan):
        low, high = first // each, last // each
        part = todo.filter(F.col("bucket").between(low, high) & F.col("part").between(first, last))
        # as many tasks as can be busy, each in as few buckets as can be: a task writes a file for each of its buckets
        tasks = partitions or min(width, max(spark.sparkContext.defaultParallelism, -(-n // TASK_REQUESTS)))
        share = max(1, tasks // (high - low + 1))
        dealt = (F.col("bucket") - low) * share + F.pmod(F.xxhash64("request_key"), F.lit(share))
        part = part.repartitionById(tasks, dealt.cast("int")).select("request_key", "prompt_hash", "prompt")
        seen = Observation()
        new = part.mapInPandas(run, RESULT_SCHEMA).observe(seen, F.count_if(F.col("status") == "ok").alias("ok"))
        store.append(new)
        store.note(name, k, len(plan), first, last, n, seen.get["ok"], n - seen.get["ok"])
    kept = store.rows() if held is None else store.rows().unionByName(held)
    return best_results(kept.join(requests.select("request_key"), "request_key", "left_semi"))


def infer_progress(spark, out_path: str) -> DataFrame:
    """The ledger of a store: one row for each finished slice of each run."""
    return AnswerStore(spark, out_path, RESULT_SCHEMA).ledger()


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def batch_transcribe(
    audio: DataFrame,
    client_factory: Callable[[], TranscribeClient],
    *,
    model: str = K.TRANSCRIBE_MODEL,
    language: str = K.TRANSCRIBE_LANGUAGE,
    out_path: str | None = None,
    concurrency: int = 4,
    retries: int = 2,
    wait_seconds: float = 0.5,
) -> DataFrame:
    """U4: audio rows (path, content) -> ``TRANSCRIPT_SCHEMA`` rows.

    The key is the recording's content with the model and language, so equal
    recordings are sent once, under the least of their paths. Which ones are
    new is found on (path, key) rows; only the bytes of those are then joined,
    by path. With ``out_path`` results are kept in a bucketed store
    (``ledger.AnswerStore``): recordings with a transcript there are not sent
    again, failed ones are, and what is returned is read back, so that a second
    action does not call the service. One row for each recording.
    """
    spark = audio.sparkSession
    asked = audio.select("path", F.sha2(F.concat(F.lit(f"{model}|{language}|").cast("binary"), "content"), 256).alias("request_key"))
    store = None if out_path is None else AnswerStore(spark, out_path, TRANSCRIPT_SCHEMA)
    if store is not None:
        # the recordings are hashed once
        path = scratch_path(spark, "recordings")
        asked.write.parquet(path)
        asked = spark.read.schema(asked.schema).parquet(path)
    todo = new_prompts(asked, store and store.answered(), "request_key").groupBy("request_key").agg(F.min("path").alias("path"))
    todo = todo.join(audio.select("path", "content"), "path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()

        def call(item):
            path, content = item
            ext = path.rsplit(".", 1)[-1] if "." in path else "wav"
            return client.transcribe(bytes(content), model=model, language=language, file_ext=ext)

        for pdf in batches:
            got = _calls(list(zip(pdf["path"], pdf["content"])), call, concurrency, retries, wait_seconds)
            yield pd.DataFrame({
                "request_key": pdf["request_key"], "path": pdf["path"], "model": model,
                "text": [v for v, _ in got], "status": ["ok" if e is None else "error" for _, e in got], "error": [e for _, e in got],
            })

    new = todo.mapInPandas(run, TRANSCRIPT_SCHEMA)
    if store is not None:
        store.append(new)
        new = best_results(store.rows())
    return asked.select("path", "request_key").join(new.drop("path"), "request_key").select(*_names(TRANSCRIPT_SCHEMA))


def transcribe_recordings(
    audio: DataFrame,
    client_factory: Callable[[], TranscribeClient],
    *,
    max_bytes: int = MAX_PART_BYTES,
    **settings,
) -> DataFrame:
    """U4 for recordings of any length: (path, content) -> (path, n_parts, seconds, text, status, error).

    Recordings over ``max_bytes`` are cut at sample borders (``audio_parts``);
    each part is a request of ``batch_transcribe`` (which takes ``settings``),
    so a failed part alone is asked again. The texts of a recording are joined
    in its order by one space, empty ones left out. A recording with a failed
    part has no text, status ``error`` and the first failure. One too long
    that cannot be cut is not sent. Paths must be unique.
    """
    parts = audio_parts(audio, max_bytes)
    # "#7.wav": the kind of file stays the end of the name
    ext = F.when(F.col("path").contains("."), F.regexp_extract("path", r"\.([^./]*)$", 1)).otherwise(F.lit("wav"))
    parts = parts.withColumn("part_path", F.when(F.col("n_parts") == 1, F.col("path")).otherwise(F.concat("path", F.lit("#"), "part", F.lit("."), ext)))
    sent = parts.filter(F.col("problem").isNull() & F.col("content").isNotNull()).select(F.col("part_path").alias("path"), "content")
    got = batch_transcribe(sent, client_factory, **settings).select(F.col("path").alias("part_path"), "text", "status", "error")
    one = parts.drop("content").join(got, "part_path", "left")
    bad = F.when(F.coalesce(F.col("status"), F.lit("")) != "ok", F.struct("part", F.coalesce("problem", "error", F.lit("no content")).alias("error")))
    # at most 2 GB / max_bytes parts a recording
    d = one.groupBy("path").agg(
        F.max("n_parts").alias("n_parts"), F.array_sort(F.collect_list(F.struct("part", "seconds", "text"))).alias("all"), F.min(bad).alias("bad"))
    text = F.array_join(F.filter(F.transform("all", lambda p: p["text"]), lambda t: t != ""), " ")
    # added up in the recording's order: doubles do not add up alike in any other
    seconds = F.aggregate("all", F.lit(0.0), lambda total, p: total + p["seconds"])
    return d.select("path", "n_parts", seconds.alias("seconds"), F.when(F.col("bad").isNull(), text).alias("text"),
                    F.when(F.col("bad").isNull(), "ok").otherwise("error").alias("status"), F.col("bad.error").alias("error"))


class EchoClient:
    """Deterministic offline stand-in for a hosted model (tests, benchmarks).

    Returns a JSON object whose ``dialogues`` list holds the double-quoted
    spans of the prompt's ``Text:`` section, speaker ``Unknown``.
    """

    def complete(self, prompt: str, *, model: str, temperature: float | None, json_mode: bool) -> str:
        import json
        import re

        body = prompt.split("Text: ", 1)[-1]
        spans = re.findall(r'"([^"\n]+)"', body)
        return json.dumps({"dialogues": [{"speaker": "Unknown", "line": s} for s in spans]})


class EchoCoach:
    """Deterministic offline stand-in for the evaluation model: the score follows from the prompt's length."""

    def complete(self, prompt: str, *, model: str, temperature: float | None, json_mode: bool) -> str:
        import json

        n = len(prompt)
        return json.dumps({
            "accuracy_score": n % 101 if n % 3 else n % 101 + 0.5, "pronunciation_issues": [f"w{n % 7}"] if n % 2 else [],
            "fluency_feedback": f"{n} characters", "grammar_note": "Check tense" if n % 4 == 0 else None, "encouragement": "Keep going!"})


class EchoPartner:
    """Deterministic offline stand-in for the chat model: a digest of all that it was sent."""

    def complete(self, prompt: str, *, model: str, temperature: float | None, json_mode: bool) -> str:
        import hashlib

        return "reply " + hashlib.sha256(prompt.encode()).hexdigest()[:16]


class EchoTranscriber:
    """Deterministic offline stand-in for a speech service: the recording's bytes are its text."""

    def transcribe(self, audio: bytes, *, model: str, language: str, file_ext: str) -> str:
        return audio.decode("utf-8")


class EchoWave:
    """Deterministic offline stand-in for speech recognition: the whole sample frames in hexadecimal."""

    def transcribe(self, audio: bytes, *, model: str, language: str, file_ext: str) -> str:
        import io
        import wave

        with wave.open(io.BytesIO(audio)) as f:
            size = f.getnchannels() * f.getsampwidth()
            data = f.readframes(f.getnframes())
        return data[: len(data) // size * size].hex()
