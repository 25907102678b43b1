"""ST1/ST2: stream results equal the batch queries, also under shuffled arrival."""

import random
import shutil

import pytest

from pyspark.sql import functions as F

from readerflow.operators import chapters as CH
from readerflow.sources.fixtures import feedback_from_events, fx_books, table
from readerflow.streaming import ingest as ST2
from readerflow.streaming import progress as ST1
from readerflow.plans.q_streaming import finish
from readerflow.plans.registry import load_all

SF = "/root/testdata/sf0.001"


def _late_files(spark, events, src, n=5):
    """The events in n files whose arrival order is shuffled across days."""
    pdf = events.toPandas()
    idx = list(range(len(pdf)))
    random.Random(7).shuffle(idx)
    for i in range(n):
        spark.createDataFrame(pdf.iloc[idx[i::n]], events.schema).coalesce(1).write.mode("append").parquet(src)


def _expected(events):
    fb = feedback_from_events(events).filter(F.col("mode") == "shadowing")
    rows = fb.groupBy("learner_id", F.to_date("ts").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("accuracy_score", F.lit(0))).alias("s"))
    return {(r.learner_id, r.day): (r.n, r.s) for r in rows.collect()}


def _rows(df):
    return {(r.learner_id, r.day): (r.n_practice, r.score_sum) for r in df.collect()}


def test_progress_keeps_late_rows_and_survives_compaction(spark, tmp_path):
    events = table(spark, SF, "events")
    src, out, ck, state = (str(tmp_path / n) for n in ("events", "out", "ck", "state"))
    _late_files(spark, events.filter("event_id % 2 = 0"), src)

    def run():
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
        finish(ST1.start_progress(feedback_from_events(stream), out, ck))

    run()
    half = _expected(events.filter("event_id % 2 = 0"))
    assert _rows(ST1.read_progress(spark, out)) == half
    assert _rows(ST1.compact_progress(spark, out, state)) == half
    shutil.rmtree(out)  # the compacted batches may expire
    assert _rows(ST1.compact_progress(spark, out, state)) == half
    _late_files(spark, events.filter("event_id % 2 = 1"), src)
    run()
    whole = _expected(events)
    assert _rows(ST1.read_progress(spark, out, state)) == whole
    assert _rows(ST1.compact_progress(spark, out, state)) == whole
    assert _rows(ST1.compact_progress(spark, out, state)) == whole
    totals = ST1.learner_totals(ST1.read_progress(spark, out, state)).agg(F.sum("n_practice")).first()[0]
    assert totals == sum(n for n, _ in whole.values())


@pytest.mark.parametrize("name,key", [("stream_progress", "events"), ("stream_ingest", "documents")])
def test_table_folder_of_many_files(spark, tmp_path, name, key):
    table(spark, SF, key).repartition(4).write.parquet(str(tmp_path / f"{key}.parquet"))
    build = load_all()[name].build
    as_rows = lambda df: sorted(tuple(r) for r in df.collect())
    many, one = as_rows(build(spark, str(tmp_path))), as_rows(build(spark, SF))
    assert many == one and one


def test_reload_replaces_chapters(spark, tmp_path):
    root, out, ck = (str(tmp_path / n) for n in ("landed", "out", "ck"))
    books = lambda *rows: spark.createDataFrame(rows, "book_id bigint, raw_text string")

    def ingest():
        finish(ST2.start_ingest(spark, root, out, ck))
        return sorted((r.book_id, r.title, r.body) for r in ST2.read_chapters(spark, out).collect())

    ST2.land_books(books((1, "CHAPTER I\na\nCHAPTER II\nb"), (2, "CHAPTER I\nc")), root)
    assert len(ingest()) == 3
    ST2.land_books(books((1, "CHAPTER I\nnew")), root, load_seq=1)
    ST2.land_books(books((2, " \n")), root, load_seq=1)  # a failed load replaces nothing
    assert ingest() == [(1, "CHAPTER I", "new"), (2, "CHAPTER I", "c")]


@pytest.mark.parametrize("layout", ["parquet", "text"])
def test_ingest_stream_equals_batch(spark, tmp_path, layout):
    books = fx_books(spark, SF)
    root = str(tmp_path / "landed")
    if layout == "parquet":
        ST2.land_books(books, root, files=5)
    else:
        ST2.land_book_files(books, root)
    q = ST2.start_ingest(spark, root, str(tmp_path / "out"), str(tmp_path / "ck"), max_files_per_trigger=2, layout=layout)
    finish(q)
    got = sorted(tuple(r) for r in ST2.read_chapters(spark, str(tmp_path / "out")).collect())
    exp = sorted(tuple(r) for r in CH.chapters(CH.clean_books(books)).collect())
    assert got == exp


def test_progress_days_independent_of_session_zone(spark, tmp_path):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        events = table(spark, SF, "events")
        stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
        q = ST1.start_progress(feedback_from_events(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
        finish(q)
        got = {(r.learner_id, r.day): r.n_practice for r in ST1.read_progress(spark, str(tmp_path / "out")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    import pandas as pd

    pdf = events.toPandas()
    pdf = pdf[pdf.event_type != "view"]
    exp = pdf.groupby([pdf.user_id, pd.to_datetime(pdf.ts).dt.strftime("%Y-%m-%d")]).size().to_dict()
    assert got == {(int(k[0]), k[1]): int(v) for k, v in exp.items()}
