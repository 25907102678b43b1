"""ST1: learner progress over a feedback stream.

Counts and sums add up, so the stream keeps no state: each micro-batch is
aggregated per (learner, UTC day) and written as partial sums to its own
``batch_id`` partition (dynamic overwrite), so a replayed batch rewrites the same
files. Progress is the sum over the batches. No watermark is needed and no row
is ever late: a row of any day counts in the batch that it arrives with.
Compaction adds the batches so far into one versioned state; per-learner totals
(A4, A5) are sums over the day rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.practice import RECORDED_MODE, display_round, score_value
from ..sources.media import exists

PARTIAL_SCHEMA = "learner_id bigint, day string, n_practice bigint, score_sum double"


def partial_progress(feedback: DataFrame) -> DataFrame:
    """(learner_id, day, n_practice, score_sum) of the recorded rows of a frame."""
    rec = feedback.filter(F.col("mode") == RECORDED_MODE).select(
        F.col("learner_id").cast("bigint").alias("learner_id"), F.to_date("ts").cast("string").alias("day"), score_value().cast("double").alias("score"))
    return rec.groupBy("learner_id", "day").agg(F.count(F.lit(1)).alias("n_practice"), F.sum("score").alias("score_sum"))


def partial_writer(out_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            partial_progress(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(out_path)
        )

    return write


def start_progress(feedback: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """``feedback`` has a TIMESTAMP_NTZ ``ts`` (UTC wall clock), so days do not depend on the session's zone."""
    w = feedback.select("learner_id", "ts", "mode", "accuracy_score").writeStream.foreachBatch(partial_writer(out_path)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def _log(spark: SparkSession, out_path: str) -> DataFrame:
    schema = f"{PARTIAL_SCHEMA}, batch_id bigint"
    return spark.read.schema(schema).parquet(out_path) if exists(spark, out_path) else spark.createDataFrame([], schema)


def _state(spark: SparkSession, state_path: str | None) -> tuple[DataFrame | None, int]:
    """The newest compacted state and the last batch in it."""
    if state_path is None or not exists(spark, state_path):
        return None, -1
    states = spark.read.schema(f"{PARTIAL_SCHEMA}, upto bigint").parquet(state_path)
    upto = states.agg(F.max("upto")).first()[0]
    return (None, -1) if upto is None else (states.filter(F.col("upto") == upto), upto)


def read_progress(spark: SparkSession, out_path: str, state_path: str | None = None) -> DataFrame:
    """Current (learner_id, day) rows: the compacted state plus all newer batches."""
    state, upto = _state(spark, state_path)
    cols = ["learner_id", "day", "n_practice", "score_sum"]
    parts = _log(spark, out_path).filter(F.col("batch_id") > upto).select(*cols)
    if state is not None:
        parts = parts.unionByName(state.select(*cols))
    rows = parts.groupBy("learner_id", "day").agg(F.sum("n_practice").alias("n_practice"), F.sum("score_sum").alias("score_sum"))
    return rows.withColumn("avg_accuracy", F.col("score_sum") / F.col("n_practice"))


def learner_totals(day_rows: DataFrame) -> DataFrame:
    """A4 + A5 from the per-day state (matches the batch learner_progress)."""
    t = day_rows.groupBy("learner_id").agg(
        F.sum("n_practice").alias("n_practice"),
        F.sum("score_sum").alias("__sum"),
    )
    avg = F.col("__sum") / F.col("n_practice")
    return t.select("learner_id", "n_practice", avg.alias("avg_accuracy"), display_round(avg).alias("avg_display"))


def compact_progress(spark: SparkSession, out_path: str, state_path: str) -> DataFrame:
    """Add the old state and all newer batches into a new version of the state
    (partition ``upto``, the last batch in it) and return the current rows.

    Older versions and the ``batch_id`` partitions up to ``upto`` are then
    redundant and may expire; a version is read only once it is complete.
    """
    _, upto = _state(spark, state_path)
    last = _log(spark, out_path).agg(F.max("batch_id")).first()[0]
    if last is not None and last > upto:
        rows = read_progress(spark, out_path, state_path).drop("avg_accuracy").withColumn("upto", F.lit(last).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upto").parquet(state_path)
    return read_progress(spark, out_path, state_path)
