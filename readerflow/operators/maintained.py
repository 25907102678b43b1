"""Dialogues and their counts kept up to date under reloads.

Two keyed tables (``sources.tables``) by book: the dialogues, and one row of facts
a book (its load, dialogues, dialogues by difficulty, speakers). A reload replaces
the rows of the books that it brings a text for in both; counts are taken from
those books' new dialogues alone, and only the buckets that they fall in are read
or written. So the tables equal a full recomputation from the latest loads after
any sequence of reloads, at the cost of what was reloaded.

A load without a text changes nothing, nor does one that is not newer than the
load that is held: a reload may be delivered twice. The dialogues are switched
first, then the facts; if a run breaks off between the two, the next reload finds
the facts a version behind and takes them anew from the dialogues. The one that
broke off is then to be delivered again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..sources.books import drop_superseded, latest_loads
from ..sources.tables import KeyedTable
from .dialogues import difficulty_value, speaker_value


def book_facts(books: DataFrame, dialogues: DataFrame) -> DataFrame:
    """(book_id, load_seq, n_dialogues, n_by_difficulty, speakers) of every book of ``books(book_id, load_seq)``."""
    by = dialogues.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("n_dialogues"),
        F.array(*[F.struct(F.lit(d).alias("difficulty"), F.count_if(difficulty_value() == d).alias("n")) for d in K.DIFFICULTIES]).alias("n_by_difficulty"),
        F.sort_array(F.collect_set(speaker_value())).alias("speakers"))
    none = F.array(*[F.struct(F.lit(d).alias("difficulty"), F.lit(0).cast("long").alias("n")) for d in K.DIFFICULTIES])
    return books.select("book_id", "load_seq").join(by, "book_id", "left").select(
        "book_id", "load_seq", F.coalesce("n_dialogues", F.lit(0)).cast("long").alias("n_dialogues"), F.coalesce("n_by_difficulty", none).alias("n_by_difficulty"),
        F.coalesce("speakers", F.array().cast("array<string>")).alias("speakers"))


class MaintainedDialogues:
    """The tables under ``root``; ``buckets`` as they were made with."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        self.spark, self.buckets = spark, buckets
        self.dialogues, self.facts = KeyedTable(spark, f"{root}/dialogues"), KeyedTable(spark, f"{root}/facts")

    def reload(self, loads: DataFrame, dialogues: DataFrame) -> None:
        """Take in ``loads(book_id, load_seq, raw_text)`` and the ``dialogues`` extracted from them (book_id, load_seq, dlg_ord, speaker, difficulty, ...)."""
        self.repair()
        books = latest_loads(loads).select("book_id", F.col("load_seq").cast("long").alias("load_seq"))
        if self.facts.manifest() is not None:
            held = self.facts.read_keys(books, "book_id").select("book_id", F.col("load_seq").alias("__held"))
            books = books.join(held, "book_id", "left").filter(F.coalesce(F.col("load_seq") > F.col("__held"), F.lit(True))).drop("__held")
        rows = drop_superseded(dialogues.withColumn("load_seq", F.col("load_seq").cast("long")), books)
        self.dialogues.replace(rows, "book_id", self.buckets, gone=books)
        self._facts(books, rows)

    def _facts(self, books: DataFrame, rows: DataFrame) -> None:
        self.facts.replace(book_facts(books, rows), "book_id", self.buckets, gone=books)

    def repair(self) -> None:
        """After a run that broke off between the two switches: facts of the books of all dialogues, and those held of books without any."""
        d, f = self.dialogues.manifest(), self.facts.manifest()
        if d is None or (f is not None and f["version"] >= d["version"]):
            return
        rows = self.dialogues.read()
        books = rows.groupBy("book_id").agg(F.max("load_seq").alias("load_seq"))
        if f is not None:
            books = books.unionByName(self.facts.read().select("book_id", "load_seq").join(books.select("book_id"), "book_id", "left_anti"))
        self._facts(books, rows)

    def totals(self) -> DataFrame:
        """(metric, n): the number of books, of dialogues and of distinct speakers over all books, from the facts."""
        f = self.facts.read()
        parts = (("books", f, F.count(F.lit(1))), ("dialogues", f, F.coalesce(F.sum("n_dialogues"), F.lit(0))),
                 ("speakers", f.select(F.explode("speakers").alias("s")).distinct(), F.count(F.lit(1))))
        out = [rows.agg(n.alias("n")).select(F.lit(name).alias("metric"), F.col("n").cast("long").alias("n")) for name, rows, n in parts]
        return out[0].unionByName(out[1]).unionByName(out[2])
