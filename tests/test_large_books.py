"""S3: chapters of books that are read by ranges equal those of whole texts."""

import random

import pytest

from readerflow import constants as K
from readerflow.operators import chapters as CH
from readerflow.sources import books as B
from readerflow.sources import large_books as LB

PIECES = ["CHAPTER I. One", "chapter 2", "  Chapter IV\t tab", "it was chapter called so", "CHAPTER", "CHAPTER  ", "\n", "\n\n\n", "IV and more", "a line of text", "wörds  and\ttabs", "\t", "mid CHAPTER X here", "CHAPTER I. One", "x" * 400]


def _book(rng, n):
    body = "".join(rng.choice(PIECES) + rng.choice(["\n", "\r\n", "\n\n", " "]) for _ in range(n))
    head = rng.choice(["", f"preamble CHAPTER 9\n{K.START_MARKERS[0]} T ***\r\n", f"{K.END_MARKERS[0]}\n{K.START_MARKERS[0]} T ***\n"])
    return head + body + rng.choice(["", f"\ntail {K.END_MARKERS[0]} T ***\nCHAPTER 99\nfooter", "no newline at the end"])


def _whole(spark, rows):
    clean = CH.clean_books(spark.createDataFrame(rows, "book_id long, raw_text string"))
    return sorted(tuple(r) for r in CH.chapters(clean).collect())


@pytest.mark.parametrize("size", [1, 3, 50])
def test_lines_equal_whole_texts(spark, size):
    rng = random.Random(size)
    rows = [(k, _book(rng, rng.choice([0, 1, 5, 40]))) for k in range(40)] + [(90, "no headings  at\n\n\n\nall "), (91, "CHAPTER\nCHAPTER V\nx"), (92, "a\nCHAPTER\n\nCHAPTER V\nx")]
    lines = [(i, n // size, n, x) for i, t in rows for n, x in enumerate(t.split("\n"))]
    got = LB.line_chapters(spark.createDataFrame(lines, LB.LINE_SCHEMA), block_size=7)
    rows = [r for r in rows if r[1].strip()]
    want = [r for r in _whole(spark, rows) if r[3] or r[2] != K.FULL_TEXT_TITLE]
    assert sorted(r for r in map(tuple, got.collect()) if r[3] or r[2] != K.FULL_TEXT_TITLE) == want


def test_ranges_of_files(spark, tmp_path):
    rng = random.Random(3)
    texts = {f"{k}{suffix}.txt": _book(rng, 1500) for k in (11, 12, 13) for suffix in ("-0", "")}
    texts |= {"11-0.txt": "", "12-0.txt": "small CHAPTER I\nbook", "14.txt": "other"}
    for name, t in texts.items():
        (tmp_path / name).write_bytes(t.encode())
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set(keys[0], "7000")
        spark.conf.set(keys[1], "100")
        lines = LB.book_lines(spark, str(tmp_path), min_bytes=5000)
        got = sorted(map(tuple, LB.line_chapters(lines).collect()))
        assert lines.select("book_id", "part").distinct().count() > 6
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    # 11 falls back to its second location, 12 has a small first file, 13 its first one, 14 is small
    assert got == _whole(spark, [(11, texts["11.txt"]), (13, texts["13-0.txt"])])
    assert {r["book_id"] for r in B.oversized_files(spark, str(tmp_path), 5000).collect()} >= {11, 13}
