"""Facts of WAV recordings and their cutting at sample borders.

A WAV file is ``RIFF``, a length and ``WAVE``, then chunks: four letters, a
little-endian length and as many bytes, padded to an even number. The chunks
are walked by a fold inside the row; a recording never leaves its row and no
Python worker reads it. All columns besides ``path`` and ``content`` are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.barrier import materialize

# Formats of which any whole number of sample frames is a recording: PCM, IEEE float, and the extensible form of both.
SAMPLED_FORMATS = (1, 3, 65534)
# The largest upload a speech service is assumed to take, in bytes; a parameter of ``audio_parts``.
MAX_PART_BYTES = 24 * 1024 * 1024

HEAD_BYTES = 1 << 16
HEAD_CHUNKS = 64

FACTS = "struct<format:int,channels:int,sample_rate:bigint,bits:int,block_align:int,data_offset:bigint,data_bytes:bigint,frames:bigint,seconds:double,status:string,fmt:binary>"


def _bytes(content: Column, at: Column, n: Column | int) -> Column:
    """``n`` bytes from the 0-based place ``at``."""
    return F.substring(content, (at + 1).cast("int"), F.lit(n) if isinstance(n, int) else n.cast("int"))


def _unsigned(content: Column, at: Column, n: int) -> Column:
    """The little-endian number in ``n`` bytes."""
    h = F.hex(_bytes(content, at, n))
    return F.conv(F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(n))]), 16, 10).cast("bigint")


def _little_endian(value: Column, n: int = 4) -> Column:
    h = F.lpad(F.hex(value.cast("bigint")), 2 * n, "0")
    return F.unhex(F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(n))]))


def _walk(content: Column, size: Column, steps: Column) -> Column:
    """Chunks from byte 12 on, up to the data chunk or the end.

    (at, fmt: payload of the first fmt chunk, data: place of the data, n: its stated length)
    """
    nothing = F.lit(None).cast("binary")
    start = F.struct(F.lit(12).cast("bigint").alias("at"), nothing.alias("fmt"), F.lit(None).cast("bigint").alias("data"), F.lit(None).cast("bigint").alias("n"))

    def step(s: Column, _: Column) -> Column:
        name, n, body = _bytes(content, s["at"], 4), _unsigned(content, s["at"] + 4, 4), s["at"] + 8
        fmt = F.when(s["fmt"].isNull() & (name == F.lit(bytearray(b"fmt "))), _bytes(content, body, F.least(n, size))).otherwise(s["fmt"])
        found = name == F.lit(bytearray(b"data"))
        return F.when(s["data"].isNotNull() | (body > size), s).otherwise(F.struct(
            F.when(found, s["at"]).otherwise(body + n + n % 2).alias("at"), fmt.alias("fmt"),
            F.when(found, body).alias("data"), F.when(found, n).alias("n")))

    return F.aggregate(F.sequence(F.lit(1), steps.cast("int")), start, step)


def _facts(content: Column) -> Column:
    size = F.octet_length(content).cast("bigint")

    def with_head(v: Column) -> Column:
        head, size = v["head"], v["size"]
        # nearly every recording has its data chunk near its start; any other is walked whole, at most a chunk in 8 bytes
        near = _walk(head, F.octet_length(head).cast("bigint"), F.lit(HEAD_CHUNKS))
        return F.struct(head.alias("head"), size.alias("size"), near.alias("near"))

    def with_chunks(v: Column) -> Column:
        whole = _walk(content, v["size"], F.greatest(F.lit(1), F.floor(v["size"] / 8)))
        open_end = v["near"]["data"].isNull() & ((v["size"] > F.octet_length(v["head"])) | (v["near"]["at"] + 8 <= v["size"]))
        return F.struct(v["head"].alias("head"), v["size"].alias("size"), F.when(open_end, whole).otherwise(v["near"]).alias("c"))

    def read(v: Column) -> Column:
        fmt, data, size = v["c"]["fmt"], v["c"]["data"], v["size"]
        full = F.octet_length(fmt) >= 16

        def number(at: int, n: int) -> Column:
            return F.when(full, _unsigned(fmt, F.lit(at), n))

        form, channels, rate, byte_rate, align, bits = number(0, 2), number(2, 2), number(4, 4), number(8, 4), number(12, 2), number(14, 2)
        there = F.least(v["c"]["n"], size - data)
        riff = (F.substring(v["head"], 1, 4) == F.lit(bytearray(b"RIFF"))) & (F.substring(v["head"], 9, 4) == F.lit(bytearray(b"WAVE")))
        status = (
            F.when(size == 0, "empty").when(~riff, "not a WAV file").when(fmt.isNull(), "no fmt chunk")
            .when(data.isNull(), "no data chunk").when(~full | (channels == 0) | (rate == 0) | (align == 0), "invalid fmt chunk")
            .when(there < v["c"]["n"], "cut off").otherwise("ok"))
        known = status.isin("ok", "cut off")
        frames = F.floor(there / align)
        sampled = form.isin(*SAMPLED_FORMATS)
        seconds = F.when(sampled, frames / rate).when(byte_rate > 0, there / byte_rate)
        return F.struct(*[F.when(known, c).alias(n) for n, c in (
            ("format", form), ("channels", channels), ("sample_rate", rate), ("bits", bits), ("block_align", align), ("data_offset", data),
            ("data_bytes", there), ("frames", F.when(sampled, frames)), ("seconds", seconds))], status.alias("status"), F.when(known, fmt).alias("fmt"))

    v = F.array(F.struct(F.coalesce(F.substring(content, 1, HEAD_BYTES), F.lit(bytearray())).alias("head"), F.coalesce(size, F.lit(0)).alias("size")))
    for f in (with_head, with_chunks, read):
        v = F.transform(v, f)
    return F.element_at(v, 1).cast(FACTS)


def audio_facts(audio: DataFrame) -> DataFrame:
    """Rows with ``content`` -> the other columns, ``length`` and the facts of the recording.

    format, channels, sample_rate, bits, block_align, data_offset (0-based),
    data_bytes (what is there), frames, seconds, status. ``status`` is ``ok``,
    ``cut off`` (the file ends before its stated data does; the facts are those
    of what is there), or why nothing is known: ``empty`` (or null), ``not a
    WAV file``, ``no fmt chunk`` (none before the data), ``no data chunk``,
    ``invalid fmt chunk`` (under 16 bytes, or a zero in it). Formats without
    sample frames have no ``frames``; their seconds follow from the byte rate.
    """
    keep = [c for c in audio.columns if c not in ("content", "length")]
    d = audio.select(*keep, F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("length"), _facts(F.col("content")).alias("__facts"))
    return materialize(d, __facts=F.col("__facts")).select(*keep, "length", "__facts.*").drop("fmt")


def audio_parts(audio: DataFrame, max_bytes: int = MAX_PART_BYTES) -> DataFrame:
    """U4: (path, content) -> (path, part, n_parts, cut, seconds, content, problem), each a file of at most ``max_bytes``.

    A recording that fits is one part, byte for byte. A longer one in a sampled
    format is cut between two sample frames; every part gets the recording's
    fmt chunk, and the parts' data, one after the other, is its data (bytes
    behind the last whole frame go with the last part); chunks besides the two are
    left out, so that one part may be enough. A longer recording that
    is no such file is one part, whole, with ``problem`` saying why. A frame that does
    not fit with its header raises no limit: a part holds one frame at least.
    """
    d = audio.select("path", "content", F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("size"), _facts(F.col("content")).alias("f"))
    d = materialize(d, f=F.col("f"), size=F.col("size"))
    fmt = F.concat(F.col("f.fmt"), F.when(F.octet_length("f.fmt") % 2 == 1, F.lit(bytearray(1))).otherwise(F.lit(bytearray())))
    header = F.octet_length(fmt) + 28
    step = F.greatest(F.lit(1), F.floor((F.lit(max_bytes) - header - F.col("f.block_align")) / F.col("f.block_align"))) * F.col("f.block_align")
    cut = (F.col("size") > max_bytes) & F.col("f.frames").isNotNull()
    whole_steps = F.floor(F.col("f.frames") * F.col("f.block_align") / step)
    more = (F.col("f.frames") * F.col("f.block_align") > whole_steps * step).cast("bigint")
    n_parts = F.when(cut, F.greatest(F.lit(1), whole_steps + more)).otherwise(F.lit(1)).cast("int")
    # only numbers are generated; the bytes of a part are cut when its row is made
    e = materialize(d.withColumns({"n_parts": n_parts, "cut": F.coalesce(cut, F.lit(False)), "step": step, "fmt": fmt}),
                    n_parts=F.col("n_parts"), cut=F.col("cut"), step=F.col("step"), fmt=F.col("fmt"))
    e = e.select("*", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part"))
    begin = F.col("part") * F.col("step")
    last = F.col("part") == F.col("n_parts") - 1
    n = F.when(last, F.col("f.data_bytes") - begin).otherwise(F.col("step"))
    pad = F.when(n % 2 == 1, F.lit(bytearray(1))).otherwise(F.lit(bytearray()))
    file = F.concat(
        F.lit(bytearray(b"RIFF")), _little_endian(F.octet_length("fmt") + 20 + n + n % 2), F.lit(bytearray(b"WAVEfmt ")), _little_endian(F.octet_length("f.fmt")), F.col("fmt"),
        F.lit(bytearray(b"data")), _little_endian(n), _bytes(F.col("content"), F.col("f.data_offset") + begin, n), pad)
    seconds = F.when(F.col("cut"), F.floor(n / F.col("f.block_align")) / F.col("f.sample_rate")).otherwise(F.col("f.seconds"))
    problem = F.when(~F.col("cut") & (F.col("size") > max_bytes), F.when(F.col("f.status") == "ok", "format without sample frames").otherwise(F.col("f.status")))
    return e.select("path", "part", "n_parts", "cut", seconds.alias("seconds"), F.when(F.col("cut"), file).otherwise(F.col("content")).alias("content"), problem.alias("problem"))
