"""Facts of WAV files and their cutting, against Python's own reader."""

import io
import struct
import wave

import pytest

from readerflow.operators import inference as I
from readerflow.sources import audio as A

SCHEMA = "path string, content binary"


def _wav(channels, width, rate, data):
    b = io.BytesIO()
    with wave.open(b, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(width)
        f.setframerate(rate)
        f.writeframes(data)
    return b.getvalue()


def _chunks(*chunks, fmt=struct.pack("<HHIIHH", 1, 1, 8000, 16000, 2, 16)):
    body = b"".join(n + struct.pack("<I", len(d)) + d + b"\0" * (len(d) % 2) for n, d in (*([(b"fmt ", fmt)] if fmt else []), *chunks))
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def _facts(spark, **files):
    return {r["path"]: r for r in A.audio_facts(spark.createDataFrame(list(files.items()), SCHEMA)).collect()}


def test_facts_equal_the_reader_of_the_standard_library(spark):
    made = {f"{c}-{w}-{r}": _wav(c, w, r, bytes(range(251)) * 12 * c * w) for c in (1, 2, 6) for w in (1, 2, 3) for r in (8000, 44100, 192000)}
    for name, got in _facts(spark, **made).items():
        with wave.open(io.BytesIO(made[name])) as f:
            want = (f.getnchannels(), f.getframerate(), 8 * f.getsampwidth(), f.getnframes(), f.getnframes() / f.getframerate(), "ok", len(made[name]))
        assert (got["channels"], got["sample_rate"], got["bits"], got["frames"], got["seconds"], got["status"], got["length"]) == want


def test_broken_headers_have_a_reason(spark):
    data = (b"data", b"abcd")
    got = _facts(
        spark, empty=b"", null=None, short=b"RIFF", text=b"hello there, this is text", rifx=b"RIFX" + _chunks(data)[4:],
        no_fmt=_chunks(data, fmt=None), no_data=_chunks((b"LIST", b"data")), late_fmt=_chunks(data, (b"fmt ", b"\0" * 16), fmt=None),
        small_fmt=_chunks(data, fmt=b"\1\0\1\0"), zero=_chunks(data, fmt=b"\0" * 16), cut=_chunks((b"data", b"abcdef"))[:-3], only_head=_chunks((b"data", b"")),
        ends_in_header=_chunks(data)[:-6], ends_in_fmt=_chunks(data)[:30])
    assert {k: r["status"] for k, r in got.items()} == {
        "empty": "empty", "null": "empty", "short": "not a WAV file", "text": "not a WAV file", "rifx": "not a WAV file", "no_fmt": "no fmt chunk",
        "no_data": "no data chunk", "late_fmt": "no fmt chunk", "small_fmt": "invalid fmt chunk", "zero": "invalid fmt chunk", "cut": "cut off", "only_head": "ok",
        "ends_in_header": "no data chunk", "ends_in_fmt": "no data chunk"}
    assert (got["cut"]["data_bytes"], got["cut"]["frames"]) == (3, 1)
    assert (got["only_head"]["frames"], got["only_head"]["seconds"]) == (0, 0.0)
    assert got["no_fmt"]["channels"] is None


def test_data_behind_many_or_large_chunks_is_found(spark):
    data = (b"data", b"abcdefgh")
    got = _facts(
        spark, many=_chunks(*[(b"JUNK", b"x" * (k % 3)) for k in range(5 * A.HEAD_CHUNKS)], data), large=_chunks((b"LIST", b"data" * A.HEAD_BYTES), data),
        late=_chunks((b"LIST", b"y" * (A.HEAD_BYTES - 33)), (b"odd ", b"z"), data), fmt_over_head=_chunks((b"LIST", b"y" * (A.HEAD_BYTES - 40)), (b"fmt ", struct.pack("<HHIIHH", 1, 2, 9000, 1, 4, 16)), data, fmt=None))
    assert {k: (r["status"], r["data_bytes"]) for k, r in got.items()} == dict.fromkeys(got, ("ok", 8))
    assert got["fmt_over_head"]["sample_rate"] == 9000


def test_formats_without_frames(spark):
    mp3 = struct.pack("<HHIIHH", 85, 2, 44100, 16000, 1, 0)
    got = _facts(spark, mp3=_chunks((b"data", b"x" * 8000), fmt=mp3))["mp3"]
    assert (got["format"], got["frames"], got["seconds"]) == (85, None, 0.5)


@pytest.mark.parametrize("max_bytes", [1, 60, 100, 1001, 5000, 10**6])
def test_parts_join_to_the_whole(spark, max_bytes):
    made = {f"{c}-{w}-{n}": _wav(c, w, 8000, bytes(k % 256 for k in range(n * c * w))) for c in (1, 2) for w in (1, 3) for n in (0, 1, 7, 700)}
    made["list"] = _chunks((b"LIST", b"odd"), (b"data", bytes(range(200))))
    made["torn"] = _chunks((b"data", bytes(range(199))))
    made["cut"] = made["list"][:-50]
    made["extensible"] = _chunks((b"data", bytes(range(256)) * 9), fmt=struct.pack("<HHIIHH", 65534, 2, 8000, 48000, 6, 24) + struct.pack("<H", 22) + b"g" * 22)
    by = {}
    for r in A.audio_parts(spark.createDataFrame(list(made.items()), SCHEMA), max_bytes).collect():
        by.setdefault(r["path"], []).append(r)
    assert by.keys() == made.keys()
    facts = _facts(spark, **made)
    for name, parts in by.items():
        parts.sort(key=lambda r: r["part"])
        assert [r["part"] for r in parts] == list(range(len(parts))) and {r["n_parts"] for r in parts} == {len(parts)}
        whole, f = made[name], facts[name]
        if len(whole) <= max_bytes:
            assert [(bytes(r["content"]), r["cut"]) for r in parts] == [(whole, False)]
            continue
        inside = _facts(spark, **{str(r["part"]): bytes(r["content"]) for r in parts})
        assert {r["status"] for r in inside.values()} == {"ok"}
        joined = b"".join(bytes(r["content"])[inside[str(r["part"])]["data_offset"]:][: inside[str(r["part"])]["data_bytes"]] for r in parts)
        assert joined == whole[f["data_offset"]:][: f["data_bytes"]]
        for r in parts:
            i = inside[str(r["part"])]
            assert (i["channels"], i["sample_rate"], i["bits"], i["format"]) == (f["channels"], f["sample_rate"], f["bits"], f["format"])
            assert len(r["content"]) <= max_bytes or i["frames"] <= 1
            assert r["part"] == len(parts) - 1 or i["data_bytes"] % f["block_align"] == 0
        assert sum(i["frames"] for i in inside.values()) == f["frames"]


def test_long_files_that_cannot_be_cut_are_named(spark):
    made = {"text": b"no wav file at all", "mp3": _chunks((b"data", b"x" * 50), fmt=struct.pack("<HHIIHH", 85, 2, 44100, 16000, 1, 0)), "null": None}
    got = {r["path"]: (r["part"], r["n_parts"], r["content"] and bytes(r["content"]), r["problem"]) for r in A.audio_parts(spark.createDataFrame(list(made.items()), SCHEMA), 10).collect()}
    assert got == {"text": (0, 1, made["text"], "not a WAV file"), "mp3": (0, 1, made["mp3"], "format without sample frames"), "null": (0, 1, None, None)}


class Fussy:
    def transcribe(self, audio, *, model, language, file_ext):
        if b"!" in audio:
            raise ValueError("cannot hear")
        assert file_ext == "wav"
        return I.EchoWave().transcribe(audio, model=model, language=language, file_ext=file_ext)


def test_long_recordings_are_heard_in_parts(spark, tmp_path):
    rows = [("a/1.wav", _wav(1, 2, 8000, b"ab" * 60)), ("a/2.wav", _wav(1, 2, 8000, b"cd" * 5)), ("a.b/3.wav", _wav(1, 2, 8000, b"ef" * 20 + b"!!" + b"ef" * 60)),
            ("4.wav", b"x" * 200), ("5.wav", None), ("6.wav", _wav(1, 2, 8000, b""))]
    got = I.transcribe_recordings(spark.createDataFrame(rows, SCHEMA), Fussy, max_bytes=100, out_path=str(tmp_path / "t"), retries=0).collect()
    by = {r["path"]: r for r in got}
    assert len(got) == len(rows)
    assert (by["a/1.wav"]["n_parts"], by["a/1.wav"]["status"], by["a/1.wav"]["text"].replace(" ", "")) == (3, "ok", "6162" * 60)
    assert by["a/1.wav"]["seconds"] == pytest.approx(60 / 8000)
    assert (by["a/2.wav"]["n_parts"], by["a/2.wav"]["text"]) == (1, "6364" * 5)
    assert (by["a.b/3.wav"]["status"], by["a.b/3.wav"]["text"]) == ("error", None) and "cannot hear" in by["a.b/3.wav"]["error"]
    assert (by["4.wav"]["status"], by["4.wav"]["error"]) == ("error", "not a WAV file")
    assert (by["5.wav"]["status"], by["5.wav"]["error"]) == ("error", "no content")
    assert (by["6.wav"]["status"], by["6.wav"]["text"]) == ("ok", "")


def test_no_recordings(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert A.audio_facts(none).count() == 0 and A.audio_parts(none, 10).count() == 0
