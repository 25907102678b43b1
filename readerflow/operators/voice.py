"""Speech-synthesis request manifests.

Synthesis itself is an external service; the engine produces one request row
per line (text, voice, locale, gender, encoding, rate, pitch) for a writer to
hand to a synthesiser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K

_DEFAULT = {key: (name, gender) for key, name, gender in K.VOICES}[K.DEFAULT_VOICE]


def voices_table(spark: SparkSession) -> DataFrame:
    """The voice dimension (7 fixed rows)."""
    return spark.createDataFrame(K.VOICES, "voice_key string, voice_name string, gender string")


def voice_locale(name: Column | str) -> Column:
    """V1: US -> en-US, GB -> en-GB, anything else -> en-AU."""
    n = F.col(name) if isinstance(name, str) else name
    return F.when(n.contains("US"), "en-US").when(n.contains("GB"), "en-GB").otherwise("en-AU")


def rate_in_range(rate: Column | str) -> Column:
    """Whether a rate is one that the speed control offers; the rate itself is passed on as it is."""
    r = F.col(rate) if isinstance(rate, str) else rate
    return r.cast("double").between(K.MIN_RATE, K.MAX_RATE)


def slow_rate(rate: Column | str) -> Column:
    """V2: ``max(0.5, rate - 0.3)``."""
    r = F.col(rate) if isinstance(rate, str) else rate
    return F.greatest(F.lit(K.MIN_RATE), r.cast("double") - F.lit(K.SLOW_RATE_STEP))


def lookup_voices(df: DataFrame, key_col: str = "voice_key", voices: DataFrame | None = None) -> DataFrame:
    """Voice name and gender per row; unknown key -> the default voice.

    The built-in voice table has 7 rows, so it is broadcast; a caller-supplied
    table of unknown size is left to AQE's runtime size check.
    """
    spark = df.sparkSession
    builtin = voices is None
    v = voices_table(spark) if builtin else voices
    v = v.select(F.col("voice_key").alias("__vk"), F.col("voice_name").alias("__vn"), F.col("gender").alias("__vg"))
    j = df.join(F.broadcast(v) if builtin else v, df[key_col] == v["__vk"], "left")
    return j.withColumn("voice_name", F.coalesce("__vn", F.lit(_DEFAULT[0]))).withColumn(
        "gender", F.coalesce("__vg", F.lit(_DEFAULT[1]))
    ).drop("__vk", "__vn", "__vg")


def voice_manifest(lines: DataFrame, text_col: str = "line", key_col: str = "voice_key", rate_col: str = "rate") -> DataFrame:
    """V3: J2 + V1 + V2 -> one synthesis request per line."""
    v = lookup_voices(lines, key_col)
    return v.select(
        *[c for c in lines.columns if c not in (text_col, key_col, rate_col)],
        F.col(text_col).alias("text"),
        "voice_name",
        voice_locale("voice_name").alias("locale"),
        "gender",
        F.lit(K.AUDIO_ENCODING).alias("encoding"),
        F.col(rate_col).cast("double").alias("rate"),
        rate_in_range(rate_col).alias("rate_in_range"),
        slow_rate(rate_col).alias("slow_rate"),
        F.lit(K.DEFAULT_PITCH).alias("pitch"),
    )
