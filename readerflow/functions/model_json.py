"""Model-response JSON functions (X2-X5), all built-in Catalyst expressions.

The response unwrap follows the original: a top-level list is the answer; an
object yields its first list-valued entry in document order (a VARIANT
object sorts its keys, a ``map<string,variant>`` keeps them in order); an
object without any list gives an empty list; anything else is malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.barrier import materialize

STATUS_OK, STATUS_EMPTY, STATUS_MALFORMED, STATUS_BAD_SCORE = "ok", "empty", "malformed", "bad_score"

DIALOGUE_FIELDS = ["speaker", "line", "context", "difficulty", "modern_equivalent"]

# The score is read as it was sent and judged by ``score_number``.
FEEDBACK_SCHEMA = (
    "accuracy_score string, pronunciation_issues array<string>, fluency_feedback string, "
    "grammar_note string, encouragement string"
)
SETUP_SCHEMA = (
    "scenario string, user_role string, ai_roles array<string>, opening_line string, "
    "vocabulary_tips array<string>"
)


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def variant_kind(v: Column) -> Column:
    """'ARRAY', 'OBJECT', a scalar type name, or null when unparsable."""
    return F.split(F.schema_of_variant(v), "<", 2).getItem(0)


def unwrap_dialogues(raw) -> Column:
    """struct<status string, items array<variant>>."""
    r = _c(raw)
    v = F.try_parse_json(r)
    kind = variant_kind(v)
    entries = F.map_entries(F.from_json(r, "map<string,variant>"))
    # a repeated key keeps its first place and its last value
    values = F.transform(entries, lambda e: F.element_at(F.filter(entries, lambda x: x["key"] == e["key"]), -1)["value"])
    first_list = F.try_element_at(F.filter(values, lambda v: F.schema_of_variant(v).startswith("ARRAY")), F.lit(1))
    items = (
        F.when(kind == "ARRAY", v.cast("array<variant>"))
        .when(kind == "OBJECT", F.coalesce(first_list.cast("array<variant>"), F.array().cast("array<variant>")))
    )
    status = (
        F.when(kind == "ARRAY", F.lit(STATUS_OK))
        .when((kind == "OBJECT") & first_list.isNotNull(), F.lit(STATUS_OK))
        .when(kind == "OBJECT", F.lit(STATUS_EMPTY))
        .otherwise(F.lit(STATUS_MALFORMED))
    )
    return F.struct(status.alias("status"), items.alias("items"))


def dialogue_fields(item: Column) -> list[Column]:
    """Typed D5 fields of one list element (null when not an object)."""
    obj = variant_kind(item) == "OBJECT"
    out = [
        F.when(obj, F.try_variant_get(item, f"$.{f}", "string")).alias(f) for f in DIALOGUE_FIELDS
    ]
    out.append(F.when(obj, F.try_variant_get(item, "$.key_expressions", "array<string>")).alias("key_expressions"))
    return out


def reject_reason(item: Column) -> Column:
    kind = variant_kind(item)
    return F.when(kind != "OBJECT", F.concat(F.lit("not an object: "), F.coalesce(kind, F.lit("NULL"))))


def _fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(f.split()) for f in schema.split(", ")]


def parsed(df: DataFrame, schema: str, raw: str = "raw", out: str = "parsed") -> DataFrame:
    """Add ``status`` and ``out`` (a struct of ``schema``, null when the
    answer is no JSON object). The answer is parsed once, into a variant column
    from which both are read; a field of another type is null."""
    d = materialize(df, __v=F.try_parse_json(F.col(raw)))
    ok = F.coalesce(variant_kind(F.col("__v")) == "OBJECT", F.lit(False))
    fields = [F.try_variant_get("__v", f"$.{name}", kind).alias(name) for name, kind in _fields(schema)]
    return d.withColumn("status", F.when(ok, F.lit(STATUS_OK)).otherwise(F.lit(STATUS_MALFORMED))).withColumn(out, F.when(ok, F.struct(*fields))).drop("__v")


def score_number(text) -> Column:
    """The score as a number: 87.5 and "90" are numbers, "n/a" is none."""
    return _c(text).try_cast("double")


def parse_feedback(df: DataFrame, raw: str = "raw") -> DataFrame:
    """``df`` plus status, accuracy_score (double, null if missing) and the
    other feedback fields; a score that is given but is no number makes the
    status ``bad_score``."""
    d = parsed(df, FEEDBACK_SCHEMA, raw, "__fb")
    text, score = F.col("__fb.accuracy_score"), score_number("__fb.accuracy_score")
    bad = (F.col("status") == STATUS_OK) & text.isNotNull() & score.isNull()
    return d.select(
        *df.columns, F.when(bad, F.lit(STATUS_BAD_SCORE)).otherwise(F.col("status")).alias("status"), score.alias("accuracy_score"),
        *[F.col(f"__fb.{name}").alias(name) for name, _ in _fields(FEEDBACK_SCHEMA)[1:]])
