"""Plan-shape tests: Python only where a model client is injected; fixed
dimensions broadcast; filters reach the Parquet scan; chapters need no shuffle."""

import pytest

from readerflow.operators import dialogues as D
from readerflow.plans.registry import load_all
from readerflow.sources.fixtures import fx_dialogues

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
# queries whose answers come from an injected client write and read back its table, so their plans have no Python either
PYTHON_ALLOWED: set[str] = set()
STREAMING = {"stream_progress", "stream_ingest"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(load_all()) - STREAMING))
def test_no_python_outside_model_calls(spark, name):
    p = plan(load_all()[name].build(spark, SF))
    has_python = any(n in p for n in PYTHON_NODES)
    assert has_python == (name in PYTHON_ALLOWED), name


@pytest.mark.parametrize("name", ["catalog_lookup", "voice_lookup"])
def test_fixed_dimensions_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(load_all()[name].build(spark, SF))


@pytest.mark.parametrize("name", ["split_chapters", "dedup_chapters", "default_chapters", "extraction_prompt"])
def test_chapter_pipeline_has_no_keyed_shuffle(spark, name):
    p = plan(load_all()[name].build(spark, SF))
    assert "hashpartitioning" not in p and "rangepartitioning" not in p


def test_dialogue_filter_pushed_to_scan(spark, tmp_path):
    path = str(tmp_path / "dialogues")
    fx_dialogues(spark, SF).write.parquet(path)
    df = spark.read.parquet(path).filter(D.dialogue_filter(["Beginner"], ["user"], "the"))
    text = df._jdf.queryExecution().executedPlan().toString()
    pushed = text.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "difficulty" in pushed and "speaker" in pushed, pushed


def test_plans_stay_small(spark):
    # staged text columns must not be re-inlined into huge expressions
    for name in ["infer_cache", "dedup_chapters", "extraction_prompt", "stream_ingest"]:
        if name in STREAMING:
            continue
        assert len(plan(load_all()[name].build(spark, SF))) < 200_000, name


BODY_COLUMNS = ("raw_text", "text", "body")


@pytest.mark.parametrize("name", ["select_chapters", "combine_chapters", "prompt_window", "book_scan_fallback", "replace_on_reload"])
def test_no_body_under_a_keyed_exchange(spark, name):
    """Selections and winners are found on short rows; texts are not sorted, grouped or exploded before a shuffle."""
    df = load_all()[name].build(spark, "/root/testdata/sf0.01")
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    lines = final.splitlines()
    for i, line in enumerate(lines):
        assert not ("Aggregate" in line and any(f"{c}#" in line.split("output=")[0] for c in BODY_COLUMNS)), line
        if "Exchange hashpartitioning" in line:
            below = " ".join(lines[i + 1:i + 3])
            assert "array_join" not in below and "regexp_extract_all" not in below, line


def test_chat_log_shuffles_block_sums_not_messages_twice(spark):
    df = load_all()["chat_history"].build(spark, SF)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "partial_sum" in final and final.count("SortAggregate") == 0
