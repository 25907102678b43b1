"""Registered queries: oracles at sf0.01, contract columns, pipeline against brute-force stages."""

import pytest
from brute_path import brute
from oracle import compare, duck

import corpus_pipeline
from readerflow.llm import op7_packing as op7
from readerflow.llm import op8_decontaminate as op8
from readerflow.llm.common import table
from readerflow.llm.queries import ORACLES, QUERIES
from readerflow.plans.registry import Query

SF, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
CONTRACT = {
    "op1_quality_fm": "doc_id held_out score predicted", "op2_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3_line_dedup": "doc_id n_lines n_dropped kept_sha256", "op4_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_html_extract": "page_id url text n_chars", "op6_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_toxicity": "doc_id held_out score predicted", "op10_near_dedup": "doc_id n_shingles component_id kept",
    "op11_importance": "doc_id n_features weight score rank", "op13_url_filters": "page_id host path rule verdict",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    r = compare(spark, duck(SF), Query(name, QUERIES[name], ORACLES[name]), SF)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract(spark, name):
    out = QUERIES[name](spark, TINY)
    assert set(CONTRACT[name].split()) <= set(out.columns)
    source = "pages" if name in ("op4_warc", "op5_html_extract", "op13_url_filters") else "documents"
    assert out.count() == table(spark, TINY, source).count()


def test_registered():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())
    assert len(QUERIES) == 14


def test_near_dedup_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in QUERIES["op10_near_dedup"](spark, SF).collect()}
    assert got == brute.near_components(rows)


def test_suffix_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, TINY, "documents").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_suffix_dedup"](spark, TINY).collect()}
    assert got == dict(zip((i for i, _ in rows), brute.repeats([t for _, t in rows], 400)))


def test_matches_whole_table(spark):
    items = [(r["item_id"], op8.normal(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    exact = {(r["doc_id"], i) for r in table(spark, SF, "documents").collect() for i, x in items if x in op8.normal(r["text"])}
    got = QUERIES["op8_decontaminate"](spark, SF).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0} == exact and len(exact) > 5


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against plain versions."""
    docs = table(spark, SF, "documents")
    a = corpus_pipeline.quality_classifier(spark, docs, SF).cache()
    assert a.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    left = {r["doc_id"] for r in a.collect()}
    good, bad = [i for i, q in labels.items() if q == 1], [i for i, q in labels.items() if q == 0]
    assert sum(i in left for i in good) >= 0.98 * len(good) and sum(i in left for i in bad) <= 0.15 * len(bad)

    b = corpus_pipeline.line_dedup(spark, a, SF).cache()
    want = brute.line_dedup([(r["doc_id"], r["text"]) for r in a.collect()])
    assert {r["doc_id"]: r["text"] for r in b.collect()} == {i: x[2] for i, x in want.items()}
    assert b.columns == docs.columns and b.where("n_chars <> char_length(text)").count() == 0

    c = corpus_pipeline.near_dedup(spark, b, SF).cache()
    comps = brute.near_components([(r["doc_id"], r["text"]) for r in b.collect()])
    assert _rows(c) == _rows(b.where(b.doc_id.isin([i for i, x in comps.items() if x[2]])))

    d = corpus_pipeline.decontamination(spark, c, SF).cache()
    items = [op8.normal(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {r["doc_id"] for r in c.collect() if not any(x in op8.normal(r["text"]) for x in items)}
    got = {r["doc_id"] for r in d.collect()}
    assert got <= clean and len(clean - got) <= 3 and d.columns == docs.columns

    e = corpus_pipeline.packing(spark, d, SF)
    n = {}
    for r in e.collect():
        n[r["doc_id"]] = n.get(r["doc_id"], 0) + r["length"]
    assert n == {r["doc_id"]: len(brute.words(r["text"])) for r in d.collect()}


def test_run_equals_stages(spark):
    docs = table(spark, TINY, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TINY).cache()
    assert _rows(corpus_pipeline.run(spark, TINY)) == _rows(docs)
    assert op7.CAPACITY == 2048


def test_pipeline_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some text here", None, "s", 3), (4, "x " * 90_000, "en", None, 180_000)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, bin_id string")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            some = stage(spark, some, TINY)
        assert some.columns == ["doc_id", "piece", "start", "length", "bin_id", "bin_offset"]
        some.collect()
