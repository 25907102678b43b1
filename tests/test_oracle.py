"""Every registered query vs its DuckDB oracle at sf0.01 (the driver's check)."""

import pytest

from oracle import compare, duck
from readerflow.plans.registry import load_all

SF = "/root/testdata/sf0.01"
REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n, q in REG.items() if q.sql))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, REG[name], SF)
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(n for n, q in REG.items() if not q.sql))
def test_rows_only(spark, name):
    assert REG[name].build(spark, SF).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["book_id", "chapter_ord", "title", "n_chars", "body_hash"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
