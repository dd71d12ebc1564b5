"""Every registered query against its DuckDB oracle on the smallest tables (the driver runs the same
comparison at sf0.01; ``tools/oracle_check.py`` runs it by hand)."""

import pytest

import __spark_entry__ as entry
from lakeops.plans.registry import all_queries
from lakeops.session import release_scratch
from tests.conftest import SF_SMALL
from tools.oracle_check import SPARK_TO_DUCK, digest, duck_connect

QUERIES = {n: q for n, q in entry.queries().items() if n in all_queries()}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n in all_queries()}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["businessdate", "total_ids", "processed_records", "no_data", "errors"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    release_scratch(spark)
    rel = duck.execute(ORACLES[name])
    d_cols = [c[0] for c in rel.description]
    d_types = {c[0]: str(c[1]) for c in rel.description}
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    for f in df.schema.fields:
        s_type = f.dataType.simpleString()
        if s_type in SPARK_TO_DUCK:
            assert SPARK_TO_DUCK[s_type] == d_types[f.name], f.name
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows)[0] == digest(d_cols, d_rows)[0]
