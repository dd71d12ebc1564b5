"""The registered queries of the numbered operators: all present, and equal to their SQL where there is one."""

import pytest

import __spark_entry__ as entry
from lakeops.llm.queries import ORACLES, QUERIES
from tools.oracle_check import SPARK_TO_DUCK, digest, duck_connect

SF = "/root/testdata/sf0.001"


def test_all_numbers_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    found = duck_connect(SF).execute(ORACLES[name])
    columns, types = [c[0] for c in found.description], {c[0]: str(c[1]) for c in found.description}
    assert sorted(df.columns) == sorted(columns)
    assert all(SPARK_TO_DUCK[f.dataType.simpleString()] == types[f.name] for f in df.schema.fields)
    assert digest(df.columns, rows)[0] == digest(columns, found.fetchall())[0]
