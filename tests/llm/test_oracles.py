"""Queries with SQL against it, and what the entry registers."""

import re

import __spark_entry__ as E
import compare as C
import pytest
from almanac.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_the_queries_are_registered():
    names = set(E.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert "pipeline" in names and set(Q.ORACLE_SQL) <= names


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    df = Q.QUERIES[name](spark, SF)
    res = C.duck(SF).execute(Q.ORACLE_SQL[name])
    cols, types = [d[0] for d in res.description], [str(d[1]) for d in res.description]
    assert df.columns == cols and C.same_types(cols, [f.dataType.simpleString() for f in df.schema.fields], cols, types)
    assert C.rows_of(cols, [tuple(r) for r in df.collect()]) == C.rows_of(cols, res.fetchall())
