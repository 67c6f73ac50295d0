"""The driver contract."""

import __spark_entry__ as E
from almanac import catalog
from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["month", "year", "active_users", "sessions", "revenue"]


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.queries())


def test_every_query_matches_its_oracle_on_sf0001(spark):
    """Same columns in the same order, same types and the same values as the
    DuckDB oracle (the driver's gate runs this at sf0.01)."""
    import compare as C
    con = C.duck(SF001)
    sql = E.oracle_sql()
    bad = []
    for name, q in catalog.QUERIES.items():
        df = q(spark, SF001)
        rows = [tuple(r) for r in df.collect()]
        types = [f.dataType.simpleString() for f in df.schema.fields]
        res = con.execute(sql[name])
        dcols = [d[0] for d in res.description]
        dtypes = [str(d[1]) for d in res.description]
        drows = res.fetchall()
        if (df.columns != dcols or not C.same_types(df.columns, types, dcols, dtypes)
                or C.rows_of(df.columns, rows) != C.rows_of(dcols, drows)):
            bad.append(name)
    assert bad == []
