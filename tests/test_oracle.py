"""Every SQL-checkable analysis against its DuckDB twin (sf0.001 here;
``tools/oracle_check.py`` runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import rows
from tools.type_check import MAP

from conftest import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    stypes = {f.name: MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    assert stypes == dict(zip(rel.columns, [str(t) for t in rel.types]))
    got = sdf.toPandas()
    want = rel.df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


def test_every_query_has_docs_and_runs_contract():
    qs = E.queries()
    assert set(ORACLE) <= set(qs)
    for name, fn in qs.items():
        assert fn.__doc__, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["s_name", "total_qty"]
    assert df.count() > 0
