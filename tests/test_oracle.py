"""Every registered query against its SQL twin, on whole tables."""

import pytest

from check import rows_of
from harmlens.plans import REGISTRY


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(name, spark, sf_dir, duck):
    q = REGISTRY[name]
    df = q.run(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    if q.sql is None:
        assert mine
        return
    cursor = duck.execute(q.sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, mine) == rows_of(columns, cursor.fetchall())
