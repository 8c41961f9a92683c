"""Every registered query with oracle SQL equals DuckDB on sf0.001; every
query without one still runs."""
import pytest

import __spark_entry__ as entry

from .conftest import SF001
from .helpers import canon

Q = entry.queries()
SQL = entry.oracle_sql()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(Q)


@pytest.mark.parametrize("name", sorted(Q))
def test_query_matches_oracle(spark, duck, name):
    df = Q[name](spark, SF001)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(cols) > 0
        return
    rel = duck.sql(SQL[name])
    dtypes = dict(zip(rel.columns, (str(t) for t in rel.types)))
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    assert stypes == dtypes
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    assert canon(rows, cols) == canon(res.fetchall(), dcols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["transaction_id", "card_id", "ts", "amount"]
    assert df.count() >= 0
