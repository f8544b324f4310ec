"""Every query with SQL against DuckDB on the driver's tables."""

import math

import duckdb
import pytest

from spotgrain.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(rows):
    norm = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return sorted(repr([norm(v) for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.sql(SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    assert canon(df.select(*cols).collect()) == canon(want.project(", ".join(f'"{c}"' for c in cols)).fetchall())
