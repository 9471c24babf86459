import duckdb
import pytest

import __spark_entry__ as driver
from termloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows):
    return sorted(tuple(repr(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    if name in catalog.oracle_sql():
        r = duck.execute(catalog.oracle_sql()[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == columns
        assert got == plain([[row[names.index(c)] for c in columns] for row in r.fetchall()])


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())
