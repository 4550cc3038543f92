"""Every registered query of the catalogue against its SQL, on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from baitline.plans import catalogue

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def bag(rows):
    return Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, duck, name):
    frame = catalogue.queries()[name](spark, SMALL)
    cursor = duck.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert bag(frame.select(*columns).collect()) == bag(cursor.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 40
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
