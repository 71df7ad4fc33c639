"""Every registered query of the library against its SQL in another engine."""

import duckdb
import pytest

from genoframe.plans.file_queries import FILE_ORACLES, FILE_QUERIES
from genoframe.plans.oracles import ORACLES as PLAIN_ORACLES
from genoframe.plans.queries import QUERIES as PLAIN_QUERIES

QUERIES, ORACLES = PLAIN_QUERIES | FILE_QUERIES, PLAIN_ORACLES | FILE_ORACLES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


@pytest.fixture(scope="module")
def other(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(rows):
    def value(x):
        if isinstance(x, float):
            return None if x != x else round(x, 6)
        return int(x) if hasattr(x, "dtype") else x

    return sorted((tuple(map(value, r)) for r in rows), key=repr)


def test_all_have_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, other, name):
    got = QUERIES[name](spark, sf_dir)
    wanted = other.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    columns = sorted(got.columns)
    assert plain(got.select(*columns).collect()) == plain(wanted.project(", ".join(f'"{c}"' for c in columns)).fetchall())
