"""Every registered query against its DuckDB twin on the driver's smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from taxaspark.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(row, order):
    # exact: every double must be bit-identical to DuckDB's (NaN compared as text)
    return tuple("nan" if isinstance(row[i], float) and math.isnan(row[i]) else row[i] for i in order)


def _key(t):
    return tuple((x is not None, str(type(x)), x) for x in t)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(REGISTRY)))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rel = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    dorder = [dcols.index(df.columns[i]) for i in order]
    a = sorted((_norm(tuple(r), order) for r in df.collect()), key=_key)
    b = sorted((_norm(r, dorder) for r in rel.fetchall()), key=_key)
    assert a == b


def test_every_query_has_oracle_or_is_model():
    missing = (set(queries()) & set(REGISTRY)) - set(oracle_sql())
    assert missing == {"fit_logit", "posterior_draws"}


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["acceptedNameAuthor", "specimenCount", "propContemporary", "logSpecimenCount",
                          "yearPublished", "Threatened"]
    assert df.count() > 0
