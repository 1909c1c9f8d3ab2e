"""Every deterministic registered query against its DuckDB SQL twin on the
smallest scale factor (the driver repeats this at sf0.01)."""

import datetime as dt
import decimal
import math

import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_contract(spark):
    q, s = queries(), oracle_sql()
    assert set(s) <= set(q)
    df = entry(spark)
    assert df.columns == ["document", "bigram", "n", "tf", "idf", "tf_idf"]
    assert df.count() > 0


def test_sql_needs_no_file_of_the_spark_installation(tmp_path, monkeypatch):
    import pyspark

    from framewise.plans.catalog import QUERIES
    from framewise.plans.oracle import oracle_sql as own
    monkeypatch.setattr(pyspark, "__file__", str(tmp_path / "__init__.py"))
    assert set(own()) == set(QUERIES)


def test_one_failing_text_costs_one_query(monkeypatch):
    from framewise.plans import oracle
    whole = set(oracle.oracle_sql())
    monkeypatch.setattr(oracle, "_kde", lambda method: 1 / 0)
    with pytest.warns(UserWarning):
        left = set(oracle.oracle_sql())
    assert whole - left == {"kde_scott", "kde_silverman"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, sf_small, name):
    df = queries()[name](spark, sf_small)
    res = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())
