"""Every query that has SQL gives the rows that SQL gives, on the smallest tables."""

import decimal
import glob
import os

import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    return int(v) if isinstance(v, decimal.Decimal) else repr(v) if isinstance(v, float) else v


def test_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in SQL if n in QUERIES))
def test_against_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    r = duck.execute(SQL[name])
    names = [c[0] for c in r.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = sorted((tuple(plain(x[c]) for c in order) for x in df.collect()), key=repr)
    theirs = sorted((tuple(plain(dict(zip(names, x, strict=True))[c]) for c in order) for x in r.fetchall()), key=repr)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQL and n[0] in "dm"))
def test_others_run(spark, data, name):
    assert QUERIES[name](spark, data).count() >= 1


def test_bootstrap_has_an_interval(spark, data):
    assert QUERIES["a24_replicates"](spark, data).count() == 2000
    r = QUERIES["a24_interval"](spark, data).collect()
    assert len(r) == 1 and 0 < r[0].low < r[0].high < 1


def test_sweep_has_all_thresholds(spark, data):
    from patraloom.operators import dedup

    rows = QUERIES["d6_threshold_sweep"](spark, data).collect()
    assert [r.threshold for r in rows] == list(dedup.SWEEP)
    assert all(a.pairs <= b.pairs for a, b in zip(rows, rows[1:]))


def test_profile_keeps_null_sources(spark, data, tmp_path):
    spark.read.parquet(f"{data}/documents.parquet").selectExpr("* except (source)", "if(n_chars % 2 = 0, source, null) as source").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["a23_length_profile"](spark, str(tmp_path)).where("source is null").count() == 1


def test_survivors_keep_null_sources(spark, data, tmp_path):
    spark.read.parquet(f"{data}/release.parquet").selectExpr("* except (source_config)", "cast(null as string) as source_config").write.parquet(f"{tmp_path}/release.parquet")
    assert QUERIES["d8_survivors"](spark, str(tmp_path)).where("source_config is null").count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
