"""Every query with an oracle must equal its DuckDB SQL on the same tables."""

import duckdb
import pytest

import __spark_entry__ as E
from helpers import canon, duck_rows, spark_rows
from unitcast.sources.tpch import TABLES

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con(smoke_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date_block_num", "shop_id", "item_id", "item_cnt_month"]
    assert df.count() > 0


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, smoke_dir, con, name):
    df = E.queries()[name](spark, smoke_dir)
    rel = con.sql(E.oracle_sql()[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == otypes
    ocols, orows = duck_rows(con, E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(ocols)
    srows = spark_rows(df)
    assert len(srows) == len(orows)
    cols = sorted(ocols)
    assert canon(srows, cols) == canon(orows, cols)
