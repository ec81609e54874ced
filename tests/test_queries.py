"""Every core query against its SQL on the smallest tables; the ones without SQL must run and keep their schema."""

import math

import pytest

import tessera.plans.tasks  # noqa: F401
from tessera.plans.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def base(data):
    import glob
    import os

    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, base, name):
    df = QUERIES[name](spark, data)
    order = sorted(df.columns)
    rows = [[plain(r[c]) for c in order] for r in df.collect()]
    if name in SQL:
        got = base.execute(SQL[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == order
        at = [names.index(c) for c in order]
        assert sorted(rows) == sorted([plain(r[i]) for i in at] for r in got.fetchall())


def test_entry_stands_without_the_subpackage():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_trainable_blanks(spark, tmp_path):
    """A group for each character that may count as blank, alone, doubled, in a mixed run, and beside a letter; and the limits."""
    odd = [*range(1, 0x21), *range(0x7F, 0xAE), 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030), 0x205F, 0x2060, 0x2800, 0x3000, 0xFEFF, 0x1D7D8]
    rows = [(f"{i:x}", t) for i in odd for c in [chr(i)] for t in (c, c * 2, f"\xa0{c} ", f" {c}a{c}")]
    rows += [(None, "\xa0 "), (None, "a"), (None, None), ("", ""), ("all blank", "\u3000 \xa0"), ("lines", "\n\xa0\n")]
    rows += [("99 rows", "x" * 200)] * 99 + [("99 rows", "\xa0 ")] + [("100 rows", "x" * 100)] * 100 + [("9999 characters", "x" * 99)] * 101
    spark.createDataFrame(rows, "source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["val_trainable"](spark, str(tmp_path))
    got = duckdb.sql(SQL["val_trainable"].replace("from documents", f"from '{tmp_path}/documents.parquet/*.parquet'"))
    assert df.columns == got.columns
    assert sorted(map(tuple, df.collect()), key=str) == sorted(got.fetchall(), key=str)
