import hashlib
import math
import os
import re

import duckdb
import pytest

from groundcheck.plans import checks, landed, registry  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f[:-8]} as select * from read_parquet('{SF}/{f}')")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(registry.ORACLES[name])
    assert sorted(relation.columns) == columns
    want = [dict(zip(relation.columns, row)) for row in relation.fetchall()]
    key = lambda row: tuple(plain(row[c]) for c in columns)
    assert sorted(key(r.asDict()) for r in df.collect()) == sorted(map(key, want))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_other_queries_run(spark, name):
    assert registry.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_texts_with_backslashes_are_kept(spark, tmp_path):
    texts = [r"costs \$5 or $6 million", "C:\\every\\path", r"\\$1 and \$$2", "every bank pays $3", "a\\nb 4 % \n\\$7\n$8", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    bare = re.compile(r"(?<!\\)\$")
    want = {i: t or "" for i, t in enumerate(texts)}
    escaped = {r.doc_id: (r.signs, r.escaped) for r in registry.QUERIES["escaped_currency"](spark, str(tmp_path)).collect()}
    assert escaped == {i: (t.count("$"), hashlib.sha256(bare.sub(r"\\$", t).encode()).hexdigest()) for i, t in want.items()}
    flags = {r.doc_id: (r.financial, r.universal, r.dollars) for r in registry.QUERIES["prose_flags"](spark, str(tmp_path)).collect()}
    assert {i: f[2] for i, f in flags.items()} == {i: len(bare.findall(t)) for i, t in want.items()}
    assert {i for i, f in flags.items() if f[0]} == {0, 3, 4} | {i for i, t in want.items() if re.search(r"[$€£]\s?\d", t)}
    assert {i for i, f in flags.items() if f[1]} == {1, 3}
