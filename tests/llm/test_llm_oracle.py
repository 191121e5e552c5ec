"""The queries of this package that SQL can express, against their SQL."""

from pathlib import Path

import duckdb
import pytest

from hirelens.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    agree(spark, name, SF_DIR)


def test_long_conversations_and_odd_roles(spark, tmp_path):
    rows = [(1, t, "ann" if t % 2 else "bob  lee", f"t{t}") for t in range(600)] + [(1, 3, "once", "only here")]
    rows += [(2, t, "ann", "x") for t in range(256)] + [(3, t, "cy", "x") for t in range(257)]
    rows += [(4, 0, "a b", "one"), (4, 1, "a \t b", "two"), (4, None, " ", None), (4, 2, None, "nobody"), (None, 0, "dee", "no id"),
             (5, 0, "system", "alone"), (6, 0, "system", ""), (6, 1, "eve", "same"), (6, 1, "eve", "same")]
    made = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "conversations.parquet")
    agree(spark, "op6_chat_perspectives", str(tmp_path))


def agree(spark, name, sf_dir):
    duck = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        duck.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, sf_dir)
    result = duck.execute(queries.ORACLE_SQL[name])
    named = [d[0] for d in result.description]
    assert sorted(named) == sorted(df.columns)
    expected = [tuple(r[named.index(c)] for c in df.columns) for r in result.fetchall()]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key) != []
