"""Queries that SQL can express, against another engine."""

import random

import duckdb
import pytest

from tributary.llm import decontaminate
from tributary.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = connection.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    result = QUERIES[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(columns)
    assert sorted(map(tuple, result.select(*columns).collect())) == sorted(cursor.fetchall())


def test_decontamination_rules_that_the_tables_do_not_meet(spark, tmp_path):
    """Short items, quoted parts, changed words, repeated rows, and rows without id or sharing one."""
    rng, long = random.Random(3), [f"i{k}" for k in range(40)]
    items = [(7, " ".join(long)), (8, "What is the capital of Peru?"), (9, "capital of"), (10, None), (None, "a b c"), (11, "")]
    docs = [(1, " ".join([*(f"a{k}" for k in range(15)), *long[14:27], *(f"b{k}" for k in range(15))])), (2, " ".join(long[14:25])),
            (3, "he asked what is the capital of peru again, the capital of"), (4, None), (4, "capital of"), (4, "clean"),
            (None, "the capital of a country"), (5, "of the capital"), (5, "of the capital"), (6, "")]
    for k in range(30):
        at = rng.randrange(20)
        words = [rng.choice(["x", "y", w, w, w, w, w]) for w in long[at:at + rng.randrange(8, 40)]]
        docs.append((100 + k, " ".join(["some words before", *words, "and some after it"])))
    frames = {"documents": spark.createDataFrame(docs, "doc_id long, text string"),
              "benchmark": spark.createDataFrame(items, "item_id long, text string")}
    connection = duckdb.connect()
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    cursor = connection.execute(ORACLE_SQL["op10_decontaminate"])
    columns = [d[0] for d in cursor.description]
    result = decontaminate.report(frames["documents"], frames["benchmark"]).select(*columns).collect()
    assert sorted(map(repr, map(tuple, result))) == sorted(map(repr, cursor.fetchall()))
    assert {r["agree"] == 1.0 for r in result if r["contaminated"]} == {True, False}
