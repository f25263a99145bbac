"""Every registered query against its SQL on another engine."""

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry  # noqa: E402
from tributary.plans.oracle import oracle_sql  # noqa: E402
from tributary.plans.queries import QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem".split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(normal(row[i]) for i in order)) for row in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(oracle_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    got, expected = rows_of(result.columns, result.collect()), rows_of(columns, cursor.fetchall())
    assert len(got) == len(expected) > 0
    assert got == expected


def test_entry(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test data")
    assert entry(spark).count() > 0


@pytest.mark.parametrize("change", ["path", "update"])
def test_the_sql_notices_a_wrong_field(spark, duck, sf_dir, monkeypatch, change):
    """The oracle takes no path or update column from the code it checks."""
    from tributary.functions import documents
    from tributary.operators import merge

    if change == "path":
        wrong = tuple(f._replace(path="$.shipment.shipment_id") if f.name == "carrier" else f for f in documents.FIELDS)
        monkeypatch.setattr(documents, "FIELDS", wrong)
        name = "silver_orders"
    else:
        monkeypatch.setattr(merge, "UPDATED_COLUMNS", tuple(c for c in merge.UPDATED_COLUMNS if c != "carrier"))
        name = "merge_update"
    result, cursor = QUERIES[name](spark, sf_dir), duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert rows_of(result.columns, result.collect()) != rows_of(columns, cursor.fetchall())


def test_facts_shuffle_their_lines_by_order_only(spark, sf_dir):
    """Customers and suppliers are joined before the lines, so no wide row is shuffled for them."""
    from tributary.sources import order_documents as source

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = source.order_facts(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "l_orderkey" in joins[0]


def test_accepted_rows_of_an_insert_are_stored_before_the_merge(spark, sf_dir, monkeypatch):
    from tributary.plans import queries

    read = []
    monkeypatch.setattr(queries, "merge_scd1", lambda target, source: read.append(source) or source)
    QUERIES["merge_insert"](spark, sf_dir)
    assert all("order_changes" in f or "batch_id=1" in f for f in read[0].inputFiles()) and read[0].inputFiles()


def test_counted_lines_are_stored_compressed_and_not_shuffled(spark, sf_dir):
    from tributary.plans import queries

    _, stage, facts = queries._lines_stage(spark, sf_dir)
    files = spark.read.text(stage)
    assert all(f.endswith(".snappy") for f in files.inputFiles())
    assert files.count() == facts.count() > 0


@pytest.fixture(scope="module")
def few_orders(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("few")
    tables = {
        "region": "SELECT 1 r_regionkey, 'ASIA' r_name",
        "nation": "SELECT 1 n_nationkey, 'INDIA' n_name, 1 n_regionkey",
        "customer": "SELECT 1L c_custkey, 'C' c_name, 1 c_nationkey, 'AUTO' c_mktsegment",
        "supplier": "SELECT 0L s_suppkey, 'S' s_name, 1 s_nationkey",
        "part": "SELECT 1L p_partkey, 'P' p_name, 'TIN' p_type, 3 p_size, 9.5D p_retailprice",
        "orders": "SELECT id o_orderkey, 1L o_custkey, 'O' o_orderstatus, 100.5D o_totalprice,"
                  " TIMESTAMP_NTZ'1996-01-02 00:00:00' o_orderdate FROM range(31, 91)",
        "lineitem": "SELECT id l_orderkey, 1L l_partkey, 0L l_suppkey, 1 l_linenumber, 2D l_quantity,"
                    " TIMESTAMP_NTZ'1996-01-12 00:00:00' l_shipdate FROM range(31, 91)",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_new_rows_of_a_merge_are_stored_before_it(spark, few_orders):
    """The merge itself looks for known keys once; the new rows it is given are not found again for each of its reads."""
    result = QUERIES["merge_duplicate_reference"](spark, few_orders)
    assert result._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 1
    # 40 orders of batch 1, 20 that only batch 2 has (o_orderkey % 3 = 2), and those of them that come twice.
    new = [key for key in range(31, 91) if key % 3 == 2]
    keys = [int(row.order_id[4:]) for row in result.collect()]
    assert sorted(keys) == sorted([*range(31, 91), *(key for key in new if key % 10 == 1)])
    assert result.where("known_twice_fails").count() == len(keys)


def test_tasks_that_make_order_rows_follow_the_orders(spark, few_orders, monkeypatch):
    """A file of facts per so many orders and a task per file, whatever the number of cores; settings are put back."""
    from tributary.plans import queries

    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
             "spark.sql.files.maxRecordsPerFile", "spark.sql.codegen.hugeMethodLimit")
    before, tasks, publish = [spark.conf.get(n) for n in names], [], queries.publish

    def noted(rows, table, batch):
        if batch.startswith("batch_id="):
            tasks.append(rows.rdd.getNumPartitions())
        publish(rows, table, batch)

    monkeypatch.setattr(queries, "publish", noted)
    monkeypatch.setattr(queries, "FACTS_IN_FILE", 4)
    first, second = queries._batches(spark, few_orders, 1, 2)
    assert (first.count(), second.count()) == (40, 40)
    assert tasks[0] >= 15 and tasks[1] >= 15
    assert [spark.conf.get(n) for n in names] == before


@pytest.mark.parametrize("array, broken", [(False, False), (True, False), (False, True), (True, True)])
def test_eight_files_however_many_tasks(spark, tmp_path, array, broken):
    """One file per number, in order of the keys, however the documents lie; missing, negative and repeated keys come along."""
    from tributary.sources import order_documents as source

    keys = [None, None, -3, -3, 3, 3, 8, 8, *range(100, 200)]
    rows = spark.createDataFrame([(key, f'{{"n":{n}}}') for n, key in enumerate(keys)], "o_orderkey long, document string")
    source.write_files(rows.repartition(40), str(tmp_path / "stage"), array, broken, "gzip")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that tasks stay as many
    try:
        source.write_files(rows.repartition(40), str(tmp_path / "apart"), array, broken)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for stage in ("stage", "apart"):
        texts = {r[0]: r[1] for r in spark.read.option("recursiveFileLookup", "true").text(
            str(tmp_path / stage), wholetext=True).selectExpr("_metadata.file_path", "value").collect()}
        assert len(texts) == 10
        for path, text in texts.items():
            no = path.split("file_no=")[1].split("/")[0]
            own = [n for n, key in enumerate(keys) if (key is None) == (no.startswith("__")) and (
                key is None or math.fmod(key, 8) == int(no))]
            assert text.startswith("[") == array
            if broken and no == "3":
                assert text.rstrip().endswith("}{")
                continue
            lines = text.rstrip("\n").split("\n")
            assert len(lines) == len(own)
            found = [int("".join(c for c in line if c.isdigit())) for line in lines]
            assert sorted(found) == own and [keys[n] for n in found] == [keys[n] for n in own]
            if array:
                assert text == "[" + ",\n".join(f'{{"n":{n}}}' for n in found) + "]\n"


def test_row_numbers_where_orders_lie_in_many_tasks(spark, few_orders):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = QUERIES["bronze_lines"](spark, few_orders).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = {no: list(range(1, len([k for k in range(31, 91) if k % 8 == no]) + 1)) for no in range(8)}
    assert {no: sorted(r["file_row_number"] for r in rows if r["file_no"] == no) for no in range(8)} == expected


@pytest.mark.parametrize("name", ["bronze_shapes", "bronze_late_files", "bronze_lines", "bronze_documents"])
def test_loaded_files_are_packed(spark, few_orders, tmp_path, monkeypatch, name):
    from tributary.plans import queries

    monkeypatch.setattr(queries, "shared_folder", lambda spark: str(tmp_path / "base"))
    QUERIES[name](spark, few_orders).collect()
    files = [f.name for f in (tmp_path / "base" / "stage").rglob("part-*")]
    assert files and all(f.endswith(".gz") for f in files)


def test_lines_are_shuffled_to_their_order_one_by_one(spark, few_orders):
    """Gathered after the shuffle only: lines of an order lie in many tasks, and lists of one are longer than lines."""
    from tributary.sources import order_documents as source

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = source.order_facts(spark, few_orders)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan[plan.index("ObjectHashAggregate"):].splitlines()
    assert "ObjectHashAggregate" in lines[1] and "partial_collect_list" in lines[1]
