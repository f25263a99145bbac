"""Queries over order documents made from the given tables.

Clock and random columns are left out and decimals shown as bigint, so that the
results can be compared.
"""

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.documents import with_typed_fields
from tributary.layout import Layout, shared_folder
from tributary.operators import rules
from tributary.operators.merge import RepeatedKeyError, fold_scd1, merge_scd1
from tributary.operators.normalize import normalize
from tributary.plans import bronze, silver
from tributary.schemas import DEAD_LETTER, STG_ORDERS, columns_ddl
from tributary.sources import order_documents as source
from tributary.sources.json_files import documents_of_pieces, file_rows, read_documents, with_file_names, write_pieces
from tributary.sources.tables import create_batched, insert_batch, list_files, publish, read_batches, settings
from tributary.streaming.changes import change_stream, has_data
from tributary.streaming.ingest import pipe_status, refresh_pipe
from tributary.streaming.task import call_step, resume_task

CLOCKS = ("ingested_at", "transformed_at")
MERGED_AT = "1970-01-01 00:00:00"
# Orders in a file of facts. To make documents of one file, read and check them takes a task some seconds; a file of
# one row group cannot be split, and few long tasks leave cores idle at the end of a batch.
FACTS_IN_FILE = 100_000
# Eight plain files of text are some 1.1 kB per order; a packed file is read by one task.
PACKED = "gzip"
# Opening a file counts as much as a block, so that a task gets one file.
WHOLE_FILE = 128 * 1024 * 1024


def _shown(rows: DataFrame, *leave_out: str) -> DataFrame:
    return rows.select(*(
        F.col(n).cast("bigint").alias(n) if t.startswith("decimal") else F.col(n)
        for n, t in rows.dtypes
        if n not in leave_out
    ))


def _file_no(name: str = "file_name") -> Column:
    return F.regexp_extract(name, r"file_no=(\d+)", 1).cast("bigint").alias("file_no")


def _facts(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The joined tables, written once where several revisions are made of them."""
    facts = source.order_facts(spark, sf_dir)
    if folder is None:
        return facts
    publish(facts, folder, "facts")
    return spark.read.schema(facts.schema).parquet(f"{folder}/facts")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.raw_orders(_facts(spark, sf_dir)).drop("o_orderkey")


def _classified(spark: SparkSession, sf_dir: str, *columns: str, mode: str = "reference") -> DataFrame:
    return rules.classify(_raw(spark, sf_dir), mode, columns or None)


def _batches(spark: SparkSession, sf_dir: str, *revisions: int) -> list[DataFrame]:
    """Accepted order rows of some merge batches, written once and read as stored tables."""
    folder = shared_folder(spark)
    table = f"{folder}/order_changes"
    with settings(spark, {"spark.sql.files.maxRecordsPerFile": str(FACTS_IN_FILE)}):
        facts = _facts(spark, sf_dir, folder)
    # Larger methods than this the JVM never compiles.
    with _blocks_of(spark, WHOLE_FILE), settings(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"}):
        for revision in revisions:
            raw = source.in_batch(source.raw_orders(facts, revision), revision).drop("o_orderkey")
            _publish_accepted(raw, table, revision)
    stored = read_batches(spark, table, STG_ORDERS)
    return [stored.where(F.col("batch_id") == revision) for revision in revisions]


def _publish_accepted(raw: DataFrame, table: str, batch_id: int) -> None:
    accepted = normalize(rules.classify(raw).where(F.col("route") == rules.ACCEPTED))
    merged_at = F.lit(MERGED_AT).cast("timestamp_ntz")
    publish(accepted.withColumn("transformed_at", merged_at), table, f"batch_id={batch_id}")


def _blocks_of(spark: SparkSession, size: int):
    """Files are read in blocks of at most so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    return settings(spark, {name: str(size) for name in names})


def _empty_orders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STG_ORDERS)


# --- bronze ------------------------------------------------------------------


def _stage(
    spark: SparkSession, sf_dir: str, array: bool = True, broken: bool = False, compression: str = PACKED
) -> tuple[Layout, str]:
    layout = Layout(shared_folder(spark))
    stage = f"{layout.base}/stage"
    # Read twice if the files start and end with more than their documents.
    facts = _facts(spark, sf_dir, layout.base if array or broken else None)
    source.write_files(_file_documents(facts), stage, array, broken, compression)
    return layout, stage


def _file_documents(facts: DataFrame, revision: int = 1) -> DataFrame:
    return source.order_documents(source.in_files(facts), revision)


def _lines_stage(
    spark: SparkSession, sf_dir: str, again: bool = True, compression: str = "snappy"
) -> tuple[Layout, str, DataFrame]:
    """Files of lines for queries that show neither names nor row numbers, and the facts they are made of, which
    are stored if they are needed ``again``."""
    layout = Layout(shared_folder(spark))
    facts, stage = _facts(spark, sf_dir, layout.base if again else None), f"{layout.base}/stage"
    source.write_lines(source.order_documents(facts), stage, compression)
    return layout, stage, facts


def _numbered(documents: DataFrame) -> DataFrame:
    return documents.select(
        _file_no(),
        F.col("file_row_number").cast("bigint").alias("file_row_number"),
        F.variant_get("raw_data", "$.order_id", "string").alias("order_id"),
    )


def bronze_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stage = _stage(spark, sf_dir)
    return _numbered(read_documents(spark, stage, "document"))


def bronze_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one array each, read in blocks of a sixteenth of the largest file."""
    layout, stage = _stage(spark, sf_dir, compression="none")
    largest = list_files(spark, stage).agg(F.max("size")).first()[0] or 0
    with _blocks_of(spark, max(largest // 16, 1)):
        files = with_file_names(file_rows(spark.read, stage, "array"), stage)
        pieces = write_pieces(files, f"{layout.base}/staging")
    return _numbered(documents_of_pieces(pieces, f"{layout.base}/staging"))


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, stage = _stage(spark, sf_dir, array=False)
    return _numbered(read_documents(spark, stage, "lines", f"{layout.base}/staging"))


def bronze_lines_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of lines through the pipe."""
    layout, stage = _stage(spark, sf_dir, array=False)
    refresh_pipe(spark, layout, stage, "lines")
    return _numbered(bronze.raw_orders(spark, layout))


def bronze_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of the documents, read back from files."""
    _, stage = _stage(spark, sf_dir)
    items = F.variant_get("raw_data", "$.items", "array<struct<product_id string, product_name string,"
                          " category string, quantity bigint, unit_price double>>")
    documents = read_documents(spark, stage, "document").select(
        F.variant_get("raw_data", "$.shipment.shipment_id", "string").alias("shipment_id"), items.alias("items"))
    return documents.select("shipment_id", F.posexplode("items").alias("position", "item")).select(
        "shipment_id", F.col("position").cast("bigint").alias("position"), "item.*")


def _history(spark: SparkSession, layout: Layout) -> DataFrame:
    return bronze.copy_history(spark, layout).select(
        "table_name", _file_no(), "row_count", "row_parsed", "first_error", "status"
    )


def bronze_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, stage = _stage(spark, sf_dir, broken=True)
    refresh_pipe(spark, layout, stage, "document")
    return _history(spark, layout)


def bronze_load_history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As files of lines, with one that holds an empty array and one of zero bytes."""
    layout, stage = _stage(spark, sf_dir, array=False, broken=True)
    for number, text in ((8, "[]"), (9, "")):
        _write_text(spark, f"{stage}/file_no={number}/part.json", text)
    refresh_pipe(spark, layout, stage, "lines")
    left = bronze.pending_files(spark, layout, stage).agg(F.count("*").alias("pending"))
    return _history(spark, layout).withColumn("pending", F.lit(left.first()[0]))


def bronze_pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrived after a load: here the documents once more, one per line."""
    layout, stage, facts = _lines_stage(spark, sf_dir, compression=PACKED)
    refresh_pipe(spark, layout, stage, "lines")
    source.write_files(_file_documents(facts, 2), f"{stage}/late", array=False, compression=PACKED)
    return bronze.pending_files(spark, layout, stage).select(_file_no("name"))


def bronze_pipe_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of a pipe after its load, before and after more files arrive."""
    layout, stage, facts = _lines_stage(spark, sf_dir, compression=PACKED)
    pipe = refresh_pipe(spark, layout, stage, "lines")
    loaded = pipe_status(spark, pipe, layout, stage)
    source.write_files(_file_documents(facts, 2), f"{stage}/late", array=False, compression=PACKED)
    later = pipe_status(spark, pipe, layout, stage)
    rows = bronze.raw_orders(spark, layout).agg(F.count("*").alias("loaded_rows"))
    return rows.selectExpr("loaded_rows", "inline(array({})) AS (phase, execution_state, pending_files)".format(", ".join(
        f"struct('{phase}', '{s['execution_state']}', {s['pending_file_count']}L)"
        for phase, s in (("loaded", loaded), ("later", later))
    )))


def bronze_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per round of a load whose second round finds files ten days older than those of the first."""
    layout, stage, facts = _lines_stage(spark, sf_dir, compression=PACKED)
    refresh_pipe(spark, layout, stage, "lines")
    source.write_lines(source.order_documents(facts, 2), f"{stage}/late", PACKED)
    _set_age(spark, f"{stage}/late", days=10)
    refresh_pipe(spark, layout, stage, "lines")
    rows = bronze.raw_orders(spark, layout).withColumn("late", F.col("file_name").startswith("late/"))
    return rows.groupBy("late").agg(F.count("*").alias("documents"))


def bronze_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents on a line, each with a text that looks like a gap between documents."""
    layout = Layout(shared_folder(spark))
    # Facts are shorter than documents, so they are shuffled to their pairs.
    facts = _facts(spark, sf_dir).withColumns({
        "file_no": F.expr(f"o_orderkey % {source.FILES}"), "pair": F.expr(f"o_orderkey DIV {source.FILES} DIV 2")})
    documents = source.order_documents(facts.repartition("file_no", "pair"))
    marked = documents.withColumn("document", F.replace(
        "document", F.lit('"warehouse":{'), F.lit('"note":"} {\\\\","warehouse":{')))
    lines = marked.groupBy("file_no", "pair").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "document"))), lambda d: d["document"]),
                     " ").alias("value"))
    lines.select("file_no", "value").write.partitionBy("file_no").option("compression", PACKED).text(f"{layout.base}/stage")
    found = read_documents(spark, f"{layout.base}/stage", "lines", f"{layout.base}/staging")
    return found.select(
        F.variant_get("raw_data", "$.shipment.shipment_id", "string").alias("shipment_id"),
        F.variant_get("raw_data", "$.note", "string").alias("note"))


def stage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, stage = _stage(spark, sf_dir, compression="none")
    return list_files(spark, stage, md5=True).select(_file_no("name"), "size", "md5")


def table_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the tables as the catalog has them, with the comment, and the orders they are made for."""
    layout = Layout(shared_folder(spark), env=f"def{uuid.uuid4().hex[:12]}")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.count("*").alias("orders"))
    parts = []
    for name in layout.create_tables(spark):
        comment = next((r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
                        if r["col_name"] == "Comment"), "")
        parts += [(name.split(".")[1], i, f.name, f.dataType.simpleString(), comment)
                  for i, f in enumerate(spark.table(name).schema)]
    rows = ", ".join(f"struct('{t}', {i}L, '{c}', '{k}', '{about}')" for t, i, c, k, about in parts)
    return orders.selectExpr("orders", f"inline(array({rows})) AS (table_name, position, column_name, type, comment)")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _set_age(spark: SparkSession, folder: str, days: int) -> None:
    """Give the files of a folder an old time, as a move or copy that keeps times does."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        status = files.next()
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def stream_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the change stream delivers in two rounds."""
    layout = Layout(shared_folder(spark))
    stage, seen = f"{layout.base}/stage", f"{layout.base}/seen"

    def deliver(batch: DataFrame, batch_id: int) -> None:
        delivered = batch.select(
            F.lit(batch_id).cast("bigint").alias("delivery"),
            _file_no(),
            "file_row_number",
            F.variant_get("raw_data", "$.order_id", "string").alias("order_id"),
            "action",
            "is_update",
        )
        publish(delivered, seen, f"batch_id={batch_id}")

    facts = _facts(spark, sf_dir, layout.base)
    for revision in (1, 2):
        documents = _file_documents(source.in_batch(facts, revision), revision)
        source.write_files(documents, f"{stage}/r{revision}", array=False, compression=PACKED)
        refresh_pipe(spark, layout, stage, "lines")
        change_stream(spark, layout).writeStream.option(
            "checkpointLocation", layout.checkpoint("seen")
        ).foreachBatch(deliver).trigger(availableNow=True).start().awaitTermination()
    return _shown(spark.read.parquet(seen), "batch_id")


def stream_has_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the silver step has work, before the load, after it and after the step."""
    layout, stage, _ = _lines_stage(spark, sf_dir, again=False)
    found = [("empty", has_data(spark, layout))]
    refresh_pipe(spark, layout, stage, "lines")
    found.append(("loaded", has_data(spark, layout)))
    call_step(spark, layout)
    found.append(("stepped", has_data(spark, layout)))
    loads = bronze.copy_history(spark, layout).agg(F.sum("row_count").alias("loaded_rows"))
    return loads.selectExpr(
        "inline(array({})) AS (phase, has_data)".format(
            ", ".join(f"struct('{phase}', {str(value).lower()})" for phase, value in found)
        ),
        "loaded_rows",
    )


# --- silver ------------------------------------------------------------------


def silver_typed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = with_typed_fields(_raw(spark, sf_dir))
    return _shown(
        typed, "raw_data", "ingested_at", "load_id", "day_first", "order_timestamp",
        "unit_price_text", "total_amount_text",
    )


def _keyed(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(
        "file_name", F.col("file_row_number").cast("bigint").alias("file_row_number"), *columns
    )


def silver_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(_classified(spark, sf_dir, "order_id", "route").where(F.col("route") == rules.REJECTED), "order_id")


def silver_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = silver.dead_letters(silver.routed_rows(_raw(spark, sf_dir)))
    return _keyed(
        letters.withColumn("order_id", F.variant_get("raw_data", "$.order_id", "string")),
        "order_id", "error_reason",
    )


def insert_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters inserted without their time into a catalog table, one batch, then a batch of that number again."""
    layout = Layout(shared_folder(spark), env=f"ins{uuid.uuid4().hex[:12]}")
    name = f"{layout.create_databases(spark)[1]}.dead_letter_batches"
    create_batched(spark, name, columns_ddl("dead_letter", DEAD_LETTER), f"{layout.layer('silver')}/dead_letter_batches")
    letters = silver.dead_letters(silver.routed_rows(_raw(spark, sf_dir))).drop("rejected_at")
    insert_batch(letters, name, 1)
    insert_batch(letters.limit(1), name, 1)
    return _keyed(
        spark.table(name).withColumns({
            "order_id": F.variant_get("raw_data", "$.order_id", "string"),
            "has_time": F.col("rejected_at").isNotNull(),
        }),
        "order_id", "error_reason", "has_time", "batch_id",
    )


def silver_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _classified(spark, sf_dir, "route", "error_reason").where(F.col("route") == rules.REJECTED)
    return rejected.groupBy("error_reason").agg(F.count("*").alias("documents"))


def silver_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(_classified(spark, sf_dir, "order_id", "route").where(F.col("route") == rules.ACCEPTED), "order_id")


def silver_unrouted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(_classified(spark, sf_dir, "order_id", "route").where(F.col("route") == rules.UNROUTED), "order_id")


def silver_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.route_counts(_classified(spark, sf_dir, "route"))


def silver_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(
        _classified(spark, sf_dir, "route", "error_reason", mode="tolerant"), "route", "error_reason"
    )


def silver_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = with_typed_fields(_raw(spark, sf_dir))
    return _keyed(typed, "order_date_text", F.col("order_timestamp").alias("order_date"))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = silver.accepted_orders(silver.routed_rows(_raw(spark, sf_dir)))
    return _shown(accepted, *CLOCKS)


# --- merge -------------------------------------------------------------------


def merge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written once: the merge reads its source three times.
    folder = shared_folder(spark)
    _publish_accepted(_raw(spark, sf_dir), folder, 1)
    return _shown(merge_scd1(_empty_orders(spark), read_batches(spark, folder, STG_ORDERS)), *CLOCKS)


def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(merge_scd1(*_batches(spark, sf_dir, 1, 2)), *CLOCKS)


def merge_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second, third = _batches(spark, sf_dir, 1, 2, 3)
    return _shown(fold_scd1(first.unionByName(second).unionByName(third)), *CLOCKS)


def _again(rows: DataFrame) -> DataFrame:
    """Some of the rows once more, later in their file and by air."""
    some = rows.where("CAST(regexp_extract(order_id, '([0-9]+)$', 1) AS bigint) % 10 = 1")
    return some.withColumns({
        "file_row_number": (F.col("file_row_number") + 100_000).cast("decimal(38,0)"),
        "carrier": F.lit("AIR"),
    })


def merge_duplicate_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 2 with some of its rows again onto batch 1."""
    first, second = _batches(spark, sf_dir, 1, 2)
    return _shown(merge_scd1(first, second.unionByName(_again(second)), "latest"), *CLOCKS)


def merge_duplicate_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New orders that batch 2 brings twice are inserted twice; a known order twice fails the merge."""
    first, second = _batches(spark, sf_dir, 1, 2)
    twice = second.unionByName(_again(second))
    try:
        merge_scd1(first, twice)
        failed = False
    except RepeatedKeyError:
        failed = True
    # Written once: the merge reads its source four times.
    folder = shared_folder(spark)
    publish(twice.join(first.select("order_id"), "order_id", "left_anti").select(*STG_ORDERS.names), folder, "new")
    new = spark.read.schema(STG_ORDERS).parquet(f"{folder}/new")
    return _shown(merge_scd1(first, new).withColumn("known_twice_fails", F.lit(failed)), *CLOCKS)


# --- end to end --------------------------------------------------------------


def run_steps(spark: SparkSession, sf_dir: str, snapshot_every: int | None = None, numbered: bool = False) -> Layout:
    """Files of batches 1 and 2 through bronze into the silver tables, one step each. ``numbered``: eight files
    in order of their keys, for results that show file or row numbers."""
    layout = Layout(shared_folder(spark))
    facts, stage = _facts(spark, sf_dir, layout.base), f"{layout.base}/stage"
    for revision in (1, 2):
        batch = source.in_batch(facts, revision)
        if numbered:
            source.write_files(_file_documents(batch, revision), f"{stage}/r{revision}", array=False, compression=PACKED)
        else:
            source.write_lines(source.order_documents(batch, revision), f"{stage}/r{revision}", PACKED)
        refresh_pipe(spark, layout, stage, "lines")
        call_step(spark, layout, snapshot_every=snapshot_every if revision == 1 else None)
    return layout


def silver_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.table_counts(spark, run_steps(spark, sf_dir))


def _accounts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Outcomes by the steps' notes, and the rows that are stored."""
    noted = silver.row_accounting(spark, layout)
    stored = {
        "stored_changes": read_batches(spark, layout.order_changes, STG_ORDERS),
        "stored_dead_letters": silver.dead_letter(spark, layout),
        "stored_documents": bronze.raw_orders(spark, layout),
    }
    return noted.select("*", *(
        rows.select(F.count("*")).scalar().alias(name) for name, rows in stored.items()
    ))


def silver_row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accounts(spark, run_steps(spark, sf_dir))


def silver_failed_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third batch brings known orders twice, fails without a trace, and goes through when the last may win."""
    layout = run_steps(spark, sf_dir)
    before = _accounts(spark, layout).first()
    stage, facts = f"{layout.base}/stage", _facts(spark, sf_dir, layout.base)
    for part in ("a", "b"):
        source.write_lines(source.order_documents(facts, 3), f"{stage}/r3{part}", PACKED)
    refresh_pipe(spark, layout, stage, "lines")
    try:
        call_step(spark, layout)
        failed = False
    except StreamingQueryException:
        failed = True
    middle = _accounts(spark, layout).first()
    unchanged = all(before[c] == middle[c] for c in before.asDict() if c != "stored_documents")
    call_step(spark, layout, on_duplicate="latest", mode="tolerant")
    return _accounts(spark, layout).select("*", F.lit(failed).alias("failed"), F.lit(unchanged).alias("unchanged"))


def silver_scheduled_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick of the scheduled task over files of lines, then it is suspended."""
    layout, stage, _ = _lines_stage(spark, sf_dir, again=False)
    refresh_pipe(spark, layout, stage, "lines")
    task = resume_task(spark, layout, interval="1 second")
    try:
        task.processAllAvailable()
    finally:
        task.stop()
    return silver.table_counts(spark, layout)


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table after two steps, the first of them in a snapshot, the second merged by the reader."""
    layout = run_steps(spark, sf_dir, snapshot_every=1, numbered=True)
    return _shown(silver.stg_orders(spark, layout).withColumn("file_no", _file_no()), *CLOCKS, "file_name")


QUERIES = {
    f.__name__: f
    for f in (
        bronze_documents, bronze_array_split, bronze_lines, bronze_lines_loaded, bronze_items, bronze_load_history,
        bronze_load_history_lines, bronze_pending_files, bronze_pipe_status, bronze_late_files,
        bronze_shapes, stage_listing, table_definitions, stream_append_only, stream_has_data,
        silver_typed_fields, silver_reject, silver_dead_letter, insert_defaults, silver_reason_counts, silver_accept,
        silver_unrouted, silver_route_counts, silver_tolerant, silver_order_date, silver_orders,
        merge_insert, merge_update, merge_fold, merge_duplicate_latest, merge_duplicate_reference,
        silver_step_counts, silver_row_accounting, silver_failed_step, silver_scheduled_task, stored_orders,
    )
}
