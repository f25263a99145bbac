"""Append-only parquet tables written one batch folder at a time.

A batch is written aside and renamed into place, so readers and streams see all
of it or nothing, and a repeated batch leaves the first result alone.
"""

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def path_part(spark: SparkSession, path: str) -> str:
    """Absolute path without scheme and host."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.makeQualified(hadoop_path).toUri().getPath()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold for a while."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write_rows(rows: DataFrame, path: str) -> None:
    """Write rows to a folder. Documents are stored as they are: taking each apart into columns and putting it
    together again costs more than to parse it, and they are mostly read whole."""
    with settings(rows.sparkSession, {"spark.sql.variant.inferShreddingSchema": "false"}):
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def staging_path(table: str, batch: str) -> str:
    parent, name = table.rstrip("/").rsplit("/", 1)
    return f"{parent}/_staging/{name}/{batch}"


def publish(rows: DataFrame, table: str, batch: str) -> None:
    """Write ``rows`` as ``<table>/<batch>`` unless that folder is already there.

    Callers make sure that a folder that is there comes from the same input.
    """
    spark = rows.sparkSession
    final = f"{table}/{batch}"
    if exists(spark, final):
        return
    staging = staging_path(table, batch)
    write_rows(rows, staging)
    put_in_place(spark, staging, table, batch)


def put_in_place(spark: SparkSession, staging: str, table: str, batch: str) -> None:
    fs, table_path = _hadoop(spark, table)
    fs.mkdirs(table_path)
    if not fs.rename(_hadoop(spark, staging)[1], _hadoop(spark, f"{table}/{batch}")[1]):
        raise OSError(f"cannot publish {table}/{batch}")


def batch_numbers(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the published ``name=<number>`` folders, ascending."""
    fs, path = _hadoop(spark, table)
    if not fs.exists(path):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return sorted(int(name.split("=")[1]) for name in names if "=" in name)


#: The last load that brought rows, or of which rows were taken, and how many of its rows.
MARK = T.StructType([T.StructField("load", T.LongType()), T.StructField("rows", T.LongType())])


def put_mark(spark: SparkSession, table: str, number: int, load: int, rows: int) -> None:
    """Leave a mark under a number, once; all but the last two marks go."""
    publish(spark.createDataFrame([(load, rows)], MARK).coalesce(1), table, f"batch_id={number}")
    for old in batch_numbers(spark, table)[:-2]:
        remove(spark, f"{table}/batch_id={old}")


def last_mark(spark: SparkSession, table: str, before: int | None = None) -> tuple[int, int] | None:
    """The newest mark, or the newest below a number; there are two at most, whatever the history."""
    numbers = [n for n in batch_numbers(spark, table) if before is None or n < before]
    if not numbers:
        return None
    return tuple(spark.read.schema(MARK).parquet(f"{table}/batch_id={numbers[-1]}").first())


def create_batched(spark: SparkSession, name: str, columns: str, path: str) -> None:
    """A catalog table, with the defaults of its columns, that takes one batch after the other."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, batch_id BIGINT) USING parquet"
              f" PARTITIONED BY (batch_id) LOCATION '{path}'")


def insert_batch(rows: DataFrame, name: str, batch_id: int) -> None:
    """Insert a batch into such a table. Columns that the rows leave out get their defaults; a batch that is
    there stays as it is. Spark's own commit makes the batch visible as a whole, with its partition."""
    spark, view = rows.sparkSession, f"batch_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}`" for c in rows.columns)
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (batch_id = {int(batch_id)}) IF NOT EXISTS ({columns})"
                  f" SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def read_batches(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All published batches with their ``batch_id``; empty if there are none."""
    full = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    if not exists(spark, table):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(table)


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of zero bytes under a folder, which Spark's file sources leave out: name, size, last change."""
    fs, folder = _hadoop(spark, path)
    found, base = [], path_part(spark, path).rstrip("/") + "/"
    files = fs.listFiles(folder, True) if fs.exists(folder) else None
    while files is not None and files.hasNext():
        status = files.next()
        name = status.getPath().toUri().getPath().removeprefix(base)
        if status.getLen() == 0 and not any(part[0] in "._" for part in name.split("/")):
            found.append((name, 0, status.getModificationTime()))
    rows = spark.createDataFrame(found, "name string, size long, millis long")
    return rows.select("name", "size", F.timestamp_millis("millis").alias("last_modified"))


# Largest file that is hashed as one value, unless it is compressed; Spark reads the lines of others only unpacked.
HASH_BYTES = 16 * 1024 * 1024
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"
_HASHES = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")),
                     ("md5", pa.string())])


def list_files(spark: SparkSession, path: str, md5: bool = False) -> DataFrame:
    """Files under a folder: name, size, last change and, on request, content hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    empty = empty_files(spark, path)
    if md5:
        # By metadata, so that files are left out when they are listed, before they are read.
        whole = (F.col("_metadata.file_size") <= HASH_BYTES) | F.col("_metadata.file_path").rlike(COMPRESSED)
        files = files.where(whole).select("path", "length", "modificationTime", F.md5("content").alias("md5")).unionByName(
            _line_hashes(spark, path, ~whole))
        empty = empty.withColumn("md5", F.md5(F.lit("").cast("binary")))
    columns = [
        relative_name(F.col("path"), path_part(spark, path)).alias("name"),
        F.col("length").alias("size"),
        *(["md5"] if md5 else []),
        F.col("modificationTime").alias("last_modified"),
    ]
    return files.select(*columns).unionByName(empty)


def _line_hashes(spark: SparkSession, path: str, chosen) -> DataFrame:
    """Hashes of files of any size: the lines of a file pass one task in their order, one after the other."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path, lineSep="\n").where(chosen)
    lines = lines.select(
        F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modificationTime"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("position"),
        F.col("value").cast("binary").alias("line"),
    )
    in_order = lines.repartition("path").sortWithinPartitions("path", "block_start", "position")
    return in_order.drop("block_start", "position").mapInArrow(
        _hash_lines(), "path string, length long, modificationTime timestamp, md5 string")


def _hash_lines():
    """A function of batches of lines. It is a local one, so that workers need not import this package."""
    shape = _HASHES

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A byte order mark and a line break at the end are not in the lines; the size tells if they are in the file.
        bom = b"\xef\xbb\xbf"
        file, plain, marked, length = None, None, None, 0

        def ended() -> pa.RecordBatch:
            left = file[1] - length
            if left not in (-1, 0, 2, 3):
                raise ValueError(f"{file[0]} has changed: {length} bytes read of {file[1]}")
            digest = marked if left > 0 else plain
            if left in (0, 3):
                digest.update(b"\n")
            return pa.RecordBatch.from_pylist([dict(zip(shape.names, (*file, digest.hexdigest())))], schema=shape)

        for batch in batches:
            heads = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for head, line in zip(heads, batch.column(3)):
                text = line.as_buffer()
                if file is None or head[0] != file[0]:
                    if file is not None:
                        yield ended()
                    file, plain, marked, length = head, hashlib.md5(), hashlib.md5(bom), 0
                else:
                    plain.update(b"\n")
                    marked.update(b"\n")
                plain.update(text)
                marked.update(text)
                length += len(text) + 1
        if file is not None:
            yield ended()

    return hashes


def relative_name(file_path, base_path: str):
    """File path below ``base_path``, whatever the scheme and host in front of it."""
    quoted = r"\Q" + base_path.rstrip("/") + r"\E"
    return F.regexp_replace(file_path, rf"^([A-Za-z0-9+.-]+:(//[^/]*)?)?{quoted}/", "")
