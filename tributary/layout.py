"""Where the tables of one environment lie."""

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tributary.functions.values import SILVER_COMMENT
from tributary.schemas import DEAD_LETTER, RAW_ORDERS, STG_ORDERS, columns_ddl

LAYERS = ("bronze", "silver", "gold", "serving")


@dataclass(frozen=True)
class Layout:
    """Tables under ``<base>/<env>/<layer>/``; ``base`` is a folder all executors share."""

    base: str
    env: str = "dev"

    def layer(self, name: str) -> str:
        return f"{self.base}/{self.env}/{name}"

    @property
    def load_records(self) -> str:
        return f"{self.layer('bronze')}/load_records"

    @property
    def load_history(self) -> str:
        return f"{self.layer('bronze')}/load_history"

    @property
    def dead_letter(self) -> str:
        return f"{self.layer('silver')}/dead_letter"

    @property
    def order_changes(self) -> str:
        return f"{self.layer('silver')}/order_changes"

    @property
    def order_snapshots(self) -> str:
        return f"{self.layer('silver')}/order_snapshots"

    @property
    def step_inputs(self) -> str:
        return f"{self.layer('silver')}/step_inputs"

    @property
    def consumed(self) -> str:
        return f"{self.layer('silver')}/consumed"

    @property
    def newest_load(self) -> str:
        return f"{self.layer('bronze')}/newest_load"

    @property
    def newest_taken(self) -> str:
        return f"{self.layer('silver')}/newest_taken"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/{self.env}/checkpoints/{name}"

    def create_databases(self, spark: SparkSession) -> list[str]:
        """One database per layer of this environment; gold and serving start empty."""
        names = [f"{self.env}_{layer}" for layer in LAYERS]
        for name, layer in zip(names, LAYERS):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.layer(layer)}'")
        return names

    def create_tables(self, spark: SparkSession) -> list[str]:
        """Definitions of the tables in their databases: columns, defaults and comment."""
        bronze, silver, *_ = self.create_databases(spark)
        names = []
        for database, name, schema, comment in (
            (bronze, "raw_orders", RAW_ORDERS, ""),
            (silver, "dead_letter", DEAD_LETTER, ""),
            (silver, "stg_orders", STG_ORDERS, SILVER_COMMENT),
        ):
            about = f" COMMENT '{comment}'" if comment else ""
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns_ddl(name, schema)}) USING parquet{about}"
            )
            names.append(f"{database}.{name}")
        return names


def scratch_path(spark: SparkSession) -> str:
    """A new path that every executor can reach, below ``spark.checkpoint.dir``.

    Only a local session may leave that unset; it gets a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/tributary-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tributary-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder at such a path; it goes when the session's JVM ends."""
    path = scratch_path(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
