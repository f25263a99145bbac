"""What the operators share: reading tables, tables written in between, broadcasts of a checked size."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.layout import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows, written once to the shared folder and read again: later steps neither compute
    them twice nor lose them with an executor."""
    spark = rows.sparkSession
    path = folder or f"{shared_folder(spark)}/rows"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file, the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)
