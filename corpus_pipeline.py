"""From documents to packed training sequences, in stages that are written and read again.

Language identification drops documents it rejects; SimHash leaves one document of each near-duplicate
group; documents that overlap the benchmark go; secrets are replaced by a mark; best-fit packing gives
the sequences. All stages but the last keep the columns of documents.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.layout import shared_folder
from tributary.llm import decontaminate, language_id, packing, secret_scan, simhash
from tributary.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs, language_id.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

#: SQL has no tokenizer and no learned model; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, docs = shared_folder(spark), table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{base}/{number}_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
