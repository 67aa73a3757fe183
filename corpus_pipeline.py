"""The training-data pipeline: quality rules, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
documents. A stage frees the scratch tables of the stage before, whose result has been
written by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rinkframe.llm import exact_dedup, jaccard, mixing, packing, quality, storage


def _stage(name: str, after: str | None, work):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if after:
            storage.release(f"pipeline-{after}")
        storage.release(f"pipeline-{name}")
        with storage.scope(f"pipeline-{name}"):
            return work(docs)

    return name, run_stage


def _pack(docs: DataFrame) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    _stage("quality_rules", None, quality.keep),
    _stage("exact_dedup", "quality_rules", exact_dedup.drop_duplicates),
    _stage("jaccard_join", "exact_dedup", jaccard.keep_one),
    _stage("mix_sources", "jaccard_join", mixing.mix),
    _stage("best_fit_packing", "mix_sources", _pack),
]

#: Minimum-covariance-determinant estimates and components of similar texts have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; one row per packed piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        path = storage.new_folder(spark, f"pipeline-{name}")
        docs.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return docs
