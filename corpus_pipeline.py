"""The corpus pipeline: documents through quality rules, line dedup, near-dedup, benchmark
decontamination and mixing. Each stage is written as Parquet and read again as the next one's
documents; run() does so in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickmodel.llm import decontaminate, lines, mixing, neardup, queries, rules, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ready(spark)
    return rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ready(spark)
    return lines.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ready(spark)
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ready(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.ready(spark)
    return mixing.mixed_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("mixing", mix)]

# Learned or iterative stages (near-duplicate candidates, Newton steps) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
