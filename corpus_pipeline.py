"""A training corpus from the documents table: five stages, each written before the next reads it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.llm.decontam import drop_contaminated
from stationlens.llm.mixing import mix
from stationlens.llm.neardup import drop_near_duplicates
from stationlens.llm.quality import quality
from stationlens.llm.queries import MIX
from stationlens.llm.sharding import with_shards
from stationlens.llm.words import fresh_name
from stationlens.scratch import delete
from stationlens.session import scratch_path

ORACLE_SQL = None  # the line labelling and the alignment have no SQL form; tests compare with brute force


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labelling keeps."""
    verdict = fresh_name(docs, "_quality")
    judged = quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), name=verdict)
    return judged.filter(F.col(verdict)["kept"]).drop(verdict)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the front of their leaf's epochs, whole; an epoch that repeats a document repeats its row."""
    share = fresh_name(docs, "_mix")
    return mix(docs, **MIX, name=share).drop(share)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows and columns with their shard and slot."""
    return with_shards(docs)


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet to the shared folder and read again."""
    docs, previous = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if previous:
            delete(spark, previous)  # the next stage reads this one's table alone
        docs, previous = spark.read.parquet(path), path
    return docs
