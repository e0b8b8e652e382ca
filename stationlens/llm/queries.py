"""Registered queries of the operators, each over its whole table, and their check SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.llm import decontam, langid, lm, mixing, neardup, pii, preference, quality, runs, sharding, spelling, toxicity, warc
from stationlens.llm.words import documents

MIX = {"weights": {"lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}, "share": 0.8, "epochs": 2, "seed": 17}


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"), **MIX)
    m = F.col("_mix")
    return mixed.select("doc_id", m["domain"].alias("domain"), m["lang"].alias("lang"), m["source"].alias("source"), m["epoch"].cast("long").alias("epoch"), m["n_tokens"].alias("n_tokens"), m["take_tokens"].alias("take_tokens"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality.quality(docs, _table(spark, sf_dir, "labels")).select("doc_id", "quality_result.*")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op9_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preference.clean_turns(_table(spark, sf_dir, "conversations"))
    return preference.format_preferences(preference.exchanged(turns))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), shingle=3, threshold_pct=85)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, _table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(documents(spark, sf_dir))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (op1_lm_scoring, op2_language_id, op3_decontamination, op4_toxicity, op5_mixing, op6_quality_rules, op7_pii, op8_sharding, op9_chat_preferences, op10_near_duplicates, op11_warc, op12_periodic_runs, op13_spelling_variants)
}
CHECKS = {"op5_mixing": mixing.mix_sql(**MIX), "op9_chat_preferences": preference.preference_sql(), "op11_warc": warc.round_trip_sql()}
