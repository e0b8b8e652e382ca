"""Stage tables written once per session to the shared folder and read back by later stages."""

from pyspark.sql import DataFrame, SparkSession

from stationlens.session import scratch_path

_WRITTEN = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The table ``build(spark, sf_dir)`` makes, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        build(spark, sf_dir).write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])
