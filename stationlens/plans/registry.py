"""All registered queries and their check SQL."""

from stationlens.plans import stage_covary, stage_forecast, stage_impute, stage_load, stage_network, stage_quality, stage_temporal

_STAGES = [stage_load, stage_quality, stage_impute, stage_temporal, stage_network, stage_covary, stage_forecast]
QUERIES = {k: f for s in _STAGES for k, f in s.QUERIES.items()}
CHECKS = {k: q for s in _STAGES for k, q in s.CHECKS.items()}


def flagship(spark, sf_dir):
    return QUERIES["mann_kendall"](spark, sf_dir)
