"""Registered queries: correlations inside (year, sensor) cells."""

from pyspark.sql import functions as F

from stationlens.operators import covary as V
from stationlens.plans.base import check_sql, present
from stationlens.plans.stage_load import hourly
from stationlens.plans.store import stored
from stationlens.session import scratch_path
from stationlens.sources.readings import write_cell_matrices


def cells(s, d):
    return V.cell_correlations(hourly(s, d))


def pairs(s, d):
    return stored(s, d, "cell_pairs", lambda s, d: V.flatten_pairs(cells(s, d)))


def _matrices(s, d):
    path = scratch_path(s, "cell_matrices")
    write_cell_matrices(pairs(s, d), path)
    return s.read.parquet(path)


def drivers(s, d):
    return V.pollutant_drivers(pairs(s, d))


QUERIES = {
    "cell_grid": lambda s, d: V.cell_grid(hourly(s, d)),
    "hourly_wide": lambda s, d: V.hourly_wide(hourly(s, d)),
    "cell_eligibility": lambda s, d: V.cell_eligibility(V.hourly_wide(hourly(s, d))),
    "cell_correlations": cells,
    "flatten_pairs": lambda s, d: V.flatten_pairs(cells(s, d)),
    "write_cell_matrices": _matrices,
    "stable_strong": lambda s, d: V.stable_strong(pairs(s, d), 0.03),
    "stable_pairs": lambda s, d: V.stable_pairs(pairs(s, d), 0.05, 0.3),
    "yearly_pct_above": lambda s, d: V.yearly_pct_above(pairs(s, d), 0.05),
    "pollution_association": lambda s, d: V.pollution_association(pairs(s, d)),
    "pollutant_drivers": drivers,
    "driver_top_k": lambda s, d: V.driver_top_k(drivers(s, d), 1),
}
QUERIES = {k: (lambda s, d, f=f: present(f(s, d))) for k, f in QUERIES.items()}

_POLL = "('NO2', 'NOX', 'O3')"
CTES = {
    "hw": "SELECT year, sensor_id, entry_date, magnitude_name, avg(value) AS value FROM hourly GROUP BY ALL",
    "elig": "SELECT year, sensor_id, count(DISTINCT entry_date) AS n_hours, list_sort(list(DISTINCT magnitude_name)) AS variables FROM hw GROUP BY ALL",
    "cc": """SELECT a.year, a.sensor_id, a.magnitude_name AS var_a, b.magnitude_name AS var_b, corr(a.value, b.value) AS correlation, count(*) AS n_common_hours FROM hw a JOIN hw b
      ON a.year = b.year AND a.sensor_id = b.sensor_id AND a.entry_date = b.entry_date AND a.magnitude_name < b.magnitude_name
      JOIN elig e ON e.year = a.year AND e.sensor_id = a.sensor_id WHERE n_hours >= 24 AND len(variables) >= 2 GROUP BY ALL
      HAVING min(a.value) < max(a.value) AND min(b.value) < max(b.value)""",
    "cp": "SELECT year, sensor_id, var_a, var_b, var_a || ' ↔ ' || var_b AS pair, correlation, abs(correlation) AS abs_correlation FROM cc",
    "ends": "SELECT 'a' AS side, var_a AS variable, var_b AS other, correlation FROM cp UNION ALL SELECT 'b', var_b, var_a, correlation FROM cp",
    "drv": "SELECT variable, avg(correlation) AS mean_r, stddev_samp(correlation) AS std_r, count(*) AS n_cells, CASE WHEN variable IN ('NOX', 'O3') THEN 'Pollutant' WHEN variable = 'VV' THEN 'Weather' ELSE 'Traffic' END AS category FROM ends WHERE other = 'NO2' GROUP BY 1",
}


def _c(body, **kw):
    return check_sql(body, ctes=CTES, **kw)


_P = dict(d="correlation abs_correlation", i="year sensor_id")
CHECKS = {
    "cell_grid": _c("SELECT year, sensor_id FROM (SELECT DISTINCT year FROM hourly) CROSS JOIN (SELECT DISTINCT sensor_id FROM hourly)", i="year sensor_id"),
    "hourly_wide": _c("SELECT * FROM hw", d="value", i="year sensor_id", t="entry_date"),
    "cell_eligibility": _c("SELECT year, sensor_id, n_hours, array_to_string(variables, ',') AS variables, n_hours >= 24 AND len(variables) >= 2 AS eligible FROM elig", i="year sensor_id"),
    "cell_correlations": _c("SELECT * FROM cc", d="correlation", i="year sensor_id"),
    "flatten_pairs": _c("SELECT * FROM cp", **_P),
    "write_cell_matrices": _c("SELECT * FROM cp", **_P),
    "stable_strong": _c("""SELECT * FROM (SELECT pair AS pair_str, quantile_cont(abs_correlation, 0.5) AS median_abs_corr, avg(abs_correlation) AS mean_abs_corr, stddev_samp(abs_correlation) AS std_abs_corr, count(*) AS n_observations,
      count(DISTINCT year) AS n_years FROM cp GROUP BY 1) WHERE median_abs_corr >= 0.03""", d="median_abs_corr mean_abs_corr std_abs_corr"),
    "stable_pairs": _c("""SELECT *, n_above / n_cells::DOUBLE AS stability_frac FROM (SELECT pair AS pair_str, count(*) AS n_cells, count(*) FILTER (WHERE abs_correlation >= 0.05) AS n_above, quantile_cont(abs_correlation, 0.5) AS median_abs_corr,
      avg(abs_correlation) AS mean_abs_corr, stddev_samp(abs_correlation) AS std_abs_corr, count(DISTINCT year) AS n_years, count(DISTINCT sensor_id) AS n_sensors, avg(correlation) AS mean_signed_corr FROM cp GROUP BY 1)
      WHERE n_above / n_cells::DOUBLE >= 0.3""", d="median_abs_corr mean_abs_corr std_abs_corr mean_signed_corr stability_frac"),
    "yearly_pct_above": _c("SELECT year, 100 * avg(CASE WHEN abs_correlation >= 0.05 THEN 1.0::DOUBLE ELSE 0 END) AS pct_above_threshold FROM cp GROUP BY 1", d="pct_above_threshold", i="year"),
    "pollution_association": _c(f"""SELECT variable, avg(m) AS mean_signed_corr_with_pollutants, abs(avg(m)) AS mean_abs_corr_with_pollutants FROM (SELECT variable, side, avg(correlation) AS m FROM ends WHERE other IN {_POLL} GROUP BY 1, 2)
      WHERE variable NOT IN {_POLL} GROUP BY 1""", d="mean_signed_corr_with_pollutants mean_abs_corr_with_pollutants"),
    "pollutant_drivers": _c("SELECT * FROM drv", d="mean_r std_r"),
    "driver_top_k": _c("""SELECT category, sign, rank, variable, mean_r FROM (SELECT *, row_number() OVER (PARTITION BY category, sign ORDER BY abs(mean_r) DESC, variable) AS rank
      FROM (SELECT *, sign(mean_r) AS sign FROM drv)) WHERE rank <= 1""", d="mean_r", i="sign"),
}
