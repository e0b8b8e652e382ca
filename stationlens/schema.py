"""Table schemas and the catalogue of variable names."""

from pyspark.sql import types as T

READINGS = T.StructType(
    [
        T.StructField("entry_date", T.TimestampType()),
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("sensor_name", T.StringType()),
        T.StructField("utm_x", T.DoubleType()),
        T.StructField("utm_y", T.DoubleType()),
        T.StructField("magnitude_id", T.IntegerType()),
        T.StructField("magnitude_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("is_interpolated", T.BooleanType()),
    ]
)

# The variable catalogue of the monitoring network. Results depend on these names.
POLLUTANTS = [
    "SO2", "CO", "NO", "NO2", "PM2.5", "PM10", "<PM2.5", "<PM10", "NOX", "O3",
    "TOLUENO", "BENCENO", "ETILBENCENO", "HIDROCARBS_TOTALES", "METANO",
    "HIDROCARBS_NO_METANICOS",
]
WEATHER = ["TEMP", "HR", "PRE", "RS", "VV", "DV", "PRECIPITACION"]
TRAFFIC_PREFIXES = ["TI_", "SP_", "OC_"]
PREFERRED_TRAFFIC_PREFIX = "TI_"
# Temperature and wind direction may be handled apart: temperature may be negative and
# direction has its own range check.
# The lists below must match the variables' names.
NON_NEGATIVE_WEATHER = ["VV", "HR", "PRE", "RS", "PRECIPITACION"]
DENSITY_FOCUS = ["NO2", "NOX", "NO", "O3", "CO", "SO2", "<PM10", "<PM2.5"]
POLLUTION_PRIORITY = ["NO2", "NOX", "NO"]

# Names and display labels of the imputation methods.
METHOD_LABELS = {
    "imputed_grouped_mean": "Grouped mean",
    "imputed_grouped_median": "Grouped median",
    "imputed_ffill": "Forward fill",
    "imputed_bfill": "Backward fill",
    "imputed_last_next": "Last-next avg",
}
METHODS = list(METHOD_LABELS)

# Quality checks and their display labels.
ISSUE_LABELS = {
    "negative_values_for_non_negative_variables": "Negative values",
    "relative_humidity_outside_0_100": "Humidity out of range",
    "wind_direction_outside_0_360": "Wind dir out of range",
    "missing_coordinates": "Missing coordinates",
    "duplicate_sensor_variable_timestamp_rows": "Duplicate rows",
    "unknown_interpolation_flags": "Unknown interp. flags",
}
VARIABLE_TYPES = ["pollutant", "traffic", "unknown", "weather"]
