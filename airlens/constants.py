"""Fixed values.

FIXED VALUES -- these must equal the behaviour being matched for results to
agree (ranges, band edges, labels, feature names, model grids).  They are
kept here, as plain data in natural order, and nowhere else.
"""
from __future__ import annotations

# --- FIXED VALUES: valid measurement ranges, inclusive (low, high) ---------
VALID_RANGES = {
    "aqi": (0, 500),
    "pm2_5": (0, 500),
    "pm10": (0, 600),
    "co": (0, 15000),
    "no2": (0, 500),
    "so2": (0, 500),
    "o3": (0, 500),
    "temperature": (-15, 45),
    "humidity": (0, 100),
    "wind_speed": (0, 150),
    "pressure": (900, 1100),
    "precipitation": (0, 200),
}

# --- FIXED VALUES: hourly columns that must be present after cleaning ------
REQUIRED_COLUMNS = ["aqi", "pm2_5", "pm10", "temperature", "humidity"]

# --- FIXED VALUES: provider variable name -> reading column ----------------
COLUMN_RENAME_MAP = {
    "carbon_monoxide": "co",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
    "relative_humidity_2m": "humidity",
    "temperature_2m": "temperature",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_direction",
    "surface_pressure": "pressure",
    "us_aqi": "aqi",
}

AQ_VARIABLES = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide",
                "sulphur_dioxide", "ozone", "us_aqi"]
WEATHER_VARIABLES = ["temperature_2m", "relative_humidity_2m", "wind_speed_10m",
                     "wind_direction_10m", "surface_pressure", "precipitation"]

def _reading(names: list) -> list:
    return [COLUMN_RENAME_MAP.get(n, n) for n in names]


# Reading columns of the two feeds, and all of them.
AQ_COLUMNS, WEATHER_COLUMNS = _reading(AQ_VARIABLES), _reading(WEATHER_VARIABLES)
MEASURES = AQ_COLUMNS + WEATHER_COLUMNS

# Prefixes of derived columns that may speak of later days: predictions of
# earlier horizons and forecasts.
DERIVED_PREFIXES = ("pred_", "fc_")

# --- FIXED VALUES: targets and the feature list used for modelling ---------
TARGETS = ["aqi_day1", "aqi_day2", "aqi_day3"]

FEATURE_COLS = [
    "aqi_mean", "aqi_max", "aqi_min", "aqi_std", "aqi_last6h",
    "pm2_5_mean", "pm10_mean",
    "temp_mean", "temp_max", "temp_min", "humidity_mean", "wind_mean", "wind_max", "pressure_mean",
    "aqi_lag1d", "aqi_lag2d", "aqi_lag3d", "aqi_lag7d", "pm2_5_lag1d", "pm2_5_lag2d",
    "aqi_roll_mean_3", "aqi_roll_mean_7",
    "aqi_trend_1d", "aqi_trend_3d", "aqi_diff", "aqi_pct_change",
    "pm2_5_diff", "pm10_diff", "temp_diff", "pressure_diff", "wind_diff", "humidity_diff",
    "aqi_std_7d",
    "month_sin", "month_cos", "dow",
    "fc_temp_d1", "fc_temp_d2", "fc_temp_d3",
    "fc_humidity_d1", "fc_humidity_d2", "fc_humidity_d3",
    "fc_wind_d1", "fc_wind_d2", "fc_wind_d3",
    "fc_pressure_d1", "fc_pressure_d2", "fc_pressure_d3",
    "fc_precip_d1", "fc_precip_d2", "fc_precip_d3",
    "fc_pressure_drop_d1",
]

# --- FIXED VALUES: AQI bands (low, high, label, background, text colour) ---
AQI_BANDS = [
    (0, 50, "Good", "#05be05", "#000000"),
    (51, 100, "Moderate", "#e5e50f", "#000000"),
    (101, 150, "Unhealthy (Sensitive)", "#f07a05", "#ffffff"),
    (151, 200, "Unhealthy", "#ed0303", "#ffffff"),
    (201, 300, "Very Unhealthy", "#802b88", "#ffffff"),
    (301, 500, "Hazardous", "#730222", "#ffffff"),
]
# Fallback returned when a value matches no band (parity mode) or exceeds 500.
AQI_FALLBACK = (301, 500, "Hazardous", "#7e0023", "#ffffff")

# --- FIXED VALUES: health advice per band label (default: Moderate) --------
HEALTH_ADVICE = {
    "Good": "Air quality is satisfactory. Enjoy outdoor activities.",
    "Moderate": "Acceptable air quality. Unusually sensitive people should limit prolonged outdoor exertion.",
    "Unhealthy (Sensitive)": "Sensitive groups (elderly, children, asthma) should reduce outdoor activity.",
    "Unhealthy": "Everyone may begin to experience health effects. Limit outdoor exertion.",
    "Very Unhealthy": "Health alert — everyone should avoid prolonged outdoor activity.",
    "Hazardous": "Health emergency. Avoid all outdoor activity. Wear N95 if must go out.",
}
HEALTH_ADVICE_DEFAULT = "Moderate"

# --- FIXED VALUES: confidence per target -----------------------------------
PREDICTION_CONFIDENCE = {"aqi_day1": "High", "aqi_day2": "Moderate", "aqi_day3": "Low"}
CONFIDENCE_DEFAULT = "Unknown"

# --- FIXED VALUES: thresholds used by evaluation views ---------------------
LARGE_ERROR_THRESHOLD = 20.0      # flag |actual - predicted| > 20
ERROR_TIER_SEVERE = 30.0          # |error| > 30 -> severe
ERROR_TIER_WARN = 15.0            # |error| > 15 -> warn
FORECAST_BAND = {2: 0.15, 3: 0.25}  # +-15 % on day 2, +-25 % on day 3
WATERFALL_OTHER_MIN = 0.01        # remainder row only when |sum| > 0.01

# --- FIXED VALUES: output texts of explanations ------------------------------
WATERFALL_OTHER_NAME = "other features"
PHRASE_UP = "pushed the forecast up by"
PHRASE_DOWN = "reduced it by"
PHRASE_FORMAT = "%s %s %.1f AQI points"
INSIGHT_UNAVAILABLE = "SHAP explanation unavailable for this model."
INSIGHT_NO_FEATURE = "No dominant features identified."

# --- FIXED VALUES: model selection ------------------------------------------
MIN_TRAIN_ROWS = 50
TEST_RATIO = 0.2
CV_SPLITS = 3
RIDGE_ALPHA = 10.0
RETAIN_VERSIONS = 2
RANDOM_SEED = 42

# Candidate grids (family -> list of points).  Spark ML names; the boosted
# families map iterations/depth/step; forests map trees/depth/leaf size.
MODEL_GRIDS = {
    "xgboost_role": [
        {"maxIter": 100, "maxDepth": 3, "stepSize": 0.05, "subsamplingRate": 0.8},
        {"maxIter": 200, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.8},
        {"maxIter": 200, "maxDepth": 3, "stepSize": 0.03, "subsamplingRate": 0.9},
        {"maxIter": 100, "maxDepth": 3, "stepSize": 0.10, "subsamplingRate": 0.8},
    ],
    "random_forest": [
        {"numTrees": 200, "maxDepth": 6, "minInstancesPerNode": 8, "featureSubsetStrategy": "0.7"},
        {"numTrees": 300, "maxDepth": 8, "minInstancesPerNode": 6, "featureSubsetStrategy": "0.7"},
        {"numTrees": 200, "maxDepth": 6, "minInstancesPerNode": 10, "featureSubsetStrategy": "0.8"},
        {"numTrees": 300, "maxDepth": 5, "minInstancesPerNode": 8, "featureSubsetStrategy": "0.6"},
    ],
    "gradient_boosting": [
        {"maxIter": 100, "stepSize": 0.05, "maxDepth": 3},
        {"maxIter": 200, "stepSize": 0.03, "maxDepth": 3},
        {"maxIter": 100, "stepSize": 0.10, "maxDepth": 3},
        {"maxIter": 200, "stepSize": 0.05, "maxDepth": 4},
    ],
    "lightgbm_role": [
        {"maxIter": 100, "stepSize": 0.05, "maxDepth": 4},
        {"maxIter": 200, "stepSize": 0.03, "maxDepth": 5},
        {"maxIter": 100, "stepSize": 0.10, "maxDepth": 3},
        {"maxIter": 200, "stepSize": 0.05, "maxDepth": 5},
    ],
    "ridge": [{"alpha": 10.0}],
}
