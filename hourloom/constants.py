"""Numbers, ids and names that results depend on.

Nothing here is logic.  Every operator takes these as defaults and lets the caller pass others.
"""

# --- fixed values: the six city pollutants, output column -> parameter id ---------------------
PARAMETER_COLUMNS = {
    "pm25_ugm3": "2",
    "pm10_ugm3": "1",
    "no2_ppm": "7",
    "o3_ppm": "10",
    "so2_ppm": "9",
    "co_ppm": "8",
}

# --- fixed values: time bounds ----------------------------------------------------------------
CITY_START = "2024-04-30 15:00:00"   # first hour kept by the city cleaning and by the grid
SPINE_START = "2024-01-01 00:00:00"  # first hour of the generated time spine
EPOCH_WATERMARK = "1900-01-01 00:00:00"  # watermark of a target that holds nothing recent

# --- fixed values: cleaning, segmentation and report thresholds -------------------------------
VALUE_LOW, VALUE_HIGH = 0.0, 10000.0     # valid readings are low <= value < high
PERFECT_SENSORS = 6                      # concurrent readings that make an hour "perfect"
MAX_GAP_HOURS = 4                        # longest distance bridged between perfect hours
MAX_SERIES_GAP_HOURS = 3                 # the same, for the per-series segmentation
GOLD_HOURS, SILVER_HOURS = 24 * 14, 24 * 7
TOP_PARAMETERS = 6
COVERAGE_THRESHOLD = 0.9
DENSITY_THRESHOLD = 0.9
DENSITY_BANDS = (0.9, 0.8)
DURATION_STEPS = (48, 72, 168, 336)
HISTOGRAM_BINS = 20
AVERAGE_RANK_LIMIT = 20
GAP_RANGE_HOURS = (6, 10000)
SOURCE_LOOKBACK_DAYS = 15
TARGET_LOOKBACK_DAYS = 15
ENRICHED_TARGET_LOOKBACK_DAYS = 10
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 24, 72

# --- fixed values: names ----------------------------------------------------------------------
AUDIT_COLUMNS = ("ingested_at", "updated_at", "refreshed_at")

WEATHER_METRICS = (
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
    "precipitation", "rain", "snowfall", "snow_depth", "shortwave_radiation",
    "direct_radiation", "diffuse_radiation", "global_tilted_irradiance",
    "direct_normal_irradiance", "terrestrial_radiation", "weather_code", "pressure_msl",
    "surface_pressure", "cloud_cover", "cloud_cover_low", "cloud_cover_mid",
    "cloud_cover_high", "vapour_pressure_deficit", "et0_fao_evapotranspiration",
    "wind_speed_100m", "wind_speed_10m", "wind_direction_10m", "wind_direction_100m",
    "wind_gusts_10m", "is_day",
)

# --- fixed values: sensors banned from loading, and locations held out for testing ------------
EXCLUDED_SENSORS = (
    "9593", "4275130", "9680", "5620", "5588", "9542", "9539", "9643", "9736", "9610", "9716",
    "9609", "9590", "9589", "9625", "4661655", "9614", "9637", "9863", "15298", "9647", "9646",
    "9652", "9671", "9672", "9693", "9729", "9747", "9778", "9777", "9779", "9782", "9850",
    "9851", "9860", "9861", "7773042", "7773850", "7773420", "7775825", "10124847", "10124849",
    "10124824", "10124825", "9577", "9864", "9655", "9662", "9663",
)
TEST_LOCATIONS = (
    "2622837", "2623116", "2623504", "2623643", "2622918", "2623277", "2623465", "2623532",
    "2622689", "2622825", "2623557", "2623394", "2623718", "2623617",
)
