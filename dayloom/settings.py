"""Default parameters. They must agree with the published protocol."""

# Forecasting and backtest protocol.
HORIZON = 14
STEP = 7
EVAL_DAYS = 90
HOLDOUT_DAYS = 30
CV_SPLITS = 5
SEASON = 7
UNIT_SCALE = 1_000_000
BLEND_WEIGHT = 0.5

# Feature definitions.
LAGS = (1, 2, 3, 7, 14)
MEAN_WINDOW = 14
STD_WINDOW = 7
EXOG = ("temp", "precip", "snow_lag1", "is_holiday")

# Monitoring.
PSI_BUCKETS = 10
PSI_EPS = 1e-8
PSI_MODERATE = 0.1
PSI_CRITICAL = 0.25
REFERENCE_DAYS = 90
RECENT_DAYS = 14
RETRAIN_MULTIPLIER = 1.5
COOLDOWN_DAYS = 7
TRIGGER_HISTORY = 50
LIVE_SNAPSHOTS = 8
EVENT_SNAPSHOTS = 4

# Order search cache.
ORDER_TTL_DAYS = 90

# Ingestion.
PUBLISH_LAG_DAYS = 6
FEED_START = "2022-01-01"
FEED_BOUNDARY = "2024-12-31"
NO_DATE = "1900-01-01"

# Boosted trees.
TREES = 500
TREE_DEPTH = 5
TREE_RATE = 0.05
TREE_SUBSAMPLE = 0.8
TREE_SEED = 42
TREE_PATIENCE = 50

# Significance.
N_BOOT = 10_000
WEIGHT_STEP = 0.05
