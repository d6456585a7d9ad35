"""Constants that define the semantics.

FIXED VALUES — these must equal the behaviour being reproduced; they are
listed plainly, in their natural order, in one place.
"""

from __future__ import annotations

# FIXED VALUES: window geometry and the default binary alert threshold.
WINDOW = 20          # readings per window
HORIZON = 10         # future readings a label looks at
ALERT_THRESHOLD = 0.5

# FIXED VALUES: the eight sensor channels of the inference contract, in order.
SENSOR_COLUMNS = [
    "Accelerometer1RMS",
    "Accelerometer2RMS",
    "Current",
    "Pressure",
    "Temperature",
    "Thermocouple",
    "Voltage",
    "Volume Flow RateRMS",
]
TIME_COLUMN = "datetime"
LABEL_COLUMN = "anomaly"
EXCLUDED_COLUMNS = ["datetime", "anomaly", "changepoint"]
TIME_NAME_HINTS = ["timestamp", "time", "date", "datetime"]

# FIXED VALUES: alert ladder. Lower bound of each state, in ladder order.
STATES = ["NORMAL", "WATCH", "WARNING", "ALERT"]
BAND_LOWER = [0.0, 0.3, 0.5, 0.8]
PROMOTION_STREAK_WARNING = 3
DEMOTION_STREAK = 3

# FIXED VALUES: live data-quality rules.
FROZEN_LOOKBACK = 30          # equal consecutive readings to call a channel frozen
INTERVAL_LOOKBACK = 20        # positive inter-arrival intervals kept
UNEVEN_STD_THRESHOLD = 0.5    # seconds, population std of those intervals
HISTORY_CAP = 600             # live samples kept
LIVE_PROB_RING = 20           # probabilities kept for the state machine
STALE_AFTER_SECONDS = 5.0     # no tick for longer than this is a stale stream

# FIXED VALUES: per-channel sanity range (lo, hi), bounds allowed.
SANITY_RANGES = {
    "Accelerometer1RMS": (-1.0, 10.0),
    "Accelerometer2RMS": (-1.0, 10.0),
    "Current": (-10.0, 100.0),
    "Pressure": (-10.0, 10.0),
    "Temperature": (-50.0, 200.0),
    "Thermocouple": (-50.0, 200.0),
    "Voltage": (0.0, 500.0),
    "Volume Flow RateRMS": (-10.0, 500.0),
}

# FIXED VALUES: sampling-profile warnings.
MEDIAN_INTERVAL_TOLERANCE = 0.3   # |median - 1 s| above this warns
INTERVAL_STD_WARN = 0.5           # sample std above this warns
GAP_SECONDS = 2.0                 # an interval above this is a gap

# FIXED VALUES: report risk rules and z-score guard.
RISK_HIGH_FAULT_SHARE = 0.10
RISK_HIGH_PEAK = 0.8
RISK_LOW_PEAK = 0.5
Z_EPSILON = 1e-9
TOP_RUNS = 3
NEIGHBOURHOOD_ROWS = 30

# FIXED VALUES: upload gate.
MAX_UPLOAD_MB = 50

# FIXED VALUES: threshold search grid, 0.45 to 0.75 step 0.01 (31 values).
GRID_START = 0.45
GRID_STEP = 0.01
GRID_COUNT = 31

# FIXED VALUES: the tokens pandas reads as missing by default (a cell holding
# one of these is "blank", not "non-numeric").
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# FIXED VALUES: the model registry — id, name, family, is_dl, recall,
# precision, f1, requires_scaling.
MODEL_REGISTRY = [
    ("xgb", "XGBoost", "Ensemble", False, 0.8049, 0.9944, 0.8897, False),
    ("rf", "Random Forest", "Tree", False, 0.8429, 0.8635, 0.8530, False),
    ("et", "Extra Trees", "Tree", False, 0.7669, 0.8989, 0.8277, False),
    ("gb", "Gradient Boosting", "Boosting", False, 0.8397, 0.8811, 0.8599, False),
    ("lr", "Logistic Regression", "Linear", False, 0.8455, 0.9755, 0.9058, True),
    ("knn", "KNN", "Instance", False, 0.5544, 0.8768, 0.6793, True),
    ("svm", "SVM", "Kernel", False, 0.3690, 0.9409, 0.5301, True),
    ("transformer", "TransformerFusionLite", "Deep Learning", True,
     0.8822, 0.9709, 0.9244, False),
]
DEFAULT_LIVE_MODEL = "transformer"
FALLBACK_LIVE_MODEL = "xgb"

# FIXED VALUES: the split plan, (folder, file) per split.
SPLIT_PLAN = (
    [("train", "valve1", f"{k}.csv") for k in range(12)]
    + [("val", "valve1", f"{k}.csv") for k in range(12, 16)]
    + [("test", "valve2", f"{k}.csv") for k in range(4)]
)

# FIXED VALUES: the hyper-parameter sweep of the sequence classifier. Main
# grid: 2 layers x d_model x heads x feed-forward x dropout (48 configs); extra
# grid: 2 layers, d_model 64, heads x feed-forward, dropout 0.10 (6 configs).
SWEEP_MAIN_LAYERS = 2
SWEEP_MAIN_D_MODEL = [32, 48]
SWEEP_MAIN_HEADS = [4, 8]
SWEEP_MAIN_FF = [64, 96, 128]
SWEEP_MAIN_DROPOUT = [0.03, 0.08, 0.12, 0.18]
SWEEP_EXTRA_D_MODEL = 64
SWEEP_EXTRA_HEADS = [4, 8]
SWEEP_EXTRA_FF = [96, 128, 160]
SWEEP_EXTRA_DROPOUT = 0.10

# Hot-series handling: positions per window chunk (a series longer than this
# is split into halo chunks, so no task holds a whole series) and the time
# bucket for numbering positions.
SERIES_CHUNK_ROWS = 1_000_000
INDEX_BUCKET = "hour"
