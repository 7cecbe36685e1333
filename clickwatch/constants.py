"""They have to be equal everywhere for results to agree."""

# --- fixed values: data contract -------------------------------------------
PLATFORMS = ("web", "ios", "android")
USER_ID_HASH_PATTERN = r"^[0-9a-f]{16,64}$"
AD_ID_PATTERN = r"^ad_\p{Nd}+$"
CAMPAIGN_ID_PATTERN = r"^camp_\p{Nd}+$"
GEO_PATTERN = r"^[A-Z]{2}$"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TOPIC_EVENTS = "clickstream"
TOPIC_FEATURES = "features"
TOPIC_ALERTS = "alerts"

# --- fixed values: windows and streams ---------------------------------------
WINDOW_SIZE = "5 minutes"
WINDOW_SLIDE = "1 minute"
WATERMARK_DELAY = "30 seconds"
CHECKPOINT_INTERVAL = "60 seconds"
LAKE_BATCH_ROWS = 100
LAKE_FILE_ROWS = 1_000_000
LAKE_BATCH_INTERVAL = "60 seconds"
LAKE_BATCH_SECONDS = 60
ONLINE_TTL = "3 days"
ONLINE_TTL_SECONDS = 259_200
CTR_DIGITS = 4
BOUNCE_DIGITS = 3

# --- fixed values: dataset and model ------------------------------------------
FEATURES_USED = ("ctr_avg", "bounce_rate_avg", "event_count")
TRAIN_RATIO = 0.8
COUNT_CAP_QUANTILE = 0.999
COUNT_CAP_FLOOR = 1000.0
FOREST_TREES = 200
FOREST_MAX_SAMPLES = 256
FOREST_SEED = 42
CONTAMINATION = 0.02
ALERT_QUANTILE = 0.98
EULER_GAMMA = 0.5772156649015329

# --- fixed values: published serving parameters ---------------------------------
SERVING_MEAN = (0.02743531716661457, 0.5497891044214874, 0.6983735047458454)
SERVING_SCALE = (0.01297431211912943, 0.2016419255378515, 0.04609400413805911)
SERVING_COUNT_CAP = 1000.0
SERVING_THRESHOLD = 0.6083476901480174

# --- fixed values: labelled anomalies -----------------------------------------
INJECTION_RATE = 0.02
INJECTION_KINDS = ("ctr_spike", "bounce_spike", "volume_spike", "mixed")
CTR_SPIKE_FACTOR = (1.05, 1.15)
BOUNCE_SPIKE_SHIFT = (0.02, 0.05)
VOLUME_SPIKE_FACTOR = (1.1, 1.3)
MIXED_CTR_FACTOR = (0.95, 1.08)
MIXED_BOUNCE_SHIFT = (0.01, 0.04)
MIXED_VOLUME_FACTOR = (1.05, 1.25)
JITTER_STD = 0.001
RANDOM_LABEL_MAX_AUC = 0.6

CPC_LIMIT = 9_999_999.9995  # rounds into DECIMAL(10,3) below

# --- fixed values: monitoring ---------------------------------------------------
SCORE_BUCKETS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.5, 2.0, 3.0, 5.0, 10.0)
LATENCY_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
RATE_WINDOW = "5 minutes"
RATE_WINDOW_SECONDS = 300
