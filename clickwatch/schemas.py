"""Declared schemas of every stage; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(10,3)": T.DecimalType(10, 3),
    "DECIMAL(10,4)": T.DecimalType(10, 4),
    "DECIMAL(10,6)": T.DecimalType(10, 6),
}


def struct(spec: str) -> T.StructType:
    """`"name TYPE, name TYPE"` as a schema, without needing a session."""
    fields = [part.split() for part in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Wire format of one click event. Numbers are read as DOUBLE so that 1 and 1.0
# are the same conversion flag; the rules decide what is acceptable.
CLICK_EVENT = struct(
    "timestamp STRING, user_id_hash STRING, ad_id STRING, campaign_id STRING, geo STRING, "
    "platform STRING, user_agent STRING, CPC DOUBLE, CTR DOUBLE, conversion DOUBLE, bounce_rate DOUBLE"
)

# The five fields the window job reads; the others are not even parsed.
WINDOW_EVENT = struct("timestamp STRING, geo STRING, platform STRING, CTR DOUBLE, bounce_rate DOUBLE")

CLICKSTREAM_TABLE = struct(
    "timestamp TIMESTAMP, user_id_hash STRING, ad_id STRING, campaign_id STRING, geo STRING, "
    "platform STRING, user_agent STRING, cpc DECIMAL(10,3), ctr DECIMAL(10,4), conversion INT, "
    "bounce_rate DECIMAL(10,3)"
)

# Wire format of one feature window; event_count as DOUBLE for the strict rules
# (3.0 is a count), as LONG for the lenient ones (3.0 is not an integer).
FEATURE_MESSAGE = struct(
    "window_start STRING, window_end STRING, geo STRING, platform STRING, "
    "ctr_avg DOUBLE, bounce_rate_avg DOUBLE, event_count DOUBLE"
)
LENIENT_FEATURE_MESSAGE = struct(
    "window_start STRING, window_end STRING, geo STRING, platform STRING, "
    "ctr_avg DOUBLE, bounce_rate_avg DOUBLE, event_count BIGINT"
)

FEATURE = struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, geo STRING, platform STRING, "
    "ctr_avg DOUBLE, bounce_rate_avg DOUBLE, event_count BIGINT"
)

OFFLINE_FEATURE = struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, geo STRING, platform STRING, "
    "avg_ctr DOUBLE, avg_bounce_rate DOUBLE, event_count BIGINT, ingest_date DATE"
)

ONLINE_FEATURE = struct(
    "geo STRING, platform STRING, event_timestamp TIMESTAMP, "
    "ctr_avg FLOAT, bounce_rate_avg FLOAT, event_count BIGINT"
)

ANOMALY_RESULT = struct(
    "timestamp TIMESTAMP, geo STRING, platform STRING, anomaly_score DECIMAL(10,6), "
    "anomaly_type STRING, is_anomaly BOOLEAN, details STRING"
)

FOREST_NODE = struct(
    "tree_id INT, node_id INT, feature INT, threshold DOUBLE, left INT, right INT, "
    "size INT, path_length DOUBLE"
)

# What goes with a node table.
MODEL_DOCUMENT = T.StructType(
    [
        T.StructField("mean", T.ArrayType(T.DoubleType())),
        T.StructField("scale", T.ArrayType(T.DoubleType())),
        T.StructField("cnt_cap", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("train_size", T.LongType()),
        T.StructField("total_size", T.LongType()),
    ]
)
METRICS_DOCUMENT = struct("precision DOUBLE, recall DOUBLE, f1 DOUBLE, roc_auc DOUBLE")


class MissingColumnsError(ValueError):
    """Raised at plan time when an input lacks required columns."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnsError(f"Missing required columns: {missing}")
    return df
