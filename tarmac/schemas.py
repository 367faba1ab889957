"""Declared schemas.  Nothing is inferred: every reader passes one of these.

Fixed values throughout: field names, types and order, the vector slots and the required fields must
equal those of the records that other programs write and read.
"""

from pyspark.sql import types as T

# Flight history records, in file order.
FLIGHT_SCHEMA = T.StructType([
    T.StructField("ArrDelay", T.DoubleType()),
    T.StructField("CRSDepTime", T.TimestampType()),
    T.StructField("CRSArrTime", T.TimestampType()),
    T.StructField("Carrier", T.StringType()),
    T.StructField("DayOfMonth", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayOfYear", T.IntegerType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Origin", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("FlightDate", T.DateType()),
])

# Origin/destination distance dimension; key (Origin, Dest).
DISTANCE_SCHEMA = T.StructType([
    T.StructField("Origin", T.StringType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
])

# Prediction request message; model_ids is a JSON list carried as text.
REQUEST_SCHEMA = T.StructType([
    T.StructField("Origin", T.StringType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayOfYear", T.IntegerType()),
    T.StructField("DayOfMonth", T.IntegerType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Timestamp", T.TimestampType()),
    T.StructField("FlightDate", T.DateType()),
    T.StructField("Carrier", T.StringType()),
    T.StructField("UUID", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("model_ids", T.StringType()),
])

# Fields of a response message, in output order.
RESPONSE_FIELDS = ["UUID", "model_id", "Origin", "Dest", "Carrier", "FlightDate", "FlightNum",
                   "DepDelay", "Distance", "Route", "DayOfYear", "DayOfMonth", "DayOfWeek",
                   "Prediction", "Timestamp"]

# Response message as read back by the consumer (all optional).
RESPONSE_SCHEMA = T.StructType([
    T.StructField("UUID", T.StringType()),
    T.StructField("model_id", T.StringType()),
    T.StructField("Origin", T.StringType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Carrier", T.StringType()),
    T.StructField("FlightDate", T.StringType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("Route", T.StringType()),
    T.StructField("DayOfYear", T.DoubleType()),
    T.StructField("DayOfMonth", T.DoubleType()),
    T.StructField("DayOfWeek", T.DoubleType()),
    T.StructField("Prediction", T.DoubleType()),
    T.StructField("Timestamp", T.StringType()),
])

# Stored prediction row, keyed by uuid.
STORED_RESPONSE_SCHEMA = T.StructType([
    T.StructField("uuid", T.StringType(), False),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("model_id", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("dep_delay", T.DoubleType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("flight_date", T.StringType()),
    T.StructField("flight_num", T.StringType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("route", T.StringType()),
    T.StructField("day_of_year", T.IntegerType()),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
])

# Training metric record written next to each model.
METRIC_SCHEMA = T.StructType([
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("num_trees", T.IntegerType()),
    T.StructField("max_depth", T.IntegerType()),
    T.StructField("training_duration_seconds", T.LongType()),
    T.StructField("run_name", T.StringType()),
])

_KV_STR = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                    T.StructField("value", T.StringType())]))
_KV_DBL = T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                    T.StructField("value", T.DoubleType())]))

# Tracked training run: params / metrics / tags as ordered key-value lists.
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.LongType()),
    T.StructField("lifecycle_stage", T.StringType()),
    T.StructField("params", _KV_STR),
    T.StructField("metrics", _KV_DBL),
    T.StructField("tags", _KV_STR),
])

# Model registry entry per run.
REGISTRY_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("stage", T.StringType()),
])

# Object-store listing of model artifacts.
ARTIFACT_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("last_modified", T.TimestampType()),
])

# Activation log behind the active model set.
ACTIVATION_SCHEMA = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

# Feature vector slots, order fixed.
NUMERIC_FEATURES = ["DepDelay", "Distance", "DayOfMonth", "DayOfWeek", "DayOfYear"]
CATEGORICAL_FEATURES = ["Carrier", "Origin", "Dest", "Route"]
INDEX_FEATURES = [c + "_index" for c in CATEGORICAL_FEATURES]
VECTOR_SLOTS = NUMERIC_FEATURES + INDEX_FEATURES

# Requests must carry these before they are scored.
REQUIRED_REQUEST_FIELDS = ["UUID", "Origin", "Dest", "Carrier", "Route", "FlightNum"]
