"""Fixed schemas of the message payloads and files.

Fixed values: these field names and types must equal the producer's.
"""

from pyspark.sql import types as T

# Event message (one shop event): fixed field list.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_price", T.LongType()),
        T.StructField("uid", T.StringType()),
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds
    ]
)

# Event files split by type and day carry the day key as well.
VISIT_FILE_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [T.StructField("date", T.StringType())])

VISIT_STRUCT = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds
    ]
)

# Web log line: one user (possibly on several lines) with nested visits.
WEBLOG_SCHEMA = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("visits", T.ArrayType(VISIT_STRUCT)),
    ]
)

# Web log lines split by day (batch scoring input).
DATED_WEBLOG_SCHEMA = T.StructType(WEBLOG_SCHEMA.fields + [T.StructField("date", T.StringType())])

# Labelled web log (training input).
LABELLED_WEBLOG_SCHEMA = T.StructType(WEBLOG_SCHEMA.fields + [T.StructField("gender_age", T.StringType())])

# Stepped counter stream rows.
COUNTER_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("foo", T.StringType())]
)
