"""Fixed schemas and constants of the content/labor data model.

Fixed values (must equal the reference for equal results):
  required columns: content_id, title, category, department, labor_hours, region
  labor flag thresholds: HIGH when labor_hours > 100, MEDIUM when > 50, else LOW
  silver metadata: pipeline_layer 'silver', pipeline_version '1.0.0'
  warning texts: "{n} duplicate content_id(s) found",
                 "{n} row(s) with invalid labor_hours (<= 0)"
  labor flag set: HIGH, MEDIUM, LOW
  API page size 100
"""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED_COLUMNS = ["content_id", "title", "category", "department", "labor_hours", "region"]
CRITICAL_COLUMNS = ["content_id", "department"]

HIGH_THRESHOLD = 100
MEDIUM_THRESHOLD = 50
LABOR_FLAGS = ["HIGH", "MEDIUM", "LOW"]

PIPELINE_LAYER = "silver"
PIPELINE_VERSION = "1.0.0"

DUPLICATE_WARNING = "{n} duplicate content_id(s) found"
INVALID_LABOR_WARNING = "{n} row(s) with invalid labor_hours (<= 0)"

API_PAGE_SIZE = 100

# Characters Python's str.strip() removes in ASCII text (Spark's trim removes spaces only).
WHITESPACE = " \t\n\r\x0b\x0c"

# Raw content event as it arrives on the topic (timestamp still an ISO-8601 string).
CONTENT_SCHEMA = T.StructType([
    T.StructField("content_id", T.StringType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("department", T.StringType(), True),
    T.StructField("labor_hours", T.IntegerType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
])

# Same event as JSON message payload, all text: ``conform_content`` gives the fixed types, so hours that
# are no whole number stay visible instead of failing or voiding the message.
MESSAGE_SCHEMA = T.StructType([T.StructField(f.name, T.StringType(), True) for f in CONTENT_SCHEMA.fields])

# Text of labor_hours values that are no whole number (rule labor_hours_type).
HOURS_TEXT = "labor_hours_text"
UNPARSED_HOURS_WARNING = "{n} row(s) with labor_hours that is no whole number"

# Mark of file rows whose bytes are no UTF-8 (rule utf8_text).
BAD_ENCODING = "bad_encoding"
# Columns that only the table rules look at.
RULE_COLUMNS = [HOURS_TEXT, BAD_ENCODING]

# silver.content_events_clean: the canonical 12-column silver.
SILVER_COLUMNS = [
    "content_id", "title", "category", "region", "department", "labor_hours", "labor_flag",
    "event_type", "event_timestamp", "pipeline_layer", "pipeline_version", "processed_at",
]

# One labor-log record of the scheduling API (silver.labor_logs without the key).
LABOR_RECORD_SCHEMA = T.StructType([
    T.StructField("employee_id", T.StringType(), True),
    T.StructField("department", T.StringType(), True),
    T.StructField("project_id", T.StringType(), True),
    T.StructField("hours_logged", T.DoubleType(), True),
    T.StructField("week", T.StringType(), True),
    T.StructField("role", T.StringType(), True),
])

# One landed API response page.
LABOR_PAGE_SCHEMA = T.StructType([
    T.StructField("page", T.IntegerType(), True),
    T.StructField("results", T.ArrayType(LABOR_RECORD_SCHEMA), True),
    T.StructField("next", T.StringType(), True),
])

RUN_EVENT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("pipeline", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("stage", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("seconds", T.DoubleType(), True),
    T.StructField("message", T.StringType(), True),
])
