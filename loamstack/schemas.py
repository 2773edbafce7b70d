"""Schemas and enumerated domains of the central tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERACTION = (
    "id string, timestamp timestamp, source_type string, source_id string, source_file string, user_input string, assistant_output string, system_context string, "
    "conversation_id string, turn_number int, previous_turns array<struct<user:string,assistant:string>>, outcome string, confidence double, quality_score double, "
    "is_correction boolean, correction_original string, correction_improved string, correction_reason string, properties string, tags array<string>, user_id string, "
    "session_id string, auth_confidence double, environment string, processed boolean, formatted boolean, distilled boolean, _src_order bigint, _line_no bigint"
)
EXAMPLE = (
    "format_type string, messages array<struct<role:string,content:string>>, instruction string, input_text string, output_text string, prompt string, chosen string, rejected string, "
    "quality_score double, source_id string, source_type string, estimated_tokens bigint, is_correction boolean, is_synthetic boolean"
)
TELEMETRY = "event_id string, event_type string, timestamp string, session_id string, user_id string, tags array<string>, properties map<string,string>, metrics map<string,double>"
METRIC = "name string, value double, metric_type string, timestamp double, labels map<string,string>, unit string"
USAGE = "timestamp timestamp, model string, input_tokens bigint, output_tokens bigint, cost double, operation string"

#: The domains of string columns.
DOMAINS = {
    "source_type": ("telemetry", "feedback", "auth_record", "raw_log", "state_file", "manual", "synthetic"),
    "outcome": ("success", "failure", "partial", "engaged", "dismissed", "deferred", "negative_feedback", "positive_feedback", "challenged", "unknown"),
    "format_type": ("chatml", "alpaca", "preference", "raw"),
    "metric_type": ("counter", "gauge", "histogram", "summary", "timer"),
    "health_status": ("healthy", "degraded", "unhealthy", "unknown"),
    "drift_severity": ("none", "low", "medium", "high", "critical"),
    "approval_status": ("approved", "rejected", "pending_review", "expired"),
}


def checked(column: Column, domain: str, default: str | None = None) -> Column:
    """The value if it is of the domain, else the default (null by default)."""
    return F.when(column.isin(*DOMAINS[domain]), column).otherwise(F.lit(default))


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the schema's columns: missing ones null, others dropped, types cast."""
    spark = df.sparkSession
    fields = spark.createDataFrame([], ddl).schema.fields
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
