"""Source records to interactions, and the filters on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import probing as P
from ..functions import scores as S
from ..schemas import INTERACTION, conform

#: What each telemetry event says of the interaction.
EVENT_OUTCOMES = {
    "success": ("INTENT_DETECTED", "ROUTE_MATCHED", "VISION_ANALYSIS_COMPLETED", "SEMANTIC_MATCH_FOUND", "FOLLOWUP_RESOLVED", "CONTEXT_CREATED"),
    "failure": ("INTENT_CLASSIFICATION_FAILED", "ROUTE_FAILED", "ROUTE_NO_MATCH", "SEMANTIC_MATCH_NONE", "FOLLOWUP_CONTEXT_MISSING", "ERROR_OCCURRED"),
    "partial": ("CONTEXT_ACCESSED", "CONTEXT_CONSUMED", "CONTEXT_EXPIRED", "VISION_SNAPSHOT_TAKEN", "VISION_OCR_EXECUTED", "FOLLOWUP_INITIATED", "LATENCY_RECORDED"),
}
#: Events that are kept without any text.
TEXTLESS_EVENTS = ("ERROR_OCCURRED", "INTENT_DETECTED")
INPUT_KEYS = ("user_input", "input", "query", "command", "text", "message", "intent")
OUTPUT_KEYS = ("output", "response", "result", "assistant_output", "reply")
CONTEXT_KEYS = ("context", "system_context", "background", "state")
ENVIRONMENT_KEYS = ("environment", "env", "device", "location", "network")
FEEDBACK_INPUT_KEYS = ("user_input", "input", "query", "command", "original_request")
FEEDBACK_OUTPUT_KEYS = ("output", "response", "assistant_response")
CORRECTION_KEYS = ("correction", "expected", "wanted", "correct_response", "user_correction", "feedback_text", "improved_response")
REASON_KEYS = ("reason", "correction_reason", "why_wrong", "feedback_reason", "notes")
#: Tags of each notification pattern.
PATTERN_TAGS = {
    "TERMINAL_ERROR": ("error", "terminal"), "TERMINAL_COMPLETION": ("success", "terminal"), "TERMINAL_WARNING": ("warning", "terminal"), "BROWSER_UPDATE": ("browser", "update"),
    "CODE_DIAGNOSTIC": ("code", "diagnostic"), "WORKFLOW_SUGGESTION": ("workflow", "suggestion"), "RESOURCE_WARNING": ("resource", "warning"), "SECURITY_ALERT": ("security", "alert"), "OTHER": ("other",),
}


def event_outcome(event_type: Column) -> Column:
    out = F.lit("unknown")
    for outcome, names in EVENT_OUTCOMES.items():
        out = F.when(event_type.isin(*names), outcome).otherwise(out)
    return out


def with_quality(df: DataFrame) -> DataFrame:
    """Derived columns that an interaction has from the start."""
    return df.withColumn("quality_score", S.interaction_quality(F.col("confidence"), F.col("outcome"), F.col("is_correction"), F.col("user_input"), F.col("assistant_output")))


def from_telemetry(events: DataFrame, include_partial: bool = False) -> DataFrame:
    """Telemetry events (``properties`` and ``metrics`` as JSON text) as interactions."""
    p, m = F.col("properties"), F.col("metrics")
    metric = P.first_number(m, ("confidence", "score", "probability", "certainty"))
    prop = P.first_number(p, ("confidence", "score", "probability"))
    raw = F.when(F.coalesce(metric, F.lit(0.5)) == 0.5, F.coalesce(prop, F.lit(0.5))).otherwise(metric)
    rows = events.withColumns({
        "outcome": event_outcome(F.col("event_type")), "user_input": P.first_text(p, INPUT_KEYS), "assistant_output": P.first_text(p, OUTPUT_KEYS),
    })
    if not include_partial:
        rows = rows.where("outcome <> 'partial'")
    rows = rows.where(F.col("user_input").isNotNull() | F.col("assistant_output").isNotNull() | F.col("event_type").isin(*TEXTLESS_EVENTS))
    rows = rows.withColumns({
        "timestamp": P.iso_timestamp(F.col("timestamp")), "source_type": F.lit("telemetry"), "source_id": F.coalesce("event_id", F.lit("")), "system_context": P.joined_context(p, CONTEXT_KEYS),
        "confidence": S.unit_confidence(raw), "is_correction": F.lit(False), "environment": P.kept_keys(p, ENVIRONMENT_KEYS),
        "tags": F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.array(F.concat(F.lit("event:"), "event_type"))),
    })
    return conform(with_quality(rows), INTERACTION)


def from_feedback(events: DataFrame, include_dismissed: bool = True, include_deferred: bool = False) -> DataFrame:
    """Notification feedback (``context`` as JSON text) as interactions."""
    c, outcome = F.col("context"), F.when(F.col("response").isin("ENGAGED", "DISMISSED", "DEFERRED", "NEGATIVE_FEEDBACK"), F.lower("response")).otherwise("unknown")
    pattern = F.coalesce("pattern", F.lit("OTHER"))
    tags = F.array().cast("array<string>")
    for name, values in PATTERN_TAGS.items():
        tags = F.when(pattern == name, F.array(*map(F.lit, values))).otherwise(tags)
    rows = events.withColumn("outcome", outcome)
    dropped = ([] if include_dismissed else ["dismissed"]) + ([] if include_deferred else ["deferred"])
    if dropped:
        rows = rows.where(~F.col("outcome").isin(*dropped))
    rows = rows.withColumns({
        "user_input": P.first_text(c, FEEDBACK_INPUT_KEYS), "assistant_output": F.coalesce(F.when(F.col("notification_text") != "", F.col("notification_text")), P.first_text(c, FEEDBACK_OUTPUT_KEYS)),
        "is_correction": F.col("outcome") == "negative_feedback", "confidence": S.feedback_confidence(F.col("time_to_respond"), F.col("outcome")),
        "timestamp": P.iso_timestamp(F.col("timestamp")), "source_type": F.lit("feedback"), "source_id": F.coalesce("id", "event_id", F.lit("")),
        "system_context": P.joined_context(c, ("system_state", "environment", "active_context"), named=True), "properties": c,
        "tags": F.concat(tags, F.array(F.concat(F.lit("response:"), F.coalesce("response", F.lit(""))))),
    })
    rows = rows.withColumns({
        "correction_original": F.when(F.col("is_correction"), F.col("assistant_output")), "correction_improved": F.when(F.col("is_correction"), P.first_text(c, CORRECTION_KEYS)),
        "correction_reason": F.when(F.col("is_correction"), P.first_text(c, REASON_KEYS)),
    })
    return conform(with_quality(rows), INTERACTION)


def from_auth(records: DataFrame) -> DataFrame:
    """Authentication records as interactions."""
    o, d = F.coalesce("outcome", F.lit("")), F.coalesce("decision", F.lit(""))
    spoken = F.coalesce(F.when(F.col("command") != "", F.col("command")), F.when(F.col("intent") != "", F.col("intent")), F.concat(F.lit("Authentication attempt: "), o))
    rows = records.select(
        F.when((o == "SUCCESS") | (d == "authenticate"), "success").when((o == "FAILURE") | (d == "deny"), "failure").when((o == "CHALLENGED") | (d == "challenge"), "challenged").otherwise("unknown").alias("outcome"),
        F.coalesce("voice_confidence", "final_confidence", F.lit(0.5)).alias("confidence"), spoken.alias("user_input"),
        F.when(F.size("reasoning") > 0, F.array_join("reasoning", "\n")).otherwise(F.concat(F.lit("Decision: "), d)).alias("assistant_output"),
        P.iso_timestamp(F.col("timestamp")).alias("timestamp"), F.lit("auth_record").alias("source_type"), F.coalesce("id", F.lit("")).alias("source_id"), "user_id",
        F.col("voice_confidence").alias("auth_confidence"), F.array(F.lit("auth"), F.concat(F.lit("decision:"), d)).alias("tags"), F.lit(False).alias("is_correction"),
    )
    return conform(with_quality(rows), INTERACTION)


def from_conversations(turns: DataFrame, history: int | None = None) -> DataFrame:
    """Each assistant turn with the user turn before it; earlier pairs, the last ``history`` of them or all, are its previous turns."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    rows = turns.withColumns({"user": F.lag("text").over(order), "user_role": F.lag("role").over(order), "system_context": F.max(F.when(F.col("role") == "system", F.col("text"))).over(Window.partitionBy("conv_id"))})
    pairs = rows.where("role = 'assistant' AND user_role = 'user'").withColumn("pair", F.struct(F.col("user"), F.col("text").alias("assistant")))
    before = order.rowsBetween(Window.unboundedPreceding if history is None else -history, -1)
    pairs = pairs.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.lit("manual").alias("source_type"), F.concat_ws("-", "conv_id", "turn").alias("source_id"), F.col("user").alias("user_input"),
        F.col("text").alias("assistant_output"), "system_context", F.col("conv_id").cast("string").alias("conversation_id"), F.col("turn").cast("int").alias("turn_number"),
        F.collect_list("pair").over(before).alias("previous_turns"), F.lit("success").alias("outcome"), F.lit(0.5).alias("confidence"), F.lit(False).alias("is_correction"),
        F.array(F.lit("conversation")).alias("tags"), F.col("conv_id").alias("_src_order"), F.col("turn").alias("_line_no"),
    )
    return conform(with_quality(pairs), INTERACTION)


def included(df: DataFrame, min_confidence: float = 0.0, include_failures: bool = True) -> DataFrame:
    df = df.where(F.col("confidence") >= min_confidence)
    return df if include_failures else df.where("outcome <> 'failure'")


def ingestion_counts(df: DataFrame, min_confidence: float = 0.0, include_failures: bool = True) -> DataFrame:
    """(source_type, read, ingested, filtered) under the filter of ``included``, in one pass."""
    stays = F.coalesce(F.col("confidence") >= min_confidence, F.lit(False))
    stays = stays if include_failures else stays & F.coalesce(F.col("outcome") != "failure", F.lit(False))
    return df.groupBy("source_type").agg(F.count("*").alias("read"), F.count_if(stays).alias("ingested"), F.count_if(~stays).alias("filtered"))


def trainable(min_quality: float = 0.5) -> Column:
    """Both texts, enough quality, and no failure that is not a correction."""
    both = (F.coalesce("user_input", F.lit("")) != "") & (F.coalesce("assistant_output", F.lit("")) != "")
    return both & (F.col("quality_score") >= min_quality) & (F.col("is_correction") | (F.col("outcome") != "failure"))


def tagged(df: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Default tags after a row's own; duplicates stay."""
    return df.withColumn("tags", F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.array(*map(F.lit, tags))))


def batched(df: DataFrame, size: int, *order: str) -> DataFrame:
    """A batch number for every ``size`` rows in order."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / size))


def selected(df: DataFrame, types: Sequence[str] | None = None, min_confidence: float | None = None, only_corrections: bool = False, min_batch: int | None = None, only_batches: bool = False, only_assisted: bool = False) -> DataFrame:
    """The filters of the event connectors."""
    if types:
        df = df.where(F.col("event_type").isin(*types))
    if min_confidence is not None:
        df = df.where(F.col("confidence") >= min_confidence)
    if only_corrections:
        df = df.where("is_correction")
    if min_batch is not None:
        df = df.where(F.col("batch_size") >= min_batch)
    if only_batches:
        df = df.where("batch_size > 1")
    return df.where("assisted") if only_assisted else df
