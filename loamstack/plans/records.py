"""Ingestion, formatting, quality and score queries: records that the star tables stand in for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import probing as P
from ..functions import scores as S
from ..functions.hashing import event_hash, joined_hash, label_hash
from ..operators import curation, dedup, formatting, interactions, quality, topics, web
from ..sources.readers import table
from . import binding as B

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- events as telemetry, feedback and authentication records ---------------------------------


def _by(column, cases: dict, otherwise):
    out = F.lit(otherwise)
    for k, v in cases.items():
        out = F.when(column == k, v).otherwise(out)
    return out


def telemetry_records(spark: SparkSession, d: str) -> DataFrame:
    """The user's remainder by 4 decides which keys the properties have, that by 3 whether there is a metric."""
    m, e = F.col("user_id") % 4, F.col("event_id").cast("string")
    kind = _by(F.col("event_type"), {"click": "INTENT_DETECTED", "view": "CONTEXT_ACCESSED", "purchase": "ROUTE_MATCHED", "error": "ROUTE_FAILED"}, "SOMETHING_ELSE")
    properties = F.when(m == 0, F.format_string('{"query":"  q%s ","env":"test"}', e)).when(m == 1, F.format_string('{"input":"  ","command":"c%s","context":"seen","state":"s"}', e))
    properties = properties.when(m == 2, F.format_string('{"response":"r%s","text":{"text":"n"},"confidence":"0.25"}', e)).otherwise('{"other":1}')
    return B.events(spark, d).select(
        e.alias("event_id"), kind.alias("event_type"), F.lit("2024-01-02T03:04:05Z").alias("timestamp"), F.array(F.lit("t")).alias("tags"), properties.alias("properties"),
        F.when(F.col("user_id") % 3 == 0, F.format_string('{"score":%d}', F.floor("value"))).otherwise("{}").alias("metrics"),
    )


_TELEMETRY = """k AS (SELECT event_id, user_id, value, CASE event_type WHEN 'click' THEN 'INTENT_DETECTED' WHEN 'view' THEN 'CONTEXT_ACCESSED' WHEN 'purchase' THEN 'ROUTE_MATCHED' WHEN 'error' THEN 'ROUTE_FAILED' ELSE 'SOMETHING_ELSE' END AS kind,
  CASE event_type WHEN 'click' THEN 'success' WHEN 'view' THEN 'partial' WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failure' ELSE 'unknown' END AS outcome,
  CASE user_id % 4 WHEN 0 THEN 'q' || event_id WHEN 1 THEN 'c' || event_id WHEN 2 THEN 'n' END AS user_input, CASE user_id % 4 WHEN 2 THEN 'r' || event_id END AS assistant_output,
  CASE user_id % 4 WHEN 1 THEN 'seen' || chr(10) || 's' END AS context, CASE WHEN user_id % 3 = 0 THEN floor(value) WHEN user_id % 4 = 2 THEN 0.25 ELSE 0.5 END AS raw FROM events),
t AS (SELECT *, CASE WHEN raw > 100 THEN 1 WHEN raw > 1 THEN raw / 100 ELSE greatest(0, raw) END AS confidence FROM k WHERE outcome <> 'partial' AND (user_input IS NOT NULL OR assistant_output IS NOT NULL OR kind = 'INTENT_DETECTED')),
q AS (SELECT *, least(1, greatest(0, confidence * CASE outcome WHEN 'success' THEN 1.2 WHEN 'failure' THEN 0.5 ELSE 1 END * CASE WHEN user_input <> '' AND assistant_output <> '' THEN 1.1 ELSE 1 END)) AS quality FROM t)"""


@query(f"""WITH {_TELEMETRY} SELECT event_id::VARCHAR AS source_id, outcome, user_input, assistant_output, context AS system_context, round(confidence, 6) AS confidence, round(quality, 6) AS quality_score, 't,event:' || kind AS tags, epoch(TIMESTAMP '2024-01-02 03:04:05')::BIGINT AS at FROM q""")
def telemetry_interactions(spark: SparkSession, d: str) -> DataFrame:
    rows = interactions.from_telemetry(telemetry_records(spark, d))
    return rows.select("source_id", "outcome", "user_input", "assistant_output", "system_context", F.round("confidence", 6).alias("confidence"), F.round("quality_score", 6).alias("quality_score"), F.array_join("tags", ",").alias("tags"), F.unix_timestamp("timestamp").alias("at"))


@query(f"""WITH {_TELEMETRY} SELECT event_id::VARCHAR AS source_id, 't,event:' || kind || ',x,y' AS tags FROM q WHERE confidence >= 0.3 AND outcome <> 'failure'""")
def telemetry_included(spark: SparkSession, d: str) -> DataFrame:
    rows = interactions.included(interactions.from_telemetry(telemetry_records(spark, d)), 0.3, include_failures=False)
    return interactions.tagged(rows, ["x", "y"]).select("source_id", F.array_join("tags", ",").alias("tags"))


@query(f"""WITH {_TELEMETRY} SELECT 'telemetry' AS source_type, count(*) AS read, count(*) FILTER (confidence >= 0.3 AND outcome <> 'failure') AS ingested, count(*) FILTER (NOT (confidence >= 0.3 AND outcome <> 'failure')) AS filtered FROM q""")
def telemetry_counts(spark: SparkSession, d: str) -> DataFrame:
    return interactions.ingestion_counts(interactions.from_telemetry(telemetry_records(spark, d)), 0.3, include_failures=False)


@query(f"""WITH {_TELEMETRY} SELECT outcome, count(*) AS n, round(avg(confidence), 6) AS confidence, count(*) FILTER (user_input <> '' AND assistant_output <> '' AND quality >= 0.2 AND outcome <> 'failure') AS trainable FROM q GROUP BY 1""")
def telemetry_trainable(spark: SparkSession, d: str) -> DataFrame:
    rows = interactions.from_telemetry(telemetry_records(spark, d))
    return rows.groupBy("outcome").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("confidence"), F.count_if(interactions.trainable(0.2)).alias("trainable"))


_PATTERNS = ["TERMINAL_ERROR", "TERMINAL_COMPLETION", "BROWSER_UPDATE", "SECURITY_ALERT", None]


def feedback_records(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id").cast("string")
    response = _by(F.col("event_type"), {"click": "ENGAGED", "view": "DISMISSED", "purchase": "NEGATIVE_FEEDBACK", "error": "DEFERRED"}, "SEEN")
    context = F.when(F.col("user_id") % 2 == 0, F.format_string('{"command":"do %s","expected":" better %s ","notes":"why","system_state":"idle"}', e, e)).otherwise(F.format_string('{"query":"do %s","response":"said %s","environment":"lab","active_context":"c"}', F.col("user_id").cast("string"), e))
    pattern = F.lit(None).cast("string")
    for k, name in enumerate(_PATTERNS):
        pattern = F.when(F.col("user_id") % 5 == k, F.lit(name)).otherwise(pattern)
    return B.events(spark, d).select(
        e.alias("id"), e.alias("event_id"), response.alias("response"), pattern.alias("pattern"), F.when(F.col("user_id") % 7 > 0, F.col("value").cast("double")).alias("time_to_respond"), context.alias("context"),
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("note "), e)).otherwise("").alias("notification_text"), F.lit("2024-01-02 03:04:05").alias("timestamp"),
    )


_FEEDBACK = """f AS (SELECT event_id, user_id, value, CASE event_type WHEN 'click' THEN 'engaged' WHEN 'view' THEN 'dismissed' WHEN 'purchase' THEN 'negative_feedback' WHEN 'error' THEN 'deferred' ELSE 'unknown' END AS outcome,
  CASE WHEN user_id % 2 = 0 THEN 'do ' || event_id ELSE 'do ' || user_id END AS user_input, CASE WHEN user_id % 2 = 0 THEN 'note ' || event_id ELSE 'said ' || event_id END AS assistant_output, CASE WHEN user_id % 7 > 0 THEN value ELSE 10 END AS t FROM events),
g AS (SELECT *, outcome = 'negative_feedback' AS is_correction, least(1, greatest(0, 0.5 + CASE WHEN t < 2 THEN 0.2 WHEN t < 5 THEN 0.1 WHEN t > 30 THEN -0.1 ELSE 0 END + CASE outcome WHEN 'engaged' THEN 0.2 WHEN 'negative_feedback' THEN 0.3 WHEN 'dismissed' THEN 0.1 ELSE 0 END)) AS confidence FROM f WHERE outcome <> 'deferred'),
h AS (SELECT *, CASE WHEN is_correction AND user_id % 2 = 0 THEN 'better ' || event_id END AS improved, least(1, confidence * CASE outcome WHEN 'engaged' THEN 1.1 WHEN 'negative_feedback' THEN 0.8 ELSE 1 END * 1.1) AS quality FROM g)"""


@query(f"""WITH {_FEEDBACK} SELECT event_id::VARCHAR AS source_id, outcome, user_input, assistant_output, is_correction, round(confidence, 6) AS confidence, round(quality, 6) AS quality_score, improved AS correction_improved, CASE WHEN is_correction THEN assistant_output END AS correction_original, CASE WHEN is_correction AND user_id % 2 = 0 THEN 'why' END AS correction_reason,
CASE WHEN user_id % 2 = 0 THEN 'system_state: idle' ELSE 'environment: lab' || chr(10) || 'active_context: c' END AS system_context,
CASE user_id % 5 WHEN 0 THEN 'error,terminal' WHEN 1 THEN 'success,terminal' WHEN 2 THEN 'browser,update' WHEN 3 THEN 'security,alert' ELSE 'other' END || ',response:' || CASE outcome WHEN 'unknown' THEN 'SEEN' ELSE upper(outcome) END AS tags FROM h""")
def feedback_interactions(spark: SparkSession, d: str) -> DataFrame:
    rows = interactions.from_feedback(feedback_records(spark, d))
    return rows.select(
        "source_id", "outcome", "user_input", "assistant_output", "is_correction", F.round("confidence", 6).alias("confidence"), F.round("quality_score", 6).alias("quality_score"), "correction_improved", "correction_original", "correction_reason", "system_context", F.array_join("tags", ",").alias("tags")
    )


@query("""WITH r AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'success' WHEN 'error' THEN 'failure' WHEN 'signup' THEN 'challenged' WHEN 'view' THEN 'failure' ELSE 'unknown' END AS outcome, event_type, user_id, value / 100 AS c FROM events),
s AS (SELECT *, CASE event_type WHEN 'click' THEN 'SUCCESS' WHEN 'error' THEN 'FAILURE' ELSE 'X' END AS o, CASE event_type WHEN 'view' THEN 'deny' WHEN 'signup' THEN 'challenge' ELSE 'none' END AS dec FROM r)
SELECT event_id::VARCHAR AS source_id, outcome, CASE user_id % 3 WHEN 0 THEN 'open ' || event_id WHEN 1 THEN 'unlock' ELSE 'Authentication attempt: ' || o END AS user_input, CASE WHEN user_id % 2 = 0 THEN 'a' || chr(10) || 'b' ELSE 'Decision: ' || dec END AS assistant_output,
round(CASE WHEN user_id % 4 < 2 THEN c WHEN user_id % 4 = 2 THEN 0.9 ELSE 0.5 END, 6) AS confidence, 'auth,decision:' || dec AS tags FROM s""")
def auth_interactions(spark: SparkSession, d: str) -> DataFrame:
    t, u = F.col("event_type"), F.col("user_id")
    records = B.events(spark, d).select(
        F.col("event_id").cast("string").alias("id"), _by(t, {"click": "SUCCESS", "error": "FAILURE"}, "X").alias("outcome"), _by(t, {"view": "deny", "signup": "challenge"}, "none").alias("decision"),
        F.when(u % 3 == 0, F.concat(F.lit("open "), F.col("event_id"))).otherwise("").alias("command"), F.when(u % 3 == 1, "unlock").otherwise("").alias("intent"), F.when(u % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("reasoning"),
        F.when(u % 4 < 2, F.col("value") / 100).alias("voice_confidence"), F.when(u % 4 == 2, 0.9).alias("final_confidence"), F.lit("2024-01-02T03:04:05").alias("timestamp"), F.lit("u").alias("user_id"),
    )
    rows = interactions.from_auth(records)
    return rows.select("source_id", "outcome", "user_input", "assistant_output", F.round("confidence", 6).alias("confidence"), F.array_join("tags", ",").alias("tags"))


@query("""SELECT event_id FROM events WHERE event_type IN ('click', 'purchase') AND value / 100 >= 0.4 AND user_id % 2 = 0""")
def connector_selected(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select("event_id", "event_type", (F.col("value") / 100).alias("confidence"), (F.col("user_id") % 2 == 0).alias("is_correction"))
    return interactions.selected(e, ["click", "purchase"], 0.4, only_corrections=True).select("event_id")


@query("""SELECT event_id FROM events WHERE floor(value)::BIGINT % 6 >= 3 AND user_id % 3 = 0""")
def automation_selected(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select("event_id", (F.floor("value") % 6).alias("batch_size"), (F.col("user_id") % 3 == 0).alias("assisted"))
    return interactions.selected(e, min_batch=3, only_batches=True, only_assisted=True).select("event_id")


# --- examples ---------------------------------------------------------------------------------


@query(f"""WITH {_FEEDBACK} SELECT event_id::VARCHAR AS source_id, '<|system|>' || chr(10) || 'Be kind.' || chr(10) || '<|user|>' || chr(10) || user_input || chr(10) || '<|assistant|>' || chr(10) AS prompt, improved AS chosen, assistant_output AS rejected,
((length('<|system|>' || chr(10) || 'Be kind.' || chr(10) || '<|user|>' || chr(10) || user_input || chr(10) || '<|assistant|>' || chr(10)) + length(improved) + length(assistant_output)) // 4)::BIGINT AS estimated_tokens, substr(sha256('<|system|>' || chr(10) || 'Be kind.' || chr(10) || '<|user|>' || chr(10) || user_input || chr(10) || '<|assistant|>' || chr(10) || ':' || improved || ':' || assistant_output), 1, 16) AS digest FROM h WHERE is_correction AND improved <> ''""")
def preferences_from_corrections(spark: SparkSession, d: str) -> DataFrame:
    rows = formatting.preferences_from_corrections(interactions.from_feedback(feedback_records(spark, d)), "Be kind.")
    return rows.select("source_id", "prompt", "chosen", "rejected", "estimated_tokens", joined_hash(F.col("prompt"), F.col("chosen"), F.col("rejected")).alias("digest"))


@query(f"""WITH {_FEEDBACK}, n AS (SELECT *, row_number() OVER (PARTITION BY user_input ORDER BY event_id::VARCHAR) AS n, CASE outcome WHEN 'engaged' THEN 3 WHEN 'unknown' THEN 1 WHEN 'dismissed' THEN -1 END AS k FROM h WHERE NOT is_correction),
p AS (SELECT a.user_input, a.assistant_output AS ao, b.assistant_output AS bo, b.event_id AS id, (b.k, b.confidence) > (a.k, a.confidence) AS later, (a.quality + b.quality) / 2 AS q FROM n a JOIN n b ON a.user_input = b.user_input AND a.n % 2 = 1 AND b.n = a.n + 1)
SELECT id::VARCHAR AS source_id, CASE WHEN later THEN bo ELSE ao END AS chosen, CASE WHEN later THEN ao ELSE bo END AS rejected, round(q, 6) AS quality_score FROM p WHERE ao <> bo""")
def preferences_from_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = formatting.preferences_from_pairs(interactions.from_feedback(feedback_records(spark, d)), "source_id")
    return rows.select("source_id", "chosen", "rejected", F.round("quality_score", 6).alias("quality_score"))


_CONV = """t AS (SELECT conv_id, turn, role, text FROM conversations), m AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn) AS l FROM t GROUP BY 1)"""


def _conversations(spark: SparkSession, d: str) -> DataFrame:
    return curation.conversation_messages(table(spark, d, "conversations"))


@query(f"""WITH {_CONV}, s AS (SELECT conv_id, len(l) AS n, (l[1].role = 'system')::INT AS sys, list_transform(l, lambda x: length(x.text) // 4) AS k FROM m),
b AS (SELECT *, list_sum(k) AS total, 200 - CASE WHEN sys = 1 THEN k[1] ELSE 0 END - CASE WHEN n - sys >= 2 THEN k[n] + k[n - 1] WHEN n - sys = 1 THEN k[n] ELSE 0 END AS room FROM s)
SELECT conv_id, (n <= 2 + sys OR total <= 200) AS whole, total::BIGINT AS tokens FROM b""")
def truncation_budgets(spark: SparkSession, d: str) -> DataFrame:
    m = _conversations(spark, d)
    cut = formatting.truncated_messages(F.col("messages"), 200)
    tokens = F.aggregate("messages", F.lit(0).cast("long"), lambda a, x: a + F.floor(F.length(x["content"]) / 4))
    rest = F.size("messages") - 1 + (F.col("messages")[0]["role"] != "system").cast("int")
    return m.select("conv_id", ((rest <= 2) | (F.size(cut) == F.size("messages")) & (tokens <= 200)).alias("whole"), tokens.alias("tokens"))


@query(f"""WITH RECURSIVE {_CONV}, s AS (SELECT conv_id, l, len(l) AS n, (l[1].role = 'system')::INT AS sys, list_sum(list_transform(l, lambda x: length(x.text) // 4)) AS total FROM m),
r(conv_id, i, room, kept) AS (SELECT conv_id, n - 2, 200 - CASE WHEN sys = 1 THEN length(l[1].text) // 4 ELSE 0 END - length(l[n].text) // 4 - CASE WHEN n - sys >= 2 THEN length(l[n - 1].text) // 4 ELSE 0 END, ''::VARCHAR FROM s WHERE total > 200
UNION ALL SELECT r.conv_id, r.i - 1, CASE WHEN r.room >= length(l[r.i].text) // 4 THEN r.room - length(l[r.i].text) // 4 ELSE r.room END, CASE WHEN r.room >= length(l[r.i].text) // 4 THEN r.kept || '|' || md5(l[r.i].text) ELSE r.kept END FROM r JOIN s USING (conv_id) WHERE r.i > s.sys),
f AS (SELECT conv_id, kept FROM r JOIN s USING (conv_id) WHERE r.i <= s.sys)
SELECT conv_id, CASE WHEN total <= 200 THEN array_to_string(list_transform(l, lambda x: md5(x.text)), '|') ELSE CASE WHEN sys = 1 THEN md5(l[1].text) || '|' ELSE '' END || ltrim(kept || '|', '|') || CASE WHEN n - sys >= 2 THEN md5(l[n - 1].text) || '|' ELSE '' END || md5(l[n].text) END AS digests
FROM s LEFT JOIN f USING (conv_id) WHERE n - sys >= 1""")
def truncated_conversations(spark: SparkSession, d: str) -> DataFrame:
    m = _conversations(spark, d).withColumn("cut", formatting.truncated_messages(F.col("messages"), 200))
    some = F.size(F.filter("messages", lambda x: x["role"] != "system")) >= 1
    return m.where(some).select("conv_id", F.array_join(F.transform("cut", lambda x: F.md5(x["content"])), "|").alias("digests"))


@query(f"""WITH {_CONV}, c AS (SELECT conv_id, coalesce(arg_max(text, turn) FILTER (role = 'system'), '') AS s, coalesce(arg_max(text, turn) FILTER (role = 'user'), '') AS u, coalesce(arg_max(text, turn) FILTER (role = 'assistant'), '') AS a FROM t GROUP BY 1)
SELECT conv_id, md5(s) AS instruction, md5(u) AS input_text, md5(a) AS output_text, ((s <> '')::INT + (u <> '')::INT + (a <> '')::INT) AS back FROM c""")
def formats_converted(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as instruction, input and output, and these as messages again."""
    a = formatting.to_alpaca(_conversations(spark, d))
    back = formatting.to_chatml(a.select("conv_id", "instruction", "input_text", "output_text"))
    return back.select("conv_id", *[F.md5(c).alias(c) for c in ("instruction", "input_text", "output_text")], F.size("messages").alias("back"))


@query(f"""WITH {_CONV} SELECT conv_id, md5(array_to_string(list_transform(l, lambda x: '<|' || x.role || '|>' || chr(10) || x.text), chr(10)) || '</s>') AS digest FROM m""")
def training_texts(spark: SparkSession, d: str) -> DataFrame:
    return _conversations(spark, d).select("conv_id", F.md5(formatting.training_text(F.col("messages"))).alias("digest"))


@query(f"""WITH {_CONV} SELECT conv_id, md5(array_to_string(list_transform(l, lambda x: upper(substr(x.role, 1, 1)) || substr(x.role, 2) || ': ' || x.text), chr(10) || chr(10))) AS digest FROM m""")
def examples_rendered(spark: SparkSession, d: str) -> DataFrame:
    m = _conversations(spark, d).select("conv_id", "messages", F.lit("chatml").alias("format_type"), *[F.lit(None).cast("string").alias(c) for c in ("instruction", "input_text", "output_text", "prompt", "chosen", "rejected")])
    return m.select("conv_id", F.md5(formatting.rendered(m)).alias("digest"))


@query(f"""WITH {_CONV}, z AS (SELECT conv_id, max(turn) FILTER (role = 'assistant') AS z FROM t GROUP BY 1) SELECT conv_id, md5(string_agg(CASE WHEN turn = z THEN 'new ' || conv_id ELSE text END, chr(10) ORDER BY turn)) AS digest FROM t JOIN z USING (conv_id) GROUP BY 1""")
def responses_rewritten(spark: SparkSession, d: str) -> DataFrame:
    m = _conversations(spark, d).select("conv_id", "messages", F.lit(None).cast("string").alias("output_text"), F.lit(None).cast("string").alias("chosen"), F.concat(F.lit("new "), "conv_id").alias("rewritten"))
    return formatting.with_rewrite(m).select("conv_id", F.md5(F.array_join(F.transform("messages", lambda x: x["content"]), "\n")).alias("digest"))


@query(f"""WITH {_FEEDBACK} SELECT event_id::VARCHAR AS source_id, user_input AS prompt, improved AS correction, round(quality * 1.5, 6) AS reward FROM h WHERE is_correction AND improved <> ''""")
def correction_experiences(spark: SparkSession, d: str) -> DataFrame:
    rows = interactions.from_feedback(feedback_records(spark, d)).where("is_correction AND coalesce(correction_improved, '') <> ''")
    got = formatting.experience_from_correction(rows)
    reward = next(c for c in got.columns if c.startswith("re") and c != "response")
    return got.select(F.regexp_extract("correction", r"(\d+)$", 1).alias("source_id"), "prompt", "correction", F.round(reward, 6).alias("reward"))


@query(f"""WITH {_FEEDBACK} SELECT event_id::VARCHAR AS id, improved AS chosen, assistant_output AS rejected FROM h WHERE is_correction AND improved <> '' ORDER BY event_id::VARCHAR LIMIT 100""")
def preferences_from_experiences(spark: SparkSession, d: str) -> DataFrame:
    rows = interactions.from_feedback(feedback_records(spark, d)).select(F.col("source_id").alias("id"), F.col("user_input").alias("prompt"), F.col("correction_improved").alias("correction"), F.col("assistant_output").alias("response"))
    return formatting.preference_from_experience(rows, 100, "id").select("id", "chosen", "rejected")


# --- quality ----------------------------------------------------------------------------------


def _replies(spark: SparkSession, d: str) -> DataFrame:
    v = (F.floor("value") / 10).cast("string")
    text = F.when(F.col("user_id") % 4 == 0, F.format_string('So: {"overall_score": %s, "recommendation": "improve"} ok', v)).when(F.col("user_id") % 4 == 1, F.format_string('{"overall_score": %s}', v)).when(F.col("user_id") % 4 == 2, '{"other": 1}').otherwise("no scores here")
    return B.events(spark, d).select("event_id", text.alias("reply"))


_SCORED = """s AS (SELECT event_id, CASE user_id % 4 WHEN 0 THEN floor(value) / 10 WHEN 1 THEN floor(value) / 10 WHEN 2 THEN 5 ELSE 0 END AS score, user_id % 4 AS k FROM events),
r AS (SELECT event_id, score, CASE k WHEN 0 THEN 'improve' WHEN 3 THEN 'reject' ELSE CASE WHEN score >= 7 THEN 'keep' WHEN score >= 4 THEN 'improve' ELSE 'reject' END END AS recommendation FROM s)"""


@query(f"""WITH {_SCORED} SELECT event_id, round(score, 4) AS score, recommendation, CASE WHEN recommendation = 'keep' OR score >= 7 THEN 'keep' WHEN recommendation = 'improve' THEN 'improve' ELSE 'reject' END AS route FROM r""")
def judge_replies(spark: SparkSession, d: str) -> DataFrame:
    return quality.routed(quality.parsed_scores(_replies(spark, d))).select("event_id", F.round("score", 4).alias("score"), "recommendation", "route")


@query(f"""WITH {_SCORED} SELECT count(*) AS n, round(avg(score), 6) AS mean_score, min(score) AS min_score, max(score) AS max_score, count(*) FILTER (recommendation = 'keep') AS keep, count(*) FILTER (recommendation = 'improve') AS improve, count(*) FILTER (recommendation = 'reject') AS reject FROM r""")
def judge_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.score_statistics(quality.parsed_scores(_replies(spark, d))).select("n", "mean_score", "min_score", "max_score", "keep", "improve", "reject")


@query(r"""WITH w AS (SELECT doc_id, length(text) AS chars, lang, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS w FROM documents), n AS (SELECT *, len(w) AS n, len(list_distinct(w)) AS u FROM w)
SELECT doc_id, round((least(1, n / 500) + CASE WHEN n > 0 THEN u / n ELSE 0 END + CASE lang WHEN 'en' THEN 0.2 WHEN 'de' THEN 0.7 ELSE 0.5 END) / CASE WHEN n > 0 THEN 3 ELSE 2 END, 4) AS difficulty FROM n""")
def example_difficulties(spark: SparkSession, d: str) -> DataFrame:
    task = F.when(F.col("lang") == "en", "simple_qa").when(F.col("lang") == "de", "coding").otherwise("none")
    return table(spark, d, "documents").select("doc_id", F.round(S.example_difficulty(F.col("text"), task), 4).alias("difficulty"))


@query("""WITH e AS (SELECT event_id, user_id, value / 100 AS reward, event_type FROM events) SELECT event_id, round(least(5, CASE WHEN user_id % 2 = 0 THEN 2 ELSE 1 END * CASE event_type WHEN 'click' THEN 1.5 WHEN 'view' THEN 2 ELSE 1 END * CASE WHEN user_id % 3 = 0 THEN 0.5 ELSE 1 END * CASE WHEN reward > 0.8 THEN 1.3 ELSE 1 END), 6) AS quality,
round(pow(CASE event_type WHEN 'click' THEN 10 WHEN 'view' THEN 0.5 ELSE 1 END * 2 * 0.5, 0.6), 6) AS priority FROM e""")
def experience_scores(spark: SparkSession, d: str) -> DataFrame:
    u, t = F.col("user_id"), F.col("event_type")
    q = S.experience_quality(F.when(u % 2 == 0, "x"), _by(t, {"click": "explicit", "view": "correction"}, "none"), F.when(u % 3 == 0, "short").otherwise("a longer response"), F.col("value") / 100)
    p = S.sampling_priority(_by(t, {"click": "critical", "view": "background"}, "normal"), F.lit(2.0), F.lit(0.5))
    return B.events(spark, d).select("event_id", F.round(q, 6).alias("quality"), F.round(p, 6).alias("priority"))


@query(r"""WITH r AS (SELECT conv_id, turn, role, text, regexp_matches(lower(text), 'i can''t|i cannot|i won''t|i will not|sorry|unable|against|refuse|inappropriate') AS refused, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) > 10 AS helpful FROM conversations)
SELECT role, count(*) AS n, count(*) FILTER (refused) AS refusals, count(*) FILTER (helpful) AS helpful, round(0.7 * avg(CASE WHEN conv_id % 2 = 0 THEN refused::INT END) + 0.3 * avg(CASE WHEN conv_id % 2 = 1 THEN helpful::INT END), 6) AS safety FROM r GROUP BY 1""")
def response_safety(spark: SparkSession, d: str) -> DataFrame:
    refused, helpful, harmful = S.is_refusal(F.col("text")), S.is_helpful(F.col("text")), F.col("conv_id") % 2 == 0
    return table(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(refused).alias("refusals"), F.count_if(helpful).alias("helpful"), F.round(S.safety_score(refused, harmful, helpful), 6).alias("safety"))


_WORDS = r"len(list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> ''))"


@query(rf"""WITH q AS (SELECT conv_id, turn, u || CASE WHEN conv_id % 3 = 0 THEN '' ELSE '?' END AS q, a || CASE conv_id % 4 WHEN 0 THEN ' `x`' WHEN 1 THEN ' ```f```' ELSE '' END || CASE WHEN conv_id % 5 = 0 THEN chr(10) || '1. an Example of a function and a class' ELSE '' END AS a, CASE WHEN turn % 2 = 1 THEN 'code_example' ELSE 'factual' END AS s
FROM (SELECT conv_id, turn, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS u, text AS a FROM conversations)),
g AS (SELECT *, {_WORDS.format('a')} AS n, (contains(a, '```') OR contains(lower(a), 'example'))::INT + regexp_matches(a, '(?m)^\d+\.|\*\s|^-\s')::INT + ({_WORDS.format('a')} > 50)::INT + ((regexp_matches(a, '\bfunction\b')::INT + regexp_matches(a, '\bmethod\b')::INT + regexp_matches(a, '\bclass\b')::INT + regexp_matches(a, '\bparameter\b')::INT + regexp_matches(a, '\breturn\b')::INT + regexp_matches(a, '\bAPI\b')::INT) >= 2)::INT AS k FROM q WHERE q IS NOT NULL)
SELECT conv_id, turn, CASE WHEN length(q) < 10 OR length(q) > 200 OR length(a) < 50 THEN 'rejected' WHEN length(a) > 2000 THEN 'low' WHEN NOT ends_with(q, '?') THEN 'low' WHEN s = 'code_example' AND NOT contains(a, '```') AND NOT regexp_matches(a, '`[^`]+`') THEN 'low' WHEN n < 20 THEN 'low' WHEN k >= 3 THEN 'high' WHEN k >= 1 THEN 'medium' ELSE 'low' END AS grade FROM g""")
def answer_grades(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    c = F.col("conv_id")
    t = table(spark, d, "conversations").withColumn("u", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("u IS NOT NULL")
    q = F.concat("u", F.when(c % 3 == 0, "").otherwise("?"))
    a = F.concat("text", F.when(c % 4 == 0, " `x`").when(c % 4 == 1, " ```f```").otherwise(""), F.when(c % 5 == 0, "\n1. an Example of a function and a class").otherwise(""))
    t = t.select("conv_id", "turn", q.alias("q"), a.alias("a"), F.when(F.col("turn") % 2 == 1, "code_example").otherwise("factual").alias("s"))
    return t.select("conv_id", "turn", S.answer_grade(F.col("q"), F.col("a"), F.col("s")).alias("grade"))


@query("""WITH e AS (SELECT event_id, event_type, user_id, floor(value)::BIGINT AS v FROM events) SELECT event_id, substr(md5('[{"key":"a","value":"' || user_id || '"},{"key":"b","value":"' || v || '"}]'), 1, 8) AS labels, substr(md5(event_type || ':' || user_id || ':[{"key":"a","value":"' || user_id || '"},{"key":"b","value":"' || v || '"}]'), 1, 16) AS event FROM e""")
def stable_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Labels are given with their keys in another order than they hash in."""
    m = F.create_map(F.lit("b"), F.floor("value").cast("string"), F.lit("a"), F.col("user_id").cast("string"))
    return B.events(spark, d).select("event_id", label_hash(m).alias("labels"), event_hash(F.col("event_type"), F.col("user_id").cast("string"), m).alias("event"))


@query(r"""SELECT doc_id, CASE WHEN s = '' THEN 'factual,howto' ELSE array_to_string(string_split(trim(s, ','), ',')[1:3], ',') END AS strategies FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'code_example,' ELSE '' END || CASE WHEN regexp_matches(l, '\bhow to\b|\bsteps?\b|\bfirst\b.*\bthen\b|\binstall\b|\bconfigure\b|\bsetup\b') THEN 'howto,' ELSE '' END
|| CASE WHEN regexp_matches(l, '\bbest practice\b|\brecommend\b|\bshould\b|\bavoid\b|\bprefer\b') THEN 'best_practice,' ELSE '' END || CASE WHEN regexp_matches(l, '\berror\b|\bfail\b|\bissue\b|\bproblem\b|\bfix\b|\bresolve\b|\btroubleshoot\b') THEN 'troubleshooting,' ELSE '' END AS s FROM (SELECT doc_id, lower(text || CASE doc_id % 4 WHEN 0 THEN ' How to fix' WHEN 1 THEN ' you should' ELSE '' END) AS l FROM documents))""")
def question_strategies(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    text = F.concat("text", F.when(k % 4 == 0, " How to fix").when(k % 4 == 1, " you should").otherwise(""))
    return table(spark, d, "documents").select("doc_id", F.array_join(S.strategies(text, k % 3 == 0), ",").alias("strategies"))


@query("""WITH e AS (SELECT event_id, floor(value)::INT AS k FROM events) SELECT event_id, CASE WHEN k % 3 = 0 THEN 'in' || event_id WHEN k % 3 = 1 THEN 'nested' ELSE 'last' END AS text, CASE WHEN k % 2 = 0 THEN k / 4 END AS number FROM e""")
def first_present_keys(spark: SparkSession, d: str) -> DataFrame:
    e, k = F.col("event_id").cast("string"), F.floor("value")
    doc = F.when(k % 3 == 0, F.format_string('{"a":"  ","b":" in%s","c":"last"', e)).when(k % 3 == 1, '{"b":{"text":"nested"},"c":"last"').otherwise('{"a":"","c":" last "')
    doc = F.concat(doc, F.when(k % 2 == 0, F.concat(F.lit(',"x":"none","y":'), (k / 4).cast("string"))).otherwise(""), F.lit("}"))
    return B.events(spark, d).select("event_id", P.first_text(doc, ("a", "b", "c")).alias("text"), P.first_number(doc, ("x", "y")).alias("number"))


# --- curation ---------------------------------------------------------------------------------


@query("""WITH e AS (SELECT event_id, value / (value + 50) AS p, (user_id % 4) AS v FROM events) SELECT event_id, round(-(p * ln(p) + (1 - p) * ln(1 - p)), 6) AS entropy, round(1 - abs(2 * p - 1), 6) AS margin, round(1 - greatest(p, 1 - p), 6) AS confidence,
round(CASE v WHEN 0 THEN 0 WHEN 3 THEN ln(3) ELSE -(1.0 / 3 * ln(1.0 / 3) + 2.0 / 3 * ln(2.0 / 3)) END, 6) AS vote_entropy FROM e""")
def uncertainty_scores(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).withColumn("p", F.col("value") / (F.col("value") + 50))
    p, v = F.array(F.col("p"), 1 - F.col("p")), F.col("user_id") % 4
    votes = F.when(v == 0, F.array(F.lit("a"), F.lit("a"), F.lit("a"))).when(v == 3, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a"), F.lit("b"), F.lit("b")))
    return e.select("event_id", F.round(curation.entropy(p), 6).alias("entropy"), F.round(curation.margin(p), 6).alias("margin"), F.round(curation.least_confidence(p), 6).alias("confidence"), F.round(curation.vote_entropy(votes), 6).alias("vote_entropy"))


@query("""SELECT item_id, c AS copy, md5(array_to_string(list_transform(range(1, length(text) + 1), lambda i: CASE WHEN regexp_matches(text[i], '[A-Za-z]') AND ('0x' || substr(md5('0|' || item_id || '|' || c || '|' || (i - 1)), 1, 8))::BIGINT / 4294967296.0 < 0.05 THEN '*' ELSE text[i] END), '')) AS digest FROM benchmark, range(1, 3) r(c)""")
def augmented_documents(spark: SparkSession, d: str) -> DataFrame:
    rows = curation.perturbed(table(spark, d, "benchmark").select("item_id", "text"), "item_id", "text", copies=2)
    return rows.select("item_id", "copy", F.md5("text").alias("digest"))


@query("""WITH u AS (SELECT doc_id, lang, ('0x' || substr(md5('0|' || doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u FROM documents WHERE lang IN ('en', 'de')), n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY u, doc_id) AS n FROM u) SELECT doc_id, lang AS part FROM n WHERE n <= CASE lang WHEN 'en' THEN 90 ELSE 30 END""")
def language_mixture(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return curation.mixture({k: docs.where(F.col("lang") == k).select("doc_id") for k in ("en", "de")}, {"en": 3.0, "de": 1.0}, 120, "doc_id")


@query(r"""WITH c AS (SELECT conv_id, turn, 'x = 1  # ' || text || chr(10) || '/* a' || chr(10) || 'b */y = 2   ' || chr(10) || chr(10) || chr(10) || chr(10) || 'z = 3 // end' AS t FROM (SELECT conv_id, turn, replace(replace(text, chr(10), ' '), '/', ' ') AS text FROM conversations))
SELECT conv_id, turn, md5('x = 1' || chr(10) || 'y = 2' || chr(10) || chr(10) || 'z = 3') AS digest FROM c""")
def normalised_code(spark: SparkSession, d: str) -> DataFrame:
    text = F.translate("text", "\n/", "  ")
    code = F.concat(F.lit("x = 1  # "), text, F.lit("\n/* a\nb */y = 2   \n\n\n\nz = 3 // end"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(curation.normalised_code(code)).alias("digest"))


_W = r"list_filter(regexp_split_to_array(lower(t), '\s+'), lambda w: w <> '')"
_NORM = r"""n AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, 'https?://[^\s<>"]+', '<URL>', 'g'), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<EMAIL>', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM documents)"""
_PRE = rf"""{_NORM}, w AS (SELECT *, {_W} AS w FROM n), m AS (SELECT *, len(w) AS k, len(list_distinct(w)) AS types, len(list_distinct(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS pairs, list_distinct(list_transform(range(1, greatest(len(w) - 12, 0) + 1), lambda i: array_to_string(w[i : i + 12], ' '))) AS g FROM w),
b AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(len(w) - 12, 0) + 1), lambda i: array_to_string(w[i : i + 12], ' '))) AS x FROM (SELECT {_W} AS w FROM (SELECT text AS t FROM benchmark))),
h AS (SELECT doc_id, count(*) AS hits FROM (SELECT doc_id, unnest(g) AS x FROM m) JOIN b USING (x) GROUP BY 1),
s AS (SELECT doc_id, t, 0.5 * CASE WHEN length(t) < 50 THEN length(t) / 50 WHEN length(t) > 1000 THEN 1000 / length(t) ELSE 1 END + 0.5 * CASE WHEN k = 0 THEN 0 WHEN k = 1 THEN 1 ELSE (types / k + pairs / (k - 1)) / 2 END AS quality, coalesce(hits, 0) / greatest(len(g), 1) >= 0.3 AS bad FROM m LEFT JOIN h USING (doc_id)),
r AS (SELECT *, CASE WHEN quality < 0.4 THEN 'low_quality' WHEN bad THEN 'contaminated' END AS reason FROM s),
z AS (SELECT doc_id, quality, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason IS NULL, sha256(t) ORDER BY doc_id) > 1 THEN 'duplicate' ELSE reason END AS reject_reason FROM r)"""


@query(f"""WITH {_PRE} SELECT doc_id, round(quality, 4) AS quality, reject_reason FROM z""")
def preprocessing(spark: SparkSession, d: str) -> DataFrame:
    rows = curation.preprocessed(table(spark, d, "documents"), table(spark, d, "benchmark"), 0.4)
    return rows.select("doc_id", F.round("quality", 4).alias("quality"), "reject_reason")


@query(f"""WITH {_PRE} SELECT count(*) AS total, count(*) FILTER (reject_reason IS NULL) AS kept, count(*) FILTER (reject_reason = 'duplicate') AS duplicates, round(avg(quality), 4) AS mean_quality FROM z""")
def preprocessing_stats(spark: SparkSession, d: str) -> DataFrame:
    return curation.preprocessing_statistics(curation.preprocessed(table(spark, d, "documents"), table(spark, d, "benchmark"), 0.4)).withColumn("mean_quality", F.round("mean_quality", 4))


@query("""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.4),
o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS i FROM v), k(i, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT k.i + 1, CASE WHEN len(list_intersect(k.kept, coalesce((SELECT list(a) FROM p WHERE p.b = o.vec_id), []))) > 0 THEN k.kept ELSE list_append(k.kept, o.vec_id) END FROM k JOIN o ON o.i = k.i + 1)
SELECT unnest(kept) AS vec_id FROM (SELECT kept FROM k ORDER BY i DESC LIMIT 1)""")
def semantic_dedup(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return dedup.greedy_kept(v, dedup.similar_pairs(v, 0.4)).where("kept").select("vec_id")


# --- pages and topics --------------------------------------------------------------------------


@query(r"""SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'how_to:use asyncio q' || turn || '|python_module:asyncio' WHEN 1 THEN 'devops:docker|what_is:docker image' WHEN 2 THEN 'ml_term:fine-tuning|ml_term:lora' END AS found FROM conversations WHERE role = 'user' AND conv_id % 4 < 3""")
def topic_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Invented prose names no topic, so each user turn asks a question of its conversation's kind."""
    k = F.col("conv_id") % 4
    text = F.when(k == 0, F.concat(F.lit("how do I use asyncio q"), "turn")).when(k == 1, "What is a Docker image?").when(k == 2, "LoRA and fine-tuning, lora").otherwise("nothing at all")
    e = table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", text.alias("text"))
    return topics.mentions(e).groupBy("conv_id", "turn").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "family", "name"))), "|").alias("found"))


@query(r"""WITH e AS (SELECT event_id, user_id, event_type, ts FROM events), m AS (SELECT event_id, event_type, ts, unnest(CASE user_id % 3 WHEN 0 THEN ['docker', 'pytest'] WHEN 1 THEN ['docker'] ELSE [] END) AS w FROM e),
f AS (SELECT event_id, event_type, ts, w AS name FROM m WHERE w = 'docker'), g AS (SELECT name, count(*) AS frequency, least(1, CASE arg_min(event_type, ts) WHEN 'error' THEN 0.9 ELSE 0.6 END + 0.05 * (count(*) - 1)) AS confidence, max(ts) AS seen FROM f GROUP BY 1)
SELECT name, substr(md5(name), 1, 12) AS topic_id, frequency, round(confidence, 4) AS confidence FROM g""")
def topic_discovery(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("user_id") % 3 == 0, "docker and pytest").when(F.col("user_id") % 3 == 1, "the docker way").otherwise("nothing")
    e = B.events(spark, d).select(text.alias("text"), F.when(F.col("event_type") == "error", 0.9).otherwise(0.6).alias("confidence"), F.lit("user_question").alias("source"), "ts")
    rows = topics.discovered(topics.mentions(e), F.lit("2024-06-01").cast("timestamp"), most=50)
    return rows.select("name", "topic_id", "frequency", F.round("confidence", 4).alias("confidence"))


@query("""SELECT n_name AS name, CASE WHEN n_nationkey % 10 >= 8 THEN 2 WHEN n_nationkey % 10 >= 6 THEN 3 ELSE 4 END AS priority FROM nation""")
def topic_levels(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "nation").select(F.col("n_nationkey").alias("topic_id"), F.col("n_name").alias("name"), ((F.col("n_nationkey") % 10) / 10).alias("priority"), F.array().cast("array<string>").alias("samples"))
    return topics.as_queue_topics(t).select(F.col("title").alias("name"), "priority")


@query(r"""SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>\s*(.*?)\s*</title>', 1) <> '' AS titled, len(regexp_extract_all(html, '(?i)<h[1-6][ >]')) AS headings FROM pages""")
def page_outline(spark: SparkSession, d: str) -> DataFrame:
    """Titles and headings as the parser finds them against those that patterns find in the raw page."""
    s = web.structured(table(spark, d, "pages"), "title", "sections")
    return s.select("page_id", (F.coalesce("title", F.lit("")) != "").alias("titled"), F.size(F.col("sections")).cast("long").alias("headings"))


_SIGNED = r"""d AS (SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN ' def f ( x ) import os' ELSE '' END || CASE doc_id % 5 WHEN 0 THEN ' Read our Privacy Policy and newsletter.' WHEN 1 THEN ' cookie policy' ELSE '' END AS t, doc_id % 3 = 0 AS code, CASE doc_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS marks FROM documents)"""


@query(rf"""WITH {_SIGNED}, s AS (SELECT *, len(list_filter(regexp_split_to_array(t, '[.!?]+'), lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')) > 20)) AS n FROM d)
SELECT doc_id, round(CASE WHEN length(t) = 0 THEN 0.0 WHEN length(t) < 200 THEN 0.1 WHEN n < 2 THEN 0.2 ELSE least(1, greatest(0, 0.5 + least(0.2, length(t) / 10000) + least(0.15, n / 50) + CASE WHEN code THEN 0.15 ELSE 0 END - least(0.3, 0.05 * marks))) END, 4) AS quality FROM s""")
def page_quality_signs(spark: SparkSession, d: str) -> DataFrame:
    """Every third document has code and two of five have marks of boilerplate, which invented prose lacks."""
    k = F.col("doc_id")
    text = F.concat("text", F.when(k % 3 == 0, " def f ( x ) import os").otherwise(""), F.when(k % 5 == 0, " Read our Privacy Policy and newsletter.").when(k % 5 == 1, " cookie policy").otherwise(""))
    return table(spark, d, "documents").select("doc_id", F.round(S.page_quality(text), 4).alias("quality"))


@query(r"""WITH p AS (SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'what is docker' WHEN 1 THEN 'implement a parallel class' WHEN 2 THEN 'Compare first and contrast then the design' ELSE 'hello' END AS t FROM events),
s AS (SELECT event_id, 0.15 * least(1, length(t) / 500) + CASE t WHEN 'what is docker' THEN 0.25 * 0.2 + 0.3 * 0.2 WHEN 'implement a parallel class' THEN 0.25 * 0.4 + 0.3 * 0.9 + 0.2 * 2 / 3 WHEN 'hello' THEN 0.3 * 0.5 ELSE 0.25 * 0.2 + 0.3 * 0.9 + 0.1 * 2 / 4 END AS s FROM p)
SELECT event_id, round(s, 4) AS score, CASE WHEN s < 0.2 THEN 'trivial' WHEN s < 0.4 THEN 'simple' WHEN s < 0.6 THEN 'moderate' WHEN s < 0.8 THEN 'complex' ELSE 'expert' END AS level, CASE WHEN s < 0.4 THEN 'small' WHEN s < 0.6 THEN 'medium' ELSE 'large' END AS size FROM s""")
def prompt_complexity_signs(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("user_id") % 4
    text = F.when(k == 0, "what is docker").when(k == 1, "implement a parallel class").when(k == 2, "Compare first and contrast then the design").otherwise("hello")
    s = S.prompt_complexity(text)
    return B.events(spark, d).select("event_id", F.round(s, 4).alias("score"), S.complexity_level(s).alias("level"), S.model_size(s).alias("size"))


#: What a page says besides plain prose, its status, and the violations and verdict that follow.
_NOTICES = [
    ("", 200, "", "compliant"), ("Subscribe now to continue reading. Sign up to read. Article limit reached.", 200, "paywall", "blocked"), ("Sign up to read.", 200, "", "compliant"),
    ("Login required. Authentication required.", 200, "login", "blocked"), ("Please complete the CAPTCHA.", 200, "captcha", "blocked"), ("Too many requests.", 200, "rate_limit", "blocked"),
    ("All rights reserved.", 200, "copyright", "warning"), ("Access denied.", 403, "access_denied", "blocked"), ("", 451, "legal", "blocked"), ("Adult content, bot detected.", 200, "scraping_blocked,adult", "blocked"), ("", 503, "http_error", "blocked"),
]


@query(f"""WITH n(k, violations, verdict) AS (VALUES {", ".join(f"({k}, '{v}', '{verdict}')" for k, (_, _, v, verdict) in enumerate(_NOTICES))})
SELECT page_id, violations, verdict, round(1 - 0.1 * CASE violations WHEN '' THEN 0 ELSE len(string_split(violations, ',')) END, 2) AS confidence FROM pages JOIN n ON page_id % {len(_NOTICES)} = k""")
def page_compliance_signs(spark: SparkSession, d: str) -> DataFrame:
    """The sample pages break no rule, so each page gets the notice and status of its remainder."""
    k = F.col("page_id") % len(_NOTICES)
    text, status = F.lit(""), F.lit(200)
    for n, (notice, code, _, _) in enumerate(_NOTICES):
        text, status = F.when(k == n, notice).otherwise(text), F.when(k == n, code).otherwise(status)
    prose = "This page has a long and plain sentence about nothing in particular. " * 6
    p = table(spark, d, "pages").select("page_id", "url", F.lit("<p></p>").alias("html"), F.concat(F.lit(prose), text).alias("text"), status.alias("http_status"))
    rows = web.compliance(p, flag_copyright=True)
    return rows.select("page_id", F.array_join("violations", ",").alias("violations"), "verdict", F.round("confidence", 2).alias("confidence"))


@query(r"""WITH p AS (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS l FROM documents) SELECT doc_id, len(l)::BIGINT AS paragraphs, list_max(list_transform(l, lambda x: length(x)))::BIGINT AS longest, length(text) - 2 * (len(l) - 1) AS chars FROM p JOIN documents USING (doc_id)""")
def chunk_measures(spark: SparkSession, d: str) -> DataFrame:
    """Chunks hold every paragraph once: their characters without joints, and with chunks of one character each paragraph alone."""
    t = table(spark, d, "documents").select("doc_id", web.chunked(F.col("text"), 1).alias("alone"), web.chunked(F.col("text"), 1500).alias("chunks"))
    joined = F.split(F.array_join("chunks", "\n\n"), "\n\n")
    return t.select("doc_id", F.size("alone").cast("long").alias("paragraphs"), F.array_max(F.transform("alone", lambda x: F.length(x))).cast("long").alias("longest"), F.aggregate(joined, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))
