"""Health, registry, queue, sampling, evaluation and authentication queries over the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.hashing import next_version, semantic_version
from ..operators import auth, costs, datasets, evaluation, federated, health, registry, sampling, series, telemetry, topics
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


def _round(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- health ------------------------------------------------------------------------------

_BEFORE = f"{B.CHECKS_SQL}, c AS (SELECT *, lag(status) OVER (PARTITION BY component ORDER BY ts, event_id) AS before FROM checks)"


@query(f"""WITH {_BEFORE} SELECT component, event_id, before, status FROM c WHERE before IS NULL OR before <> status""")
def health_transitions(spark: SparkSession, d: str) -> DataFrame:
    return health.transitions(B.checks(spark, d), "event_id").select("component", "event_id", "before", "status")


@query(f"""WITH {B.CHECKS_SQL}, l AS (SELECT component, arg_max(status, ts) AS status FROM checks GROUP BY 1)
SELECT CASE WHEN bool_or(status = 'unhealthy') THEN 'unhealthy' WHEN bool_or(status = 'degraded') THEN 'degraded' ELSE 'healthy' END AS overall, count(*) AS components, count(*) FILTER (status = 'unhealthy') AS unhealthy FROM l""")
def health_overall(spark: SparkSession, d: str) -> DataFrame:
    return health.overall(B.checks(spark, d))


@query(f"""WITH {B.CHECKS_SQL}, r AS (SELECT *, sum((status <> 'unhealthy')::INT) OVER (PARTITION BY component ORDER BY ts, event_id) AS run FROM checks),
f AS (SELECT component, event_id, sum((status = 'unhealthy')::INT) OVER (PARTITION BY component, run ORDER BY ts, event_id)::BIGINT AS failures FROM r) SELECT *, failures >= 2 AS open FROM f""")
def health_circuit(spark: SparkSession, d: str) -> DataFrame:
    return health.circuit_open(B.checks(spark, d), 2, "event_id").select("component", "event_id", "failures", "open")


@query(f"""WITH RECURSIVE {B.CHECKS_SQL}, c AS (SELECT *, coalesce(lag(status) OVER (PARTITION BY component ORDER BY ts, event_id), 'unknown') AS before FROM checks),
a AS (SELECT component, ts, status, before FROM c WHERE (status <> before OR before = 'unknown') AND (status IN ('unhealthy', 'degraded') OR (status = 'healthy' AND before IN ('unhealthy', 'degraded')))),
f(component, ts) AS (SELECT component, min(ts) FROM a GROUP BY 1 UNION ALL SELECT f.component, min(a.ts) FROM f JOIN a ON a.component = f.component AND a.ts >= f.ts + INTERVAL 300 SECOND GROUP BY f.component, f.ts)
SELECT component, ts, before, status FROM f JOIN a USING (component, ts)""")
def health_alerts(spark: SparkSession, d: str) -> DataFrame:
    return health.alerts(B.checks(spark, d), 300.0, "event_id").select("component", "ts", "before", "status")


@query("""WITH e AS (SELECT user_id, floor(value)::INT % 4 AS missed, floor(value)::INT % 50 AS errors, value AS cpu, event_id FROM events),
s AS (SELECT event_id, round(least(1, greatest(0, 1 - 0.3 * missed - least(0.3, errors / 100) - CASE WHEN cpu > 80 THEN 0.2 ELSE 0 END)), 4) AS score FROM e)
SELECT event_id, score, CASE WHEN score >= 0.8 THEN 'healthy' WHEN score >= 0.5 THEN 'degraded' WHEN score >= 0.2 THEN 'unhealthy' ELSE 'dead' END AS state FROM s""")
def health_scores(spark: SparkSession, d: str) -> DataFrame:
    n = F.floor("value")
    score = F.round(S.health_score(n % 4, n % 50, F.col("value")), 4)
    return B.events(spark, d).select("event_id", score.alias("score"), S.health_state(score).alias("state"))


@query(f"""WITH {B.CHECKS_SQL}, l AS (SELECT component, arg_max(status, ts) AS status, component % 3 AS role FROM checks GROUP BY 1) SELECT status, role, count(*) AS n FROM l GROUP BY GROUPING SETS ((status), (role))""")
def health_summary(spark: SparkSession, d: str) -> DataFrame:
    last = B.checks(spark, d).groupBy("component").agg(F.max_by("status", "ts").alias("status")).withColumn("role", F.col("component") % 3)
    return health.summary(last, "status", "role")


# --- telemetry ------------------------------------------------------------------------------


@query("""SELECT event_type AS name, user_id % 7 AS shard, sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END)::BIGINT AS count FROM events GROUP BY 1, 2""")
def metric_counters(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select(F.col("event_type").alias("name"), (F.col("user_id") % 7).alias("shard"), F.when(F.col("event_type") == "error", -1).otherwise(1).alias("change"))
    return telemetry.counters(e, "name", "shard")


@query("""SELECT event_type AS name, user_id, arg_max(value, ts) AS value FROM events GROUP BY 1, 2""")
def metric_gauges(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.gauges(B.metrics(spark, d), "name", "user_id")


@query("""SELECT user_id AS component, arg_max(value, ts) AS value, max(ts) AS seen FROM events GROUP BY 1""")
def fleet_state(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.latest_state(B.events(spark, d).withColumnRenamed("user_id", "component"), "component", "value")


@query("""WITH r AS (SELECT user_id % 10 AS model, event_type <> 'error' AS ok, value AS ms, (event_id % 200) AS tokens FROM events),
a AS (SELECT model, count(*) AS requests, avg(ok::INT) AS success_rate, avg(ms) FILTER (ok) AS avg_ms, min(ms) FILTER (ok) AS min_ms, max(ms) FILTER (ok) AS max_ms, sum(tokens) / (sum(ms) FILTER (ok) / 1000) AS tokens_per_s, list_sort(list(ms) FILTER (ok)) AS l FROM r GROUP BY 1)
SELECT model, requests, round(success_rate, 4) AS success_rate, round(avg_ms, 4) AS avg_ms, min_ms, max_ms, round(tokens_per_s, 4) AS tokens_per_s,
  l[least(len(l), (floor(len(l) * 0.5) + 1)::INT)] AS p50_ms, l[least(len(l), (floor(len(l) * 0.95) + 1)::INT)] AS p95_ms, l[least(len(l), (floor(len(l) * 0.99) + 1)::INT)] AS p99_ms FROM a""")
def inference_performance(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select((F.col("user_id") % 10).alias("model"), (F.col("event_type") != "error").alias("success"), F.col("value").alias("latency_ms"), (F.col("event_id") % 200).alias("tokens"))
    return _round(telemetry.performance(e, "model"), "success_rate", "avg_ms", "tokens_per_s")


@query("""SELECT event_id, ts, severity, component FROM (SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'critical' WHEN 'signup' THEN 'error' WHEN 'purchase' THEN 'warning' ELSE 'info' END AS severity, user_id % 5 AS component FROM events)
WHERE severity IN ('critical', 'error') AND component = 3 ORDER BY ts DESC LIMIT 100""")
def alert_history(spark: SparkSession, d: str) -> DataFrame:
    severity = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "signup", "error").when(F.col("event_type") == "purchase", "warning").otherwise("info")
    e = B.events(spark, d).select("event_id", "ts", severity.alias("severity"), (F.col("user_id") % 5).alias("component"))
    return telemetry.alert_history(e, "error", 3)


@query("""SELECT event_id FROM events WHERE event_type <> 'click' AND (user_id % 3 = 0 OR user_id % 3 = 1)""")
def targeted_events(spark: SparkSession, d: str) -> DataFrame:
    """Users of remainder 0 name nobody, of 1 the receiver and another, of 2 another."""
    m = F.col("user_id") % 3
    names = F.when(m == 0, F.array().cast("array<string>")).when(m == 1, F.array(F.lit("view"), F.lit("click"))).otherwise(F.array(F.lit("view")))
    return telemetry.routed(B.events(spark, d).select("event_id", F.col("event_type").alias("source"), names.alias("target_sources")), "click").select("event_id")


@query("""WITH m AS (SELECT event_id, event_type AS name, floor(epoch_us(ts) / 36e8)::BIGINT AS w FROM events), c AS (SELECT name, w, count(*) / 3600 AS rate FROM m GROUP BY 1, 2),
s AS (SELECT name, w + 1 AS w, CASE WHEN rate > 0.0005 THEN greatest(0.01, 0.0005 / rate) ELSE 1 END AS share FROM c)
SELECT event_id, round(coalesce(share, 1), 6) AS share FROM m LEFT JOIN s USING (name, w) WHERE ('0x' || substr(md5('0|' || event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < coalesce(share, 1)""")
def adaptive_sample(spark: SparkSession, d: str) -> DataFrame:
    """Windows of an hour and a target of 0.0005 rows a second, which most hours exceed."""
    rows = telemetry.sampled(B.metrics(spark, d), "name", "event_id", 3600, 0.0005)
    return rows.select("event_id", F.round("share", 6).alias("share"))


@query("""WITH e AS (SELECT event_type AS priority, (user_id % 3)::VARCHAR AS tier FROM events), l AS (SELECT 'priority' AS "column", priority AS level FROM e UNION ALL SELECT 'tier', tier FROM e)
SELECT "column", level, count(*) AS n, round((SELECT count(*) FROM e) / 20000, 4) AS fill_rate FROM l GROUP BY 1, 2""")
def buffer_distribution(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select(F.col("event_type").alias("priority"), (F.col("user_id") % 3).alias("tier"))
    return _round(sampling.distribution(e, 20000, "priority", "tier"), "fill_rate")


@query("""SELECT name, count(*) AS n, sum(priority) AS priorities, count(*) FILTER (age_days > 30) AS old FROM (SELECT event_type AS name, (floor(value)::INT % 4)::BIGINT AS priority, date_diff('day', ts::DATE, DATE '2024-03-01') AS age_days FROM events) GROUP BY 1""")
def buffer_statistics(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select(F.col("event_type").alias("name"), (F.floor("value") % 4).alias("priority"), F.datediff(F.lit("2024-03-01"), F.col("ts").cast("date")).alias("age_days"))
    return sampling.buffer_statistics(e, "name", "priority", "age_days", 30)


# --- costs and authentication --------------------------------------------------------------


@query("""SELECT event_type AS service, round(sum(value) + sum(user_id), 4) AS cost FROM events GROUP BY 1""")
def service_costs(spark: SparkSession, d: str) -> DataFrame:
    """State maps of a service: two costs, a text that is no number and an entry that is no cost."""
    fields = F.create_map(F.lit("api_cost"), F.col("value").cast("string"), F.lit("total_COST_usd"), F.col("user_id").cast("string"), F.lit("cost_note"), F.lit("none"), F.lit("requests"), F.lit("9"))
    return _round(costs.service_costs(B.events(spark, d).select(F.col("event_type").alias("service"), fields.alias("fields"))), "cost")


def _auth_results(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value") / 100
    return B.events(spark, d).select(
        F.col("event_id").alias("request_id"), (F.col("event_type") != "error").alias("authenticated"), v.alias("ml_confidence"), (1 - v).alias("physics_confidence"),
        F.when(F.col("user_id") % 2 == 0, v).alias("behavioral_confidence"), (v * v).alias("visual_confidence"), v.alias("final_confidence"), (F.col("user_id") == 7).alias("spoofing_detected"),
        (F.col("user_id") == 9).alias("visual_threat_detected"), F.array(F.concat(F.lit("h"), F.col("user_id") % 9), F.concat(F.lit("k"), F.floor("value") % 4)).alias("hypotheses_evaluated"),
    )


@query("""WITH r AS (SELECT user_id, value / 100 AS v FROM events), l AS (SELECT 'ml_confidence' AS factor, v AS c FROM r UNION ALL SELECT 'physics_confidence', 1 - v FROM r UNION ALL SELECT 'behavioral_confidence', v FROM r WHERE user_id % 2 = 0
UNION ALL SELECT 'visual_confidence', v * v FROM r UNION ALL SELECT 'final_confidence', v FROM r) SELECT factor, round(avg(c), 4) AS mean, round(min(c), 4) AS low, round(max(c), 4) AS high, round(coalesce(stddev_samp(c), 0), 4) AS sd FROM l GROUP BY 1""")
def auth_confidence_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return _round(auth.confidence_breakdown(_auth_results(spark, d)), "mean", "low", "high", "sd")


@query("""SELECT h AS hypothesis, count(*) AS count FROM (SELECT 'h' || (user_id % 9) AS h FROM events UNION ALL SELECT 'k' || (floor(value)::INT % 4) FROM events) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def auth_top_hypotheses(spark: SparkSession, d: str) -> DataFrame:
    return auth.top_hypotheses(_auth_results(spark, d))


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (user_id = 7) AS s, count(*) FILTER (user_id = 9) AS v, count(*) FILTER (event_type = 'error') AS f FROM events)
SELECT 'spoofing' AS threat, 'high' AS severity, s AS count FROM c WHERE s >= 3 UNION ALL SELECT 'visual', 'critical', v FROM c WHERE v > 0 UNION ALL SELECT 'failures', 'moderate', f FROM c WHERE n >= 10 AND f / n > 0.5""")
def auth_threats(spark: SparkSession, d: str) -> DataFrame:
    return auth.threats(_auth_results(spark, d))


@query("""SELECT count(*) AS events, count(*) FILTER (b > 1) AS batches, round(sum(b) FILTER (b > 1) / nullif(count(*) FILTER (b > 1), 0), 4) AS avg_batch, round(sum(value), 4) AS time_saved_ms, sum(user_id)::BIGINT AS tokens_saved, round(avg((event_type = 'view')::INT) * 100, 4) AS assisted_percent FROM (SELECT *, floor(value)::BIGINT % 5 AS b FROM events)""")
def automation_metrics(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select((F.floor("value") % 5).alias("batch_size"), F.col("value").alias("time_saved_ms"), F.col("user_id").alias("tokens_saved"), (F.col("event_type") == "view").alias("assisted"))
    return _round(auth.automation(e), "avg_batch", "time_saved_ms", "assisted_percent")


# --- evaluation ----------------------------------------------------------------------------


@query("""SELECT user_id AS run_id, round(avg(value), 4) AS score, bool_and(value > 2) AS passed, count(*) AS metrics FROM events GROUP BY 1""")
def eval_overall(spark: SparkSession, d: str) -> DataFrame:
    return _round(evaluation.overall(B.events(spark, d).select(F.col("user_id").alias("run_id"), "value", (F.col("value") > 2).alias("passed"))), "score")


@query("""WITH s AS (SELECT user_id AS model, event_type AS b, value FROM events), w(b, w) AS (VALUES ('click', 0.5), ('view', 0.3), ('purchase', 0.23)) SELECT model, round(sum(value * w) / sum(w), 6) AS overall FROM s LEFT JOIN w USING (b) GROUP BY 1""")
def eval_weighted_score(spark: SparkSession, d: str) -> DataFrame:
    s = B.events(spark, d).select(F.col("user_id").alias("model"), F.col("event_type").alias("benchmark"), F.col("value").alias("score"))
    return _round(evaluation.weighted_score(s, {"click": 0.5, "view": 0.3, "purchase": 0.23}), "overall", digits=6)


@query("""WITH s AS (SELECT user_id % 5 AS test, CASE event_type WHEN 'click' THEN 'latency' WHEN 'view' THEN 'loss' ELSE 'accuracy' END AS metric, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS v, value FROM events),
g AS (SELECT test, metric, v, count(*) AS n, avg(value) AS m, coalesce(stddev_samp(value), 0) AS sd FROM s GROUP BY 1, 2, 3), j AS (SELECT a.test, a.metric, a.n AS na, b.n AS nb, a.m AS ma, b.m AS mb, a.sd AS sa, b.sd AS sb FROM g a JOIN g b ON a.test = b.test AND a.metric = b.metric AND a.v = 'a' AND b.v = 'b')
SELECT test, metric, round(CASE WHEN ma <> 0 THEN CASE WHEN metric IN ('latency', 'loss') THEN -1 ELSE 1 END * (mb - ma) / ma * 100 END, 4) AS improvement,
  na >= 10 AND nb >= 10 AND CASE WHEN sa = 0 AND sb = 0 THEN abs(ma - mb) > 0.01 ELSE coalesce(abs((ma - mb) / nullif(sqrt(sa ** 2 / na + sb ** 2 / nb), 0)) > 2, false) END AS significant FROM j""")
def registry_ab_test(spark: SparkSession, d: str) -> DataFrame:
    metric = F.when(F.col("event_type") == "click", "latency").when(F.col("event_type") == "view", "loss").otherwise("accuracy")
    s = B.events(spark, d).select((F.col("user_id") % 5).alias("test_id"), metric.alias("metric"), F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("variant"), "value")
    return _round(evaluation.registry_ab(s).select("test", "metric", "improvement", "significant"), "improvement")


# --- registry -------------------------------------------------------------------------------

_VERSIONS = """v AS (SELECT p_brand AS model, (p_partkey % 3) || '.' || (p_size % 12) || '.' || p_partkey AS version, (p_partkey % 3)::BIGINT * 1000000000000 + (p_size % 12)::BIGINT * 1000000000 + p_partkey AS o, CASE p_partkey % 5 WHEN 0 THEN 'deployed' WHEN 1 THEN 'staged' ELSE 'archived' END AS status FROM part)"""


def _versions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    status = F.when(k % 5 == 0, "deployed").when(k % 5 == 1, "staged").otherwise("archived")
    return table(spark, d, "part").select(F.col("p_brand").alias("model"), F.concat_ws(".", k % 3, F.col("p_size") % 12, k).alias("version"), status.alias("status"))


@query(f"""WITH {_VERSIONS} SELECT model, version, status FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY o DESC) AS n FROM v) WHERE n <= 3 OR status IN ('deployed', 'staged')""")
def registry_retained(spark: SparkSession, d: str) -> DataFrame:
    return registry.retained_versions(_versions(spark, d), 3)


@query(f"""WITH {_VERSIONS} SELECT model, arg_max(version, o) AS version FROM v WHERE status = 'deployed' GROUP BY 1""")
def registry_deployed(spark: SparkSession, d: str) -> DataFrame:
    return registry.deployed(_versions(spark, d), "model")


@query(f"""WITH {_VERSIONS} SELECT version, status FROM v WHERE model = 'Brand#3' AND status = 'archived' ORDER BY o DESC LIMIT 20""")
def registry_listed(spark: SparkSession, d: str) -> DataFrame:
    return registry.listed(_versions(spark, d), "Brand#3", "archived", 20).select("version", "status")


@query(f"""WITH {_VERSIONS} SELECT version, split_part(version, '.', 1)::INT + 1 || '.0.0' AS major, split_part(version, '.', 1) || '.' || (split_part(version, '.', 2)::INT + 1) || '.0' AS minor, split_part(version, '.', 1) || '.' || split_part(version, '.', 2) || '.' || (split_part(version, '.', 3)::INT + 1) AS patch FROM v""")
def registry_next_versions(spark: SparkSession, d: str) -> DataFrame:
    return _versions(spark, d).select("version", *[next_version(F.col("version"), k).alias(k) for k in ("major", "minor", "patch")])


_MODELS = """m AS (SELECT p_partkey AS ord, CASE WHEN p_partkey % 7 = 0 THEN 'here' ELSE 'far' END AS repository, p_size % 20 AS loads, p_retailprice AS latency_ms, (p_size % 32)::DOUBLE AS memory_gb, p_type AS kind FROM part WHERE p_partkey % 2 = 0)"""


@query(f"""WITH {_MODELS} SELECT ord, round(CASE repository WHEN 'here' THEN 1000 ELSE 0 END + loads * 10 - latency_ms, 4) AS score FROM m WHERE memory_gb <= 16 AND latency_ms <= 2000 AND kind = 'ECONOMY' ORDER BY 2 DESC, ord LIMIT 1""")
def registry_best_model(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    m = table(spark, d, "part").select(
        k.alias("ord"), F.when(k % 7 == 0, "here").otherwise("far").alias("repository"), (F.col("p_size") % 20).alias("loads"), F.col("p_retailprice").alias("latency_ms"), (F.col("p_size") % 32).cast("double").alias("memory_gb"),
        F.array("p_type").alias("capabilities"), F.when(k % 2 == 0, "available").otherwise("gone").alias("status"),
    )
    return registry.best_model(m, "here", 16, 2000, ["ECONOMY"]).select("ord", F.round("score", 4).alias("score"))


@query("""SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_size > 10""")
def registry_capabilities(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "part").select("p_partkey", F.array("p_type", "p_brand").alias("tags"), F.array_compact(F.array(F.lit("load"), F.when(F.col("p_size") > 10, "big"))).alias("capabilities"))
    return registry.with_capabilities(t, ["ECONOMY", "PROMO"], ["load", "big"]).select("p_partkey")


@query("""WITH c AS (SELECT o_custkey AS run, o_orderkey AS checkpoint, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS b, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) SELECT run, checkpoint FROM c WHERE b > 3 AND r > 2""")
def registry_removed_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("checkpoint"), F.col("o_orderkey").alias("step"), F.col("o_totalprice").alias("loss"))
    return registry.removed_checkpoints(c, registry.kept_checkpoints(c, "loss")).select("run", "checkpoint")


@query("""SELECT s_name AS name, s_suppkey AS step FROM supplier ORDER BY s_suppkey DESC LIMIT 1""")
def registry_latest_by_number(spark: SparkSession, d: str) -> DataFrame:
    return registry.latest_by_number(table(spark, d, "supplier").select(F.col("s_name").alias("name")))


@query("""SELECT o_custkey AS run, arg_max(o_orderkey, (CASE WHEN o_orderpriority = '5-LOW' THEN '-inf'::DOUBLE ELSE o_totalprice::DOUBLE END, -o_orderkey)) AS checkpoint FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderpriority <> '5-LOW') > 0""")
def registry_best_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    """Runs without any value have no defined best and are left out."""
    c = table(spark, d, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("checkpoint"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice").cast("double")).alias("gain"))
    runs = c.where("gain IS NOT NULL").select("run").distinct()
    return registry.best_checkpoint(c, "gain", lower_is_better=False).join(runs, "run", "left_semi")


@query("""SELECT n_regionkey AS layer, list_sort(list(n_name)) AS components, (row_number() OVER (ORDER BY n_regionkey DESC) - 1) * 5.0::DOUBLE AS starts_at FROM nation WHERE n_nationkey % 4 <> 1 GROUP BY 1""")
def shutdown_plan(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "nation").select(F.col("n_regionkey").alias("layer"), F.col("n_name").alias("component"), (F.col("n_nationkey") % 4 != 1).alias("active"))
    return registry.shutdown_plan(c)


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority DESC, o_orderdate, o_orderkey LIMIT 50""")
def scheduler_admitted(spark: SparkSession, d: str) -> DataFrame:
    jobs = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "queued").otherwise("done").alias("status"), F.col("o_orderpriority").alias("priority"), F.struct("o_orderdate", "o_orderkey").alias("created_at"))
    return registry.admitted(jobs, 50).select("o_orderkey")


@query("""SELECT o_orderkey FROM orders ORDER BY o_orderpriority, o_orderkey LIMIT 500""")
def queue_drained(spark: SparkSession, d: str) -> DataFrame:
    return registry.drained(table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("seq")), 500).select("o_orderkey")


# --- the topic queue -----------------------------------------------------------------------


def _queue(spark: SparkSession, d: str) -> DataFrame:
    """Orders as topics: the customer's nation is the domain."""
    status = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "completed").otherwise("failed")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("topic_id"), (F.col("o_custkey") % 25).alias("domain"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), status.alias("status"),
        F.col("o_orderdate").cast("date").alias("created_at"), F.col("o_orderdate").cast("date").alias("updated_at"), (F.col("o_orderkey") % 4).cast("int").alias("retry_count"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("examples"),
    )


_QUEUE = """q AS (SELECT o_orderkey AS topic_id, o_custkey % 25 AS domain, substr(o_orderpriority, 1, 1)::INT AS priority, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'completed' ELSE 'failed' END AS status, o_orderdate::DATE AS created_at, (o_orderkey % 4)::INT AS retry_count, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS examples FROM orders)"""


@query(f"""WITH {_QUEUE} SELECT topic_id FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY priority, created_at, topic_id) AS n FROM q WHERE status = 'pending') WHERE n <= 2 ORDER BY priority, created_at, topic_id LIMIT 20""")
def topic_dequeued(spark: SparkSession, d: str) -> DataFrame:
    return topics.dequeued(_queue(spark, d), 20, 2).select("topic_id")


@query(f"""WITH {_QUEUE}, o AS (SELECT *, CASE WHEN topic_id % 5 = 0 THEN true WHEN topic_id % 5 = 1 THEN false END AS ok FROM q) SELECT topic_id, CASE WHEN ok IS NULL THEN status WHEN ok THEN 'completed' WHEN retry_count + 1 <= 3 THEN 'pending' ELSE 'failed' END AS status, retry_count + coalesce((NOT ok)::INT, 0) AS retry_count FROM o""")
def topic_attempts(spark: SparkSession, d: str) -> DataFrame:
    q = _queue(spark, d)
    k = F.col("topic_id") % 5
    return topics.after_attempt(q, q.where(k <= 1).select("topic_id", (k == 0).alias("ok"))).select("topic_id", "status", "retry_count")


@query(f"""WITH {_QUEUE} SELECT status, count(*) AS topics, coalesce(sum(examples), 0)::BIGINT AS examples FROM q GROUP BY 1""")
def topic_queue_statistics(spark: SparkSession, d: str) -> DataFrame:
    return topics.queue_statistics(_queue(spark, d))


@query(f"""WITH {_QUEUE} SELECT topic_id FROM q WHERE NOT (status = 'completed' AND date_diff('day', created_at, DATE '1998-12-31') > 400 OR status = 'failed' AND date_diff('day', created_at, DATE '1998-12-31') > 90)""")
def topic_retained(spark: SparkSession, d: str) -> DataFrame:
    return topics.retained(_queue(spark, d), F.lit("1998-12-31").cast("date"), 400, 90).select("topic_id")


@query("""SELECT count(*) AS topics, count(*) FILTER (topic_id >= 1000000000) AS added FROM (SELECT o_orderkey AS topic_id FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey + 1000000000 FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def topic_enqueued(spark: SparkSession, d: str) -> DataFrame:
    """Pending orders are queued already; they come again with filled and partial ones."""
    q = _queue(spark, d)
    new = q.select(F.when(F.col("status") == "completed", F.col("topic_id") + 1000000000).otherwise(F.col("topic_id")).alias("topic_id"))
    return topics.enqueued(q.where("status = 'pending'"), new).agg(F.count("*").alias("topics"), F.count_if(F.col("topic_id") >= 1000000000).alias("added"))


@query(f"""WITH {_QUEUE} SELECT topic_id, CASE domain % 4 WHEN 0 THEN 'https://docs.python.org/3/library/m ' || domain || '.html' WHEN 1 THEN 'https://huggingface.co/docs/transformers/main/en/m-' || domain WHEN 2 THEN 'https://developer.mozilla.org/en-US/docs/Web/m-' || domain ELSE 'https://devdocs.io/#q=m-' || domain END AS first,
CASE domain % 4 WHEN 1 THEN 3 WHEN 3 THEN 1 ELSE 2 END::BIGINT AS n, 'https://devdocs.io/#q=m-' || domain AS last FROM q""")
def topic_documentation(spark: SparkSession, d: str) -> DataFrame:
    """The domain gives the family: modules, model terms, web technologies, none of them."""
    q, k = _queue(spark, d), F.col("domain") % 4
    tags = F.when(k == 0, F.array(F.lit("how_to"), F.lit("python_module"), F.lit("ml_term"))).when(k == 1, F.array(F.lit("ml_term"))).when(k == 2, F.array(F.lit("web_tech"))).otherwise(F.array(F.lit("devops")))
    urls = topics.documentation_urls(tags, F.concat(F.lit("M "), F.col("domain").cast("string")))
    return q.select("topic_id", urls[0].alias("first"), F.size(urls).cast("long").alias("n"), F.element_at(urls, -1).alias("last"))


# --- samples and folds ----------------------------------------------------------------------


@query("""WITH u AS (SELECT event_id, greatest(('0x' || substr(md5('0|' || event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0, 1e-12) AS u, value FROM events) SELECT event_id FROM u WHERE value > 0 ORDER BY -ln(u) / value, event_id LIMIT 200""")
def sample_weighted(spark: SparkSession, d: str) -> DataFrame:
    return sampling.weighted(B.events(spark, d).select("event_id", "value"), 200, "event_id", F.col("value")).select("event_id")


@query("""SELECT event_id FROM events WHERE value / 100 BETWEEN 0.2 AND 0.4 ORDER BY event_id LIMIT 300""")
def sample_in_difficulty(spark: SparkSession, d: str) -> DataFrame:
    return sampling.in_difficulty(B.events(spark, d).select("event_id", (F.col("value") / 100).alias("difficulty")), 0.2, 0.4, 300, "event_id").select("event_id")


@query("""WITH e AS (SELECT event_id, value / 100 AS difficulty, user_id AS priority, ('0x' || substr(md5('0|' || event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u FROM events),
b AS (SELECT event_id FROM e ORDER BY (NOT difficulty BETWEEN 0.5 AND 0.501)::INT, CASE WHEN difficulty BETWEEN 0.5 AND 0.501 THEN u ELSE -priority END, event_id LIMIT 180),
h AS (SELECT event_id FROM e WHERE difficulty >= 0.8 AND event_id NOT IN (SELECT event_id FROM b) ORDER BY difficulty DESC, event_id LIMIT 20) SELECT event_id FROM b UNION ALL SELECT event_id FROM h""")
def sample_curriculum(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).select("event_id", (F.col("value") / 100).alias("difficulty"), F.col("user_id").cast("double").alias("priority"))
    return sampling.curriculum_batch(e, 200, 0.5, 0.501, "event_id", 20).select("event_id")


@query("""SELECT client_id FROM (SELECT client_id, ('0x' || substr(md5('3|' || client_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 AS u FROM (SELECT DISTINCT user_id AS client_id FROM events)) ORDER BY u, client_id LIMIT 10""")
def clients_random(spark: SparkSession, d: str) -> DataFrame:
    return sampling.clients(B.events(spark, d).select(F.col("user_id").alias("client_id")).distinct(), 10, "random", 3)


@query("""WITH c AS (SELECT user_id AS client_id, row_number() OVER (ORDER BY user_id) - 1 AS n, count(*) OVER () AS a FROM (SELECT DISTINCT user_id FROM events)) SELECT client_id FROM c WHERE ((n - 30) % a + a) % a < 10""")
def clients_round_robin(spark: SparkSession, d: str) -> DataFrame:
    return sampling.clients(B.events(spark, d).select(F.col("user_id").alias("client_id")).distinct(), 10, "round_robin", 3).select("client_id")


@query("""SELECT user_id AS client_id FROM events GROUP BY 1 ORDER BY avg(value), 1 LIMIT 10""")
def clients_by_loss(spark: SparkSession, d: str) -> DataFrame:
    c = B.events(spark, d).groupBy(F.col("user_id").alias("client_id")).agg(F.avg("value").alias("mean_loss"))
    return sampling.clients(c, 10, "loss").select("client_id")


_SERIES = """s AS (SELECT user_id AS run, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)"""


def _series(spark: SparkSession, d: str, value) -> DataFrame:
    return B.events(spark, d).groupBy(F.col("user_id").alias("run")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", value.alias("x")))), lambda e: e["x"]).alias("xs"))


@query(f"""WITH {_SERIES}, b AS (SELECT *, value < coalesce(min(value) OVER (PARTITION BY run ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'inf'::DOUBLE) AS better FROM s),
l AS (SELECT *, i - max(CASE WHEN better THEN i END) OVER (PARTITION BY run ORDER BY i) AS bad FROM b) SELECT run, min(i) FILTER (bad >= 5)::INT AS stop FROM l GROUP BY 1""")
def early_stopping(spark: SparkSession, d: str) -> DataFrame:
    return _series(spark, d, F.col("value").cast("double")).select("run", sampling.early_stop(F.col("xs"), 5).alias("stop"))


@query(f"""WITH {_SERIES}, b AS (SELECT *, value / 100 > coalesce(max(value / 100) OVER (PARTITION BY run ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '-inf'::DOUBLE) AS better, avg(value / 100) OVER (PARTITION BY run ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent FROM s),
l AS (SELECT *, i - max(CASE WHEN better THEN i END) OVER (PARTITION BY run ORDER BY i) AS bad FROM b) SELECT run, i AS epoch, bad AS stale, bad >= 3 OR recent >= 0.9 AS advance FROM l""")
def stage_advances(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    rows = B.events(spark, d).select(F.col("user_id").alias("run"), n.alias("epoch"), (F.col("value") / 100).alias("reward"))
    return sampling.stage_advances(rows, "run", "epoch", "reward", min_improvement=0.0).select("run", F.col("epoch").cast("long"), F.col("stale").cast("long"), "advance")


@query(f"""WITH RECURSIVE {_SERIES}, n AS (SELECT *, lead(value) OVER (PARTITION BY run ORDER BY i) AS nxt, max(i) OVER (PARTITION BY run) AS z FROM s),
g(run, i, gae) AS (SELECT run, i, value / 10 - value FROM n WHERE i = z UNION ALL SELECT n.run, n.i, n.value / 10 + 0.99 * n.nxt - n.value + 0.99 * 0.95 * g.gae FROM g JOIN n ON n.run = g.run AND n.i = g.i - 1)
SELECT run, i AS step, round(gae, 3) AS advantage FROM g""")
def advantage_estimates(spark: SparkSession, d: str) -> DataFrame:
    """Rewards are a tenth of the values; no step ends an episode."""
    step = F.struct((F.col("value") / 10).cast("double").alias("reward"), F.col("value").cast("double").alias("value"), F.lit(False).alias("done"))
    rows = _series(spark, d, step).select("run", F.posexplode(sampling.advantages(F.col("xs"))).alias("step", "advantage"))
    return rows.select("run", F.col("step").cast("long"), F.round("advantage", 3).alias("advantage"))


@query("""WITH RECURSIVE s AS (SELECT event_type AS run, value, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events), n AS (SELECT *, lead(value) OVER (PARTITION BY run ORDER BY i) AS nxt, max(i) OVER (PARTITION BY run) AS z FROM s),
g(run, i, event_id, gae) AS (SELECT run, i, event_id, value / 10 - value FROM n WHERE i = z UNION ALL SELECT n.run, n.i, n.event_id, n.value / 10 + CASE WHEN n.event_id % 50 = 0 THEN 0 ELSE 0.99 * n.nxt END - n.value + CASE WHEN n.event_id % 50 = 0 THEN 0 ELSE 0.99 * 0.95 * g.gae END FROM g JOIN n ON n.run = g.run AND n.i = g.i - 1)
SELECT event_id, round(gae, 3) AS advantage FROM g""")
def advantages_in_parts(spark: SparkSession, d: str) -> DataFrame:
    """Few long runs, one for each type of event; an event of fifty ends an episode."""
    rows = B.events(spark, d).select("event_id", "ts", F.col("event_type").alias("run"), "value", (F.col("value") / 10).alias("reward"), (F.col("event_id") % 50 == 0).alias("done"))
    return series.advantages(rows, ["run"], ["ts", "event_id"], part_rows=4096).select("event_id", F.round("advantage", 3).alias("advantage"))


@query(f"""WITH {_SERIES}, a AS (SELECT run, avg(value) AS m, stddev_pop(value) AS sd FROM s GROUP BY 1) SELECT run, i AS step, round((value - m) / (sd + 1e-8), 4) AS z FROM s JOIN a USING (run)""")
def advantages_normalised(spark: SparkSession, d: str) -> DataFrame:
    rows = _series(spark, d, F.col("value").cast("double")).select("run", F.posexplode(sampling.z_normalised(F.col("xs"))).alias("step", "z"))
    return rows.select("run", F.col("step").cast("long"), F.round("z", 4).alias("z"))


@query("""WITH RECURSIVE s AS (SELECT doc_id, source, n_chars // 4 AS tokens, row_number() OVER (PARTITION BY source ORDER BY n_chars // 4 DESC, doc_id) AS i FROM documents),
f(source, i, doc_id, batch, filled, items) AS (SELECT source, i, doc_id, 0::BIGINT, tokens, 1 FROM s WHERE i = 1
UNION ALL SELECT s.source, s.i, s.doc_id, CASE WHEN f.filled + s.tokens > 4096 OR f.items >= 32 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.filled + s.tokens > 4096 OR f.items >= 32 THEN s.tokens ELSE f.filled + s.tokens END, CASE WHEN f.filled + s.tokens > 4096 OR f.items >= 32 THEN 1 ELSE f.items + 1 END
FROM f JOIN s ON s.source IS NOT DISTINCT FROM f.source AND s.i = f.i + 1) SELECT doc_id, source, batch FROM f""")
def length_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source", F.floor(F.col("n_chars") / 4).alias("tokens"))
    return series.length_batches(rows, "doc_id", "tokens", 4096, 32, "source").select("doc_id", "source", "batch")


# --- datasets and federated rounds ---------------------------------------------------------


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'changed' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT c_custkey + 1000000000, 'changed' FROM customer WHERE c_custkey % 3 = 0 AND c_acctbal < 0""")
def dataset_upserted(spark: SparkSession, d: str) -> DataFrame:
    """Every third customer changes, those in debt also come as new ones, and every fifth is deleted."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.lit(0).alias("seq"), "c_acctbal")
    changed = c.where("c_custkey % 3 = 0").withColumn("segment", F.lit("changed"))
    changes = changed.unionByName(changed.withColumns({"segment": F.lit("older"), "seq": F.lit(-1)})).unionByName(changed.where("c_acctbal < 0").withColumn("c_custkey", F.col("c_custkey") + 1000000000))
    return datasets.delete(datasets.upsert(c, changes, ["c_custkey"], "seq"), c.where("c_custkey % 5 = 0").select("c_custkey")).select("c_custkey", "segment")


@query("""SELECT version, substr(sha256(config), 1, 16) AS digest, config FROM (VALUES (1, 'a'), (2, 'b'), (3, 'a')) t(version, config)""")
def config_versions(spark: SparkSession, d: str) -> DataFrame:
    empty = spark.createDataFrame([], "version int, digest string, config string")
    two = datasets.new_version(datasets.new_version(empty, "a"), "b")
    return datasets.rolled_back(two, 1).select("version", F.substring("digest", 1, 16).alias("digest"), "config")


@query("""SELECT client_id FROM (SELECT user_id AS client_id, max(event_id) % 9 AS round FROM events GROUP BY 1) WHERE 8 - round <= 2""")
def federated_fresh(spark: SparkSession, d: str) -> DataFrame:
    u = B.events(spark, d).groupBy(F.col("user_id").alias("client_id")).agg((F.max("event_id") % 9).alias("round"))
    return federated.fresh(u, 8, 2).select("client_id")


@query("""WITH c AS (SELECT user_id % 6 AS round, user_id AS client, max(event_id) AS n, max(value) AS loss FROM events GROUP BY 1, 2) SELECT round, count(*) AS clients, sum(n)::BIGINT AS samples, round(avg(loss), 4) AS loss FROM c GROUP BY 1""")
def federated_round_metrics(spark: SparkSession, d: str) -> DataFrame:
    u = B.events(spark, d).select((F.col("user_id") % 6).alias("round"), F.col("user_id").alias("client_id"), F.col("event_id").alias("num_samples"), F.col("value").alias("loss"))
    return _round(federated.round_metrics(u), "loss")


@query("""SELECT event_id, round(CASE strategy WHEN 'immediate' THEN 0 WHEN 'fixed' THEN 0.1 ELSE least(10, 0.1 * pow(2, attempt)) END, 6) AS delay FROM (SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'immediate' WHEN 1 THEN 'fixed' ELSE 'exponential' END AS strategy, event_id % 10 AS attempt FROM events)""")
def retry_delays(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("user_id") % 3
    strategy = F.when(m == 0, "immediate").when(m == 1, "fixed").otherwise("exponential")
    return B.events(spark, d).select("event_id", F.round(S.retry_delay(strategy, F.col("event_id") % 10), 6).alias("delay"))


@query("""SELECT p_partkey FROM part WHERE (p_partkey % 3, p_size % 12) > (1, 5)""")
def version_comparison(spark: SparkSession, d: str) -> DataFrame:
    version = F.concat_ws(".", F.col("p_partkey") % 3, F.col("p_size") % 12, F.lit(0))
    return table(spark, d, "part").where(semantic_version(version) > semantic_version(F.lit("v1.5.0"))).select("p_partkey")


# --- runs, buffers and strategies -----------------------------------------------------------

_RUNS = "r AS (SELECT user_id % 6 AS kind, event_type <> 'error' AS ok, value AS seconds, event_id % 4 + 1 AS attempts, user_id AS items FROM events)"


@query(f"""WITH {_RUNS} SELECT kind, count(*) AS runs, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, round(avg(ok::INT), 4) AS success_rate, round(avg(seconds), 4) AS avg_seconds, max(seconds) AS max_seconds, sum(attempts - 1)::BIGINT AS retries, round(sum(items) / sum(seconds), 4) AS items_per_s FROM r GROUP BY 1""")
def run_statistics(spark: SparkSession, d: str) -> DataFrame:
    r = B.events(spark, d).select((F.col("user_id") % 6).alias("kind"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("seconds"), (F.col("event_id") % 4 + 1).alias("attempts"), F.col("user_id").alias("items"))
    return _round(telemetry.run_statistics(r, "kind"), "success_rate", "avg_seconds", "items_per_s")


@query("""WITH f AS (SELECT user_id % 8 AS run, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'blocked' WHEN 'view' THEN 'queued' ELSE 'fetched' END AS status, ts FROM events)
SELECT run, count(*) AS total, count(*) FILTER (status = 'fetched') AS fetched, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'blocked') AS blocked, round(count(*) FILTER (status = 'fetched') / count(*) FILTER (status IN ('fetched', 'failed')), 4) AS success_rate, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 2) AS seconds FROM f GROUP BY 1""")
def scout_progress(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    status = F.when(t == "error", "failed").when(t == "signup", "blocked").when(t == "view", "queued").otherwise("fetched")
    f = B.events(spark, d).select((F.col("user_id") % 8).alias("run"), status.alias("status"), F.col("ts").alias("started"), F.col("ts").alias("ended"))
    return telemetry.progress(f, "run").withColumns({"success_rate": F.round("success_rate", 4), "seconds": F.round("seconds", 2)})


@query("""SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 250""")
def ring_buffer(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.ring(B.events(spark, d), 250, ("event_type",), "ts", "event_id").select("event_id")


@query("""SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WHERE n <= 100""")
def queue_admission(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.admitted(B.events(spark, d), 100, "drop_newest", ("event_type",), "ts", "event_id").select("event_id")


@query(f"""WITH {B.UPDATES_SQL}, m AS (SELECT param, idx, round(list_sort(list(weight))[(count(*) + 1) // 2], 4) AS weight FROM updates GROUP BY 1, 2), a AS (SELECT param, idx, round(sum(weight * num_samples) / sum(num_samples), 4) AS weight FROM updates GROUP BY 1, 2)
SELECT 'median' AS strategy, * FROM m UNION ALL SELECT 'average', * FROM a""")
def federated_strategies(spark: SparkSession, d: str) -> DataFrame:
    u = B.updates(spark, d)
    one = lambda s: federated.aggregated(u, s).select(F.lit(s).alias("strategy"), "param", "idx", F.round("weight", 4).alias("weight"))
    return one("median").unionByName(one("average"))


@query("""WITH r AS (SELECT event_id, CASE event_type WHEN 'click' THEN ' b) because' WHEN 'view' THEN 'The answer' WHEN 'purchase' THEN '(D)' WHEN 'error' THEN 'xx C' ELSE 'a' END AS reply, user_id % 4 AS k FROM events)
SELECT event_id, CASE trim(reply) WHEN 'b) because' THEN 'B' WHEN '(D)' THEN 'D' WHEN 'a' THEN 'A' END AS answer, 'Q' || event_id || chr(10) || 'A. one' || chr(10) || 'B. two' || chr(10) || 'Answer:' AS prompt, CASE k WHEN 0 THEN length(reply) > 5 WHEN 1 THEN contains(reply, 'C') END AS passed FROM r""")
def choice_answers(spark: SparkSession, d: str) -> DataFrame:
    """Replies by the event's type; the user's remainder names the predicate of a case."""
    t, k = F.col("event_type"), F.col("user_id") % 4
    reply = F.when(t == "click", " b) because").when(t == "view", "The answer").when(t == "purchase", "(D)").when(t == "error", "xx C").otherwise("a")
    cases = B.events(spark, d).select("event_id", reply.alias("reply"), F.when(k == 0, "long").when(k == 1, "has_c").otherwise("other").alias("evaluator"))
    rows = evaluation.evaluated(cases, {"long": lambda r: F.length(r) > 5, "has_c": lambda r: r.contains("C")})
    prompt = evaluation.choice_prompt(F.concat(F.lit("Q"), "event_id"), F.array(F.lit("one"), F.lit("two")))
    return rows.select("event_id", evaluation.choice_answer(F.col("reply")).alias("answer"), prompt.alias("prompt"), "passed")


@query("""WITH RECURSIVE e AS (SELECT n_nationkey // 2 AS source, n_nationkey AS target FROM nation WHERE n_nationkey > 0), c(node, depth) AS (SELECT 0::BIGINT, 0 UNION ALL SELECT e.target, c.depth + 1 FROM c JOIN e ON e.source = c.node)
SELECT max(depth) AS steps, count(DISTINCT node) AS components FROM c""")
def longest_dependency_chain(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").where("n_nationkey > 0")
    return registry.longest_chain(n.select((F.col("n_nationkey") / 2).cast("long").alias("source"), F.col("n_nationkey").cast("long").alias("target")))


@query("""SELECT doc_id, round(least(1, length(text) / 512), 4) AS difficulty FROM documents""")
def scored_difficulty(spark: SparkSession, d: str) -> DataFrame:
    return _round(sampling.with_difficulty(table(spark, d, "documents"), "length").select("doc_id", "difficulty"), "difficulty")


@query()
def cluster_representatives(spark: SparkSession, d: str) -> DataFrame:
    """Ten vectors, each the nearest to the centre of its cluster."""
    return sampling.clustered(table(spark, d, "embeddings"), 10, "vec_id", "embedding").select("vec_id", "cluster")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def customers_without_urgent_orders(spark: SparkSession, d: str) -> DataFrame:
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(urgent, "c_custkey", "left_anti").select("c_custkey")


@query("""SELECT event_id FROM events WHERE value / 100 BETWEEN 3000 AND 4000 OR NOT EXISTS (SELECT 1 FROM events WHERE value / 100 BETWEEN 3000 AND 4000)""")
def sample_out_of_range(spark: SparkSession, d: str) -> DataFrame:
    """No value is in the range, so all rows are taken."""
    return sampling.in_difficulty(B.events(spark, d).select("event_id", (F.col("value") / 100).alias("difficulty")), 3000.0, 4000.0).select("event_id")


@query("""WITH a AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'critical' WHEN 'signup' THEN 'error' ELSE 'info' END AS severity FROM events), c(channel, level) AS (VALUES ('chat', 'critical'), ('chat', 'error'), ('hook', 'critical'))
SELECT channel, '{"event_id":' || event_id || ',"severity":"' || severity || '"}' AS payload FROM a JOIN c ON level = severity""")
def alert_notifications(spark: SparkSession, d: str) -> DataFrame:
    severity = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "signup", "error").otherwise("info")
    return telemetry.notifications(B.events(spark, d).select("event_id", severity.alias("severity")), {"chat": ["critical", "error"], "hook": ["critical"]})
