"""Telemetry, health, evaluation, cost and aggregation queries over events and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import statistics as ST
from ..functions.hashing import short_md5
from ..operators import auth, costs, evaluation, federated, graph, health, registry, sampling, telemetry
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


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _windows_sql(seconds: int) -> str:
    return f"""SELECT time_bucket(INTERVAL {seconds} SECOND, ts::TIMESTAMP) AS window_start, event_type AS name, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 4) AS mean, min(value) AS low, max(value) AS high,
round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.9), 4) AS p90, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99 FROM events GROUP BY 1, 2"""


def _windows(seconds: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = telemetry.windowed(B.metrics(spark, d), seconds)
        return _rounded(rows, "total", "mean", "p50", "p90", "p95", "p99").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))

    return run


for _seconds in (60, 300, 3600):
    QUERIES[f"metric_windows_{_seconds}s"], ORACLES[f"metric_windows_{_seconds}s"] = _windows(_seconds), _windows_sql(_seconds)


@query("""SELECT time_bucket(INTERVAL 3600 SECOND, ts::TIMESTAMP) AS window_start, event_type AS name, count(*) AS n, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high FROM events GROUP BY 1, 2""")
def metric_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Hours from minutes: the minute sums are the only shuffle of raw rows."""
    minutes = telemetry.windowed(B.metrics(spark, d), 60, with_percentiles=False)
    rows = _rounded(telemetry.rolled_up(minutes, 3600), "total").drop("mean")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""SELECT event_type AS name, count(*) AS n, min(value) AS low, max(value) AS high, round(avg(value), 4) AS mean, round(median(value), 4) AS median, round(stddev_samp(value), 4) AS sd,
list_sort(list(value))[least(floor(count(*) * 0.5)::INT + 1, count(*))] AS p50, list_sort(list(value))[least(floor(count(*) * 0.9)::INT + 1, count(*))] AS p90,
list_sort(list(value))[least(floor(count(*) * 0.95)::INT + 1, count(*))] AS p95, list_sort(list(value))[least(floor(count(*) * 0.99)::INT + 1, count(*))] AS p99
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k <= 1000 GROUP BY 1""")
def collector_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(telemetry.collector_statistics(B.metrics(spark, d), ("name",), 1000, "ts", "event_id"), "mean", "median", "sd")


@query("""SELECT event_type AS name, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1""")
def gauges_latest(spark: SparkSession, d: str) -> DataFrame:
    return B.metrics(spark, d).groupBy("name").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


_Z = """w AS (SELECT event_id, event_type AS name, value, avg(value) OVER f AS mean, stddev_samp(value) OVER f AS sd, count(value) OVER f AS samples FROM events WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW))"""


@query(f"""WITH {_Z} SELECT event_id, name, round((value - mean) / sd, 4) AS z, CASE WHEN abs((value - mean) / sd) > 4.5 THEN 'critical' ELSE 'warning' END AS severity FROM w WHERE samples >= 20 AND sd > 0 AND abs((value - mean) / sd) > 3""")
def metric_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.anomalies(B.metrics(spark, d), ("name",), ("ts", "event_id"), split_seconds=86400).select("event_id", "name", F.round("z", 4).alias("z"), "severity")


@query(f"""WITH {_Z}, b AS (SELECT event_type AS name, avg(value) AS bm, stddev_samp(value) AS bs FROM events GROUP BY 1),
t AS (SELECT event_id, name, (mean - bm) / sqrt(sd * sd / samples + bs * bs / 100) AS t, (mean - bm) / bm * 100 AS c FROM w JOIN b USING (name) WHERE samples >= 30)
SELECT event_id, name, round(c, 4) AS change_percent, CASE WHEN abs(c) > 20 THEN 'critical' WHEN abs(c) > 10 THEN 'high' WHEN abs(c) > 5 THEN 'medium' ELSE 'low' END AS severity FROM t WHERE abs(t) > 1.959963985""")
def metric_drift(spark: SparkSession, d: str) -> DataFrame:
    m = B.metrics(spark, d)
    base = m.groupBy("name").agg(F.avg("value").alias("base_mean"), F.stddev_samp("value").alias("base_sd"))
    return telemetry.drift(m, base, ("name",), ("ts", "event_id"), split_seconds=86400).select("event_id", "name", F.round("change_percent", 4).alias("change_percent"), "severity")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 3600 SECOND THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM g) SELECT user_id, session::BIGINT AS session, min(ts)::TIMESTAMP AS started, max(ts)::TIMESTAMP AS ended, count(*) AS events FROM n GROUP BY 1, 2""")
def correlation_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = telemetry.sessions(B.events(spark, d), "user_id")
    return s.withColumns({"started": F.col("started").cast("timestamp_ntz"), "ended": F.col("ended").cast("timestamp_ntz")})


@query("""SELECT user_id, string_agg(event_type, '>' ORDER BY ts, event_id) AS path, count(*) AS n FROM events GROUP BY 1""")
def correlation_chain(spark: SparkSession, d: str) -> DataFrame:
    c = telemetry.chain(B.events(spark, d), "user_id", "ts", "event_id", "event_type")
    return c.select("user_id", F.array_join(F.transform("chain", lambda x: x["event_type"]), ">").alias("path"), F.size("chain").cast("long").alias("n"))


@query(f"""WITH {B.CHECKS_SQL}, g AS (SELECT component, ts, lead(ts) OVER (PARTITION BY component ORDER BY ts) AS nxt FROM checks)
SELECT component, ts::TIMESTAMP AS ts, floor((epoch_us(nxt::TIMESTAMP) - epoch_us(ts::TIMESTAMP)) / 1e6 / 3600)::BIGINT AS missed FROM g WHERE (epoch_us(nxt::TIMESTAMP) - epoch_us(ts::TIMESTAMP)) / 1e6 > 3 * 3600""")
def heartbeat_gaps(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.heartbeat_gaps(B.checks(spark, d), "component", 3600.0).select("component", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("missed").cast("long"))


_INC = f"""{B.CHECKS_SQL}, c AS (SELECT *, lag(status) OVER w AS before FROM checks WINDOW w AS (PARTITION BY component ORDER BY ts, event_id)),
r AS (SELECT * FROM c WHERE (status = 'unhealthy' AND coalesce(before, '') <> 'unhealthy') OR (status = 'healthy' AND before = 'unhealthy')),
n AS (SELECT component, ts, status, lead(status) OVER w AS ns, lead(ts) OVER w AS nt FROM r WINDOW w AS (PARTITION BY component ORDER BY ts, event_id)),
inc AS (SELECT component, ts::TIMESTAMP AS started, (CASE WHEN ns = 'healthy' THEN nt END)::TIMESTAMP AS resolved FROM n WHERE status = 'unhealthy')"""


@query(f"""WITH {_INC} SELECT component, started, resolved, round((epoch_us(resolved) - epoch_us(started)) / 1e6, 3) AS seconds FROM inc""")
def health_incidents(spark: SparkSession, d: str) -> DataFrame:
    i = health.incidents(B.checks(spark, d), "event_id")
    return i.select("component", F.col("started").cast("timestamp_ntz").alias("started"), F.col("resolved").cast("timestamp_ntz").alias("resolved"), F.round("seconds", 3).alias("seconds"))


@query(f"""WITH {_INC}, u AS (SELECT component, count(*) AS checks, avg((status <> 'unhealthy')::INT) * 100 AS up, avg(latency_ms) AS a, quantile_cont(latency_ms, 0.99) AS p FROM checks GROUP BY 1),
x AS (SELECT component, count(*) AS incidents, sum((epoch_us(coalesce(resolved, TIMESTAMP '2030-01-01')) - epoch_us(started)) / 1e6) AS down FROM inc GROUP BY 1)
SELECT component, checks, round(up, 4) AS uptime_percent, round(a, 4) AS avg_latency_ms, round(p, 4) AS p99_latency_ms, coalesce(incidents, 0) AS incidents, round(coalesce(down, 0), 2) AS downtime_seconds, up >= 75 AS compliant FROM u LEFT JOIN x USING (component)""")
def health_sla(spark: SparkSession, d: str) -> DataFrame:
    rows = health.sla(B.checks(spark, d), F.lit("2030-01-01 00:00:00").cast("timestamp"), None, 75.0, "event_id")
    return _rounded(_rounded(rows, "uptime_percent", "avg_latency_ms", "p99_latency_ms"), "downtime_seconds", digits=2)


@query(f"""WITH {B.CHECKS_SQL} SELECT component, round(avg((status IN ('healthy', 'degraded'))::INT) * 100, 4) AS uptime_percent FROM checks GROUP BY 1""")
def health_uptime(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(health.uptime(B.checks(spark, d)), "uptime_percent")


@query(f"""WITH {B.CHECKS_SQL}, r AS (SELECT *, sum((status <> 'unhealthy')::INT) OVER (PARTITION BY component ORDER BY ts, event_id) AS run FROM checks)
SELECT event_id, sum((status = 'unhealthy')::INT) OVER (PARTITION BY component, run ORDER BY ts, event_id)::BIGINT AS failures FROM r""")
def health_failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    return health.failure_streaks(B.checks(spark, d), "event_id").select("event_id", F.col("failures").cast("long"))


@query(f"""WITH {B.CHECKS_SQL}, c AS (SELECT *, coalesce(lag(status) OVER (PARTITION BY component ORDER BY ts, event_id), 'unknown') AS before FROM checks)
SELECT event_id, before, status, CASE WHEN status = 'unhealthy' THEN 'error' WHEN status = 'degraded' THEN 'warning' ELSE 'info' END AS severity FROM c
WHERE (status <> before OR before = 'unknown') AND (status <> 'healthy' OR before IN ('unhealthy', 'degraded'))""")
def health_alert_candidates(spark: SparkSession, d: str) -> DataFrame:
    return health.alert_candidates(B.checks(spark, d), "event_id").select("event_id", "before", "status", "severity")


@query(f"""WITH {B.CHECKS_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY ts DESC, event_id DESC) AS k FROM checks)
SELECT component, round(avg(latency_ms), 4) AS mean_ms, round(quantile_cont(latency_ms, 0.95), 4) AS p95_ms, count(*) AS n FROM l WHERE k <= 100 GROUP BY 1""")
def health_latency_trend(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(health.latency_trend(B.checks(spark, d), 100, "event_id"), "mean_ms", "p95_ms")


def _prices_sql() -> str:
    rows = ", ".join(f"('{m}', {i}::DOUBLE, {o}::DOUBLE, {k})" for k, (m, i, o) in enumerate(costs.PRICES))
    return f"prices(model_id, pi, po, ord) AS (VALUES {rows})"


_PRICED = f"""{B.USAGE_SQL}, {_prices_sql()}, f AS (SELECT model, arg_min({{'i': pi, 'o': po}}, (CASE WHEN model = model_id THEN 0 ELSE 1 END, ord)) AS p FROM (SELECT DISTINCT model FROM usage) JOIN prices ON contains(model, model_id) OR contains(model_id, model) GROUP BY 1),
priced AS (SELECT usage.*, coalesce(input_tokens / 1000 * p.i + output_tokens / 1000 * p.o, (input_tokens + output_tokens) * 1e-5) AS cost FROM usage LEFT JOIN f USING (model))"""


@query(f"""WITH {_PRICED} SELECT model, operation, count(*) AS requests, sum(input_tokens)::BIGINT AS input_tokens, sum(output_tokens)::BIGINT AS output_tokens, round(sum(cost), 4) AS cost FROM priced GROUP BY GROUPING SETS ((model), (operation), ())""")
def cost_report(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(costs.report(costs.priced(B.usage(spark, d), costs.price_table(spark))), "cost")


@query(f"""WITH {_PRICED} SELECT event_id, round(sum(cost) OVER (PARTITION BY operation ORDER BY timestamp, event_id), 8) AS spent FROM priced""")
def cost_running(spark: SparkSession, d: str) -> DataFrame:
    rows = costs.running_budget(costs.priced(B.usage(spark, d), costs.price_table(spark)), 1.0, "operation", "timestamp", "event_id")
    return _rounded(rows.select("event_id", "spent"), "spent", digits=8)


@query(f"""WITH {_PRICED} SELECT round(sum(cost), 4) AS spent, round(greatest(0, 50 - sum(cost)), 4) AS remaining, round(sum(cost) / 50 * 100, 4) AS used_percent, sum(cost) >= 50 AS over FROM priced""")
def cost_budget(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(costs.budget(costs.priced(B.usage(spark, d), costs.price_table(spark)), 50.0), "spent", "remaining", "used_percent")


@query("""WITH s AS (SELECT event_type AS test_id, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS variant, value FROM events),
v AS (SELECT test_id, variant, count(*) AS n, avg(value) AS m, coalesce(stddev_samp(value), 0) AS s FROM s GROUP BY 1, 2),
r AS (SELECT a.test_id, a.n AS n_a, b.n AS n_b, a.m AS mean_a, b.m AS mean_b, (a.m - b.m) / sqrt(a.s * a.s / a.n + b.s * b.s / b.n) AS t FROM v a JOIN v b ON a.test_id = b.test_id AND a.variant = 'a' AND b.variant = 'b')
SELECT test_id, n_a, n_b, round(mean_a, 4) AS mean_a, round(mean_b, 4) AS mean_b, round(t, 4) AS t, abs(t) > 1.959963985 AS significant, CASE WHEN abs(t) > 1.959963985 THEN CASE WHEN mean_a > mean_b THEN 'a' ELSE 'b' END END AS winner FROM r""")
def ab_test(spark: SparkSession, d: str) -> DataFrame:
    s = B.events(spark, d).select(F.col("event_type").alias("test_id"), F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("variant"), "value")
    return _rounded(evaluation.ab_result(s), "mean_a", "mean_b", "t").select("test_id", "n_a", "n_b", "mean_a", "mean_b", "t", "significant", "winner")


@query("""WITH b AS (SELECT event_type AS metric, avg(value) AS v FROM events WHERE user_id % 2 = 0 GROUP BY 1), c AS (SELECT event_type AS metric, avg(value) AS v FROM events WHERE user_id % 2 = 1 AND event_type <> 'signup' GROUP BY 1)
SELECT metric, round(b.v, 4) AS baseline, round(c.v, 4) AS candidate, round(c.v - b.v, 4) AS diff, round((c.v - b.v) / b.v * 100, 4) AS pct_change, coalesce(c.v - b.v < -0.02, false) AS regression FROM b LEFT JOIN c USING (metric)""")
def eval_compare(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d)
    side = lambda k: e.where(F.col("user_id") % 2 == k).groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    return _rounded(evaluation.compare(side(0), side(1).where("metric <> 'signup'")), "baseline", "candidate", "diff", "pct_change")


@query("""WITH m AS (SELECT user_id % 20 AS run_id, event_type AS metric, avg(value) AS value FROM events GROUP BY 1, 2),
c(name, metric, threshold, comparison, required) AS (VALUES ('clicks', 'click', 40.0, '>=', true), ('errors', 'error', 60.0, '<', false), ('views', 'view', 45.0, '>', false), ('gone', 'absent', 1.0, '>=', false)),
r AS (SELECT run_id, name, required, CASE WHEN value IS NULL THEN NOT required ELSE CASE comparison WHEN '>=' THEN value >= threshold WHEN '>' THEN value > threshold ELSE value < threshold END END AS ok FROM (SELECT DISTINCT run_id FROM m) CROSS JOIN c LEFT JOIN m USING (run_id, metric)),
g AS (SELECT run_id, avg(ok::INT) AS pass_rate, count(*) FILTER (required AND NOT ok) AS required_failed FROM r GROUP BY 1)
SELECT run_id, round(pass_rate, 4) AS pass_rate, required_failed, CASE WHEN required_failed > 0 THEN 'rejected' WHEN pass_rate >= 0.8 THEN 'approved' WHEN pass_rate >= 0.6 THEN 'pending_review' ELSE 'rejected' END AS status FROM g""")
def eval_approval(spark: SparkSession, d: str) -> DataFrame:
    m = B.events(spark, d).groupBy((F.col("user_id") % 20).alias("run_id"), F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    criteria = spark.createDataFrame(
        [("clicks", "click", 40.0, ">=", True), ("errors", "error", 60.0, "<", False), ("views", "view", 45.0, ">", False), ("gone", "absent", 1.0, ">=", False)], "name string, metric string, threshold double, comparison string, required boolean"
    )
    return _rounded(evaluation.approval(evaluation.criteria_results(criteria, m)), "pass_rate").select("run_id", "pass_rate", "required_failed", "status")


@query("""SELECT event_type AS category, round(avg((value > 50)::INT), 4) AS pass_rate, round(avg(value), 4) AS avg_score, count(*) AS n FROM events GROUP BY GROUPING SETS ((event_type), ())""")
def eval_pass_rates(spark: SparkSession, d: str) -> DataFrame:
    rows = B.events(spark, d).select(F.col("event_type").alias("category"), (F.col("value") > 50).alias("passed"), F.col("value").alias("score"))
    return _rounded(evaluation.pass_rates(rows), "pass_rate", "avg_score")


@query("""SELECT round(avg(hit::INT), 4) AS pass_at_k, count(*) AS tasks FROM (SELECT user_id, bool_or(value > 90) FILTER (k <= 3) AS hit FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) GROUP BY 1)""")
def eval_pass_at_k(spark: SparkSession, d: str) -> DataFrame:
    rows = B.events(spark, d).select(F.col("user_id").alias("task"), F.col("event_id").alias("attempt"), (F.col("value") > 90).alias("passed"))
    return _rounded(evaluation.pass_at_k(rows, 3), "pass_at_k")


@query("""WITH v AS (SELECT user_id AS request, event_type AS answer, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2) SELECT request, arg_max(answer, (n, -f)) AS answer, max(n) AS votes FROM v GROUP BY 1""")
def ensemble_majority(spark: SparkSession, d: str) -> DataFrame:
    votes = B.events(spark, d).select(F.col("user_id").alias("request"), F.col("event_type").alias("answer"), F.col("event_id").alias("ord"), F.col("value").alias("latency_ms"))
    return evaluation.majority(votes).select("request", "answer", "votes")


@query("""WITH r AS (SELECT value, value / 100 AS c, event_type FROM events)
SELECT count(*) AS total, count(*) FILTER (event_type <> 'error') AS successful, round(avg((event_type <> 'error')::INT) * 100, 4) AS success_rate, round(avg(c), 4) AS avg_final_confidence, count(*) FILTER (value > 99) AS spoofing,
CASE WHEN pts = 0 THEN 'minimal' WHEN pts <= 2 THEN 'low' WHEN pts <= 4 THEN 'moderate' WHEN pts <= 6 THEN 'high' ELSE 'critical' END AS risk
FROM r, (SELECT CASE WHEN avg((event_type <> 'error')::INT) * 100 < 50 THEN 3 WHEN avg((event_type <> 'error')::INT) * 100 < 70 THEN 2 ELSE 0 END + CASE WHEN count(*) FILTER (value > 99) > 0 THEN 2 ELSE 0 END + CASE WHEN avg(c) < 0.7 THEN 1 ELSE 0 END AS pts FROM r) GROUP BY pts""")
def auth_metrics(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("value") / 100
    rows = B.events(spark, d).select(
        F.col("event_id").cast("string").alias("request_id"), (F.col("event_type") != "error").alias("authenticated"), *[c.alias(f) for f in auth.FACTORS], (F.col("value") > 99).alias("spoofing_detected"), F.lit(False).alias("visual_threat_detected"),
        F.lit(True).alias("liveness_passed"), F.col("value").alias("execution_time_ms"), F.lit("full").alias("analysis_mode_used"), F.array().cast("array<string>").alias("reasoning_chain"),
    )
    return _rounded(auth.metrics(rows), "success_rate", "avg_final_confidence").select("total", "successful", "success_rate", "avg_final_confidence", "spoofing", "risk")


@query(f"""WITH {B.UPDATES_SQL} SELECT param, idx, round(sum(weight * num_samples) / sum(num_samples), 4) AS weight FROM updates GROUP BY 1, 2""")
def federated_average(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(federated.averaged(B.updates(spark, d)), "weight").drop("round")


@query(f"""WITH {B.UPDATES_SQL} SELECT param, idx, round(list_sort(list(weight))[(count(*) + 1) // 2], 4) AS weight FROM updates GROUP BY 1, 2""")
def federated_median(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(federated.median(B.updates(spark, d)), "weight").drop("round")


@query(f"""WITH {B.UPDATES_SQL}, r AS (SELECT param, idx, weight, row_number() OVER (PARTITION BY param, idx ORDER BY weight) AS k, count(*) OVER (PARTITION BY param, idx) AS n FROM updates)
SELECT param, idx, round(avg(weight), 4) AS weight FROM r WHERE k > floor(n * 0.2 / 2) AND k <= n - floor(n * 0.2 / 2) GROUP BY 1, 2""")
def federated_trimmed(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(federated.trimmed(B.updates(spark, d)), "weight").drop("round")


@query(f"""WITH {B.UPDATES_SQL}, p AS (SELECT a.client_id AS a, b.client_id AS b, sqrt(sum((a.weight - b.weight) ** 2)) AS d FROM updates a JOIN updates b USING (param, idx) WHERE a.client_id <> b.client_id GROUP BY 1, 2),
k AS (SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d, b) AS r, count(*) OVER (PARTITION BY a) + 1 AS n FROM p), s AS (SELECT a, sum(d) AS score FROM k WHERE r <= greatest(1, n - 1 - 2 + 1) GROUP BY 1)
SELECT client_id, param, idx, weight FROM updates WHERE client_id = (SELECT arg_min(a, (score, a)) FROM s)""")
def federated_krum(spark: SparkSession, d: str) -> DataFrame:
    return federated.krum(B.updates(spark, d)).select("client_id", "param", "idx", "weight")


@query("""SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem""")
def graph_correlations(spark: SparkSession, d: str) -> DataFrame:
    c = graph.correlations(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return c.select("a", "b", F.round("r", 6).alias("r"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.where("n_nationkey > 0").select(F.floor(F.col("n_nationkey") / 2).cast("int").alias("source"), F.col("n_nationkey").alias("target"))


@query("""WITH RECURSIVE e AS (SELECT n_nationkey // 2 AS source, n_nationkey AS target FROM nation WHERE n_nationkey > 0), c(source, target, hops) AS (SELECT source, target, 1 FROM e UNION ALL SELECT c.source, e.target, hops + 1 FROM c JOIN e ON c.target = e.source)
SELECT source, target, min(hops) AS hops FROM c GROUP BY 1, 2""")
def graph_closure(spark: SparkSession, d: str) -> DataFrame:
    return graph.closure(_edges(spark, d))


@query("""WITH RECURSIVE e AS (SELECT n_nationkey // 2 AS source, n_nationkey AS target FROM nation WHERE n_nationkey > 0), c(node, depth) AS (SELECT 0, 0 UNION ALL SELECT e.target, depth + 1 FROM c JOIN e ON c.node = e.source) SELECT node, max(depth) AS depth FROM c GROUP BY 1""")
def graph_topological(spark: SparkSession, d: str) -> DataFrame:
    return graph.topological(_edges(spark, d))


@query("""WITH t AS (SELECT n_nationkey // 2 AS s, n_nationkey AS t FROM nation WHERE n_nationkey > 0), f AS (SELECT n_nationkey // 2 AS s, n_nationkey AS t FROM nation WHERE n_nationkey > 5 UNION ALL SELECT 99, n_nationkey FROM nation WHERE n_nationkey < 3),
x AS (SELECT (SELECT count(*) FROM (SELECT * FROM t INTERSECT SELECT * FROM f)) AS h, (SELECT count(*) FROM t) AS a, (SELECT count(*) FROM f) AS b) SELECT round(h / b, 6) AS precision, round(h / a, 6) AS recall, round(2 * (h / b) * (h / a) / (h / b + h / a), 6) AS f1, a + b - 2 * h AS distance FROM x""")
def graph_edge_scores(spark: SparkSession, d: str) -> DataFrame:
    e = _edges(spark, d)
    found = e.where("target > 5").unionByName(e.where("target < 3").select(F.lit(99).alias("source"), "target")).unionByName(spark.createDataFrame([(99, 0)], "source int, target int"))
    return _rounded(graph.edge_scores(e, found), "precision", "recall", "f1", digits=6)


@query("""SELECT user_id, CASE WHEN ('0x' || substr(md5('7|' || user_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.3 THEN 'a' ELSE 'b' END AS variant FROM events GROUP BY user_id""")
def ab_routing(spark: SparkSession, d: str) -> DataFrame:
    return B.events(spark, d).select("user_id").distinct().withColumn("variant", sampling.variant(F.col("user_id"), 0.3, 7))


@query("""SELECT event_id FROM events ORDER BY ('0x' || substr(md5('0|' || event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0, event_id LIMIT 100""")
def sample_uniform(spark: SparkSession, d: str) -> DataFrame:
    return sampling.uniform(B.events(spark, d), 100, "event_id").select("event_id")


@query()
def sample_weighted_with_replacement(spark: SparkSession, d: str) -> DataFrame:
    return sampling.weighted_with_replacement(B.events(spark, d).select("event_id", "value"), 100, "event_id", F.col("value")).select("draw", "event_id")


@query("""SELECT label, vec_id, CASE WHEN n <= 3 THEN 'support' ELSE 'query' END AS part FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY ('0x' || substr(md5('0|' || vec_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0, vec_id) AS n FROM embeddings) WHERE n <= 5""")
def sample_few_shot(spark: SparkSession, d: str) -> DataFrame:
    return sampling.per_class(table(spark, d, "embeddings"), "label", "vec_id", 3, 2).select("label", "vec_id", "part")


@query("""SELECT n_regionkey AS model, arg_max(n_name, n_nationkey) AS version, count(*) AS versions FROM nation GROUP BY 1""")
def registry_latest(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_regionkey").alias("model"), F.col("n_name").alias("name"), F.concat(F.lit("1."), F.col("n_nationkey").cast("string"), F.lit(".0")).alias("version"))
    last = registry.latest(n, "model")
    return last.join(n, ["model", "version"]).select("model", F.col("name").alias("version")).join(n.groupBy("model").agg(F.count("*").alias("versions")), "model")


@query("""SELECT o_custkey AS run, o_orderkey AS checkpoint FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS b, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE b <= 3 OR r <= 2""")
def registry_kept_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("checkpoint"), F.col("o_orderkey").alias("step"), F.col("o_totalprice").alias("loss"))
    return registry.kept_checkpoints(c, "loss").select("run", "checkpoint")


@query("""SELECT event_id, user_id, total FROM (SELECT event_id, user_id, 1 AS n, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS total FROM events) WHERE total // 5 > (total - 1) // 5""")
def count_triggers(spark: SparkSession, d: str) -> DataFrame:
    rows = B.events(spark, d).select("event_id", "user_id", F.lit(1).alias("n"))
    return telemetry.threshold_triggers(rows, "user_id", "event_id", 5).select("event_id", "user_id", "total")


@query("""SELECT substr(md5(event_type), 1, 12) AS topic_id, event_type AS topic, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY ALL""")
def topic_ids(spark: SparkSession, d: str) -> DataFrame:
    return B.events(spark, d).groupBy(short_md5(F.col("event_type")).alias("topic_id"), F.col("event_type").alias("topic")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("""SELECT user_id, round(exp(-0.1), 6) * 0 + list_sort(list(value))[(count(*) + 1) // 2] AS middle, round(quantile_cont(value, 0.95), 4) AS p95 FROM events GROUP BY user_id""")
def both_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return B.events(spark, d).groupBy("user_id").agg(ST.lower_median(F.col("value")).alias("middle"), F.round(F.percentile("value", 0.95), 4).alias("p95"))


@query("""SELECT event_type, round(sum(value), 2) AS total, count(*) AS n FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1""")
def topic_fan_out(spark: SparkSession, d: str) -> DataFrame:
    e = B.events(spark, d).withColumn("topic", F.col("event_type"))
    rows = telemetry.for_topic(e, "click").unionByName(telemetry.for_topic(e, "purchase"))
    return rows.groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n"))


@query()
def simulated_model(spark: SparkSession, d: str) -> DataFrame:
    return graph.simulated(spark, ["x", "y", "z"], {"y": ["x"], "z": ["x", "y"]}, 1000, interventions={"y": 1.0})
