"""Queries on what is taken, due, sent or dropped: ordered edges, separations, schedules, routes, queues and two-step deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scheduling
from ..operators import dedup, graph, registry, topics
from ..sources.readers import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- graphs ------------------------------------------------------------------------------------


def _trade(spark: SparkSession, d: str) -> DataFrame:
    """Each line of a sale as an edge from the vendor's nation to the client's."""
    lines, sales = table(spark, d, "sale_lines").select("sale_id", "line_no", "vendor_id", "shipped_at"), table(spark, d, "sales").select("sale_id", "client_id")
    ends = lambda name, key, end: table(spark, d, name).select(key, F.col("nation_id").alias(end))
    return lines.join(sales, "sale_id").join(ends("vendors", "vendor_id", "source"), "vendor_id").join(ends("clients", "client_id", "target"), "client_id").select("source", "target", "shipped_at", "sale_id", "line_no")


_TRADE = "trade AS (SELECT v.nation_id AS source, c.nation_id AS target, shipped_at, l.sale_id, line_no FROM sale_lines l JOIN sales s ON l.sale_id = s.sale_id JOIN vendors v ON l.vendor_id = v.vendor_id JOIN clients c ON s.client_id = c.client_id)"


@query(f"""WITH RECURSIVE {_TRADE}, f AS (SELECT * FROM trade WHERE source <> target QUALIFY row_number() OVER (PARTITION BY source, target ORDER BY shipped_at NULLS FIRST, sale_id NULLS FIRST, line_no NULLS FIRST) = 1),
o AS MATERIALIZED (SELECT source::INT AS s, target::INT AS t, row_number() OVER (ORDER BY shipped_at NULLS FIRST, sale_id NULLS FIRST, line_no NULLS FIRST, source, target) AS p FROM f),
k(p, s, t, ok, ahead) AS (SELECT 0::BIGINT, NULL::INT, NULL::INT, false, list_transform(range(64), lambda i: 0::BIGINT) UNION ALL
SELECT o.p, o.s, o.t, (k.ahead[o.t + 1] >> o.s) & 1 = 0, CASE WHEN (k.ahead[o.t + 1] >> o.s) & 1 = 1 THEN k.ahead ELSE list_transform(k.ahead, lambda r, i: CASE WHEN i - 1 = o.s OR (r >> o.s) & 1 = 1 THEN r | (1::BIGINT << o.t) | k.ahead[o.t + 1] ELSE r END) END FROM k JOIN o ON o.p = k.p + 1)
SELECT source, target, count(*) AS lines FROM trade JOIN k ON k.s = source AND k.t = target AND ok GROUP BY 1, 2""")
def trade_order(spark: SparkSession, d: str) -> DataFrame:
    """Routes between nations in order of their first shipment, without those that would lead goods in a circle."""
    taken = graph.acyclic(_trade(spark, d), "shipped_at", "sale_id", "line_no")
    return taken.groupBy("source", "target").agg(F.count("*").alias("lines"))


_GIVEN = [3, 8, 13]


@query(f"""WITH RECURSIVE {_TRADE}, n AS (SELECT source, target, count(*) AS n FROM trade WHERE source < target GROUP BY 1, 2), e AS (SELECT source, target FROM n WHERE n > 1.5 * (SELECT avg(n) FROM n)),
i AS (SELECT * FROM e WHERE source NOT IN (3, 8, 13) AND target NOT IN (3, 8, 13)), r AS (SELECT * FROM i UNION SELECT r.source, i.target FROM r JOIN i ON r.target = i.source),
v AS (SELECT source AS x FROM e UNION SELECT target FROM e) SELECT a.x, b.x AS y, NOT EXISTS (SELECT 1 FROM r WHERE source = a.x AND target = b.x) AS separated FROM v a JOIN v b ON a.x < b.x""")
def trade_separations(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of nations on the busiest routes that three given nations part."""
    n = _trade(spark, d).where("source < target").groupBy("source", "target").agg(F.count("*").alias("n"))
    edges = n.join(F.broadcast(n.agg(F.avg("n").alias("mean"))), F.col("n") > 1.5 * F.col("mean")).select("source", "target")  # one row is broadcast
    nodes = edges.select(F.col("source").alias("x")).union(edges.select("target")).distinct()  # nations, 25 at most
    return graph.separations(edges, nodes.join(nodes.withColumnRenamed("x", "y"), F.col("x") < F.col("y")), _GIVEN)


# --- schedules ---------------------------------------------------------------------------------

#: Cron rules by name; weekday 0 is Monday.
RULES = {"office": "*/15 8-18 * * 0-4", "night": "0-9,30 22 1-15/2 * *", "weekend": "5 * * 3,4 5,6"}


@query("""WITH c AS (SELECT ts::TIMESTAMP AS ts, minute(ts) AS mi, hour(ts) AS h, day(ts) AS dd, month(ts) AS mo, isodow(ts) - 1 AS w FROM clicks WHERE ts IS NOT NULL)
SELECT rule, count(*) AS clicks, min(ts) AS first, max(ts) AS last FROM (SELECT 'office' AS rule, ts FROM c WHERE mi % 15 = 0 AND h BETWEEN 8 AND 18 AND w <= 4
UNION ALL SELECT 'night', ts FROM c WHERE (mi <= 9 OR mi = 30) AND h = 22 AND dd <= 15 AND dd % 2 = 1 UNION ALL SELECT 'weekend', ts FROM c WHERE mi = 5 AND mo IN (3, 4) AND w IN (5, 6)) GROUP BY 1""")
def due_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Clicks in minutes at which each rule is due, all rules in one pass."""
    clicks = table(spark, d, "clicks").select(F.col("ts").cast("timestamp_ntz").alias("ts")).where("ts IS NOT NULL")
    met = F.array_compact(F.array(*[F.when(scheduling.due(F.col("ts"), r), F.lit(n)) for n, r in RULES.items()]))
    return clicks.select("ts", F.explode(met).alias("rule")).groupBy("rule").agg(F.count("*").alias("clicks"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query("""WITH r AS (SELECT client_id, balance > 0 AS enabled, CASE WHEN client_id % 2 = 0 THEN 'cron' ELSE 'interval' END AS kind, updated_at + INTERVAL 21 DAY AS next_run, updated_at AS last_run, 86400 * (nation_id + 1) AS every_seconds FROM clients)
SELECT client_id, kind FROM r WHERE enabled AND ((kind = 'cron' AND TIMESTAMP '2024-04-15 12:00:00' >= next_run) OR (kind = 'interval' AND coalesce(epoch_us(TIMESTAMP '2024-04-15 12:00:00') // 1000000 - epoch_us(last_run) // 1000000, 1099511627776) >= every_seconds))""")
def due_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Clients with a balance whose review is due at an instant: by a next time, or by an interval since the last."""
    kind = F.when(F.col("client_id") % 2 == 0, "cron").otherwise("interval")
    rules = table(spark, d, "clients").select("client_id", (F.col("balance") > 0).alias("enabled"), kind.alias("kind"), F.expr("updated_at + INTERVAL 21 DAYS").alias("next_run"), F.col("updated_at").alias("last_run"), (86400 * (F.col("nation_id") + 1)).alias("every_seconds"))
    return scheduling.due_schedules(rules, F.lit("2024-04-15 12:00:00").cast("timestamp_ntz")).select("client_id", "kind")


# --- routes and queues -------------------------------------------------------------------------

#: (model_id, capacity, latency_ms, price, available, memory_fit)
MODELS = [("small", 0.2, 200.0, 0.001, True, 1.0), ("middle", 0.32, 900.0, 0.01, True, 0.8), ("large", 0.6, 2500.0, 0.03, True, 0.5), ("spare", 0.9, 400.0, 0.06, False, 0.9)]


@query(r"""WITH m(model_id, capacity, latency_ms, price, available, memory_fit) AS (VALUES ('small', 0.2::DOUBLE, 200::DOUBLE, 0.001::DOUBLE, true, 1::DOUBLE), ('middle', 0.32, 900, 0.01, true, 0.8), ('large', 0.6, 2500, 0.03, true, 0.5), ('spare', 0.9, 400, 0.06, false, 0.9)),
c AS (SELECT conv_id || '-' || turn AS prompt_id, 0.15 * least(1, length(text) / 500) + 0.30 * 0.5 + 0.20 * least(1, ((contains(l, 'function'))::INT + contains(l, 'class')::INT + contains(l, 'implement')::INT + contains(l, 'code')::INT + contains(l, 'script')::INT + contains(l, 'program')::INT) / 3)
+ 0.10 * least(1, (contains(l, 'first')::INT + contains(l, 'then')::INT + contains(l, 'next')::INT + contains(l, 'finally')::INT + contains(l, 'step')::INT + contains(l, 'process')::INT) / 4) AS complexity FROM (SELECT *, lower(text) AS l FROM conversations WHERE role = 'user')),
t AS (SELECT prompt_id, complexity, model_id, round((0.3 * CASE WHEN capacity >= complexity THEN 1 ELSE capacity / complexity END + 0.2 * greatest(0, 1 - latency_ms / 5000) + 0.2 * greatest(0, 1 - price / 0.05) + 0.2 * CASE WHEN available THEN 1 ELSE 0.3 END + 0.1 * memory_fit) / 1.0, 9) AS total FROM c, m),
r AS (SELECT *, row_number() OVER (PARTITION BY prompt_id ORDER BY total DESC, model_id) AS n FROM t)
SELECT prompt_id, round(any_value(complexity), 4) AS complexity, max(model_id) FILTER (n = 1) AS model_id, round(max(total) FILTER (n = 1), 6) AS score, string_agg(model_id, ',' ORDER BY n) FILTER (n > 1) AS fallbacks FROM r GROUP BY 1""")
def routed_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Each turn of a user with the model that it goes to and the others in order."""
    prompts = table(spark, d, "conversations").where("role = 'user'").select(F.concat_ws("-", "conv_id", "turn").alias("prompt_id"), F.col("text").alias("prompt"))
    models = spark.createDataFrame(MODELS, "model_id string, capacity double, latency_ms double, price double, available boolean, memory_fit double")
    out = registry.routed(prompts, models)
    return out.select("prompt_id", F.round("complexity", 4).alias("complexity"), "model_id", F.round("score", 6).alias("score"), F.array_join("fallbacks", ",").alias("fallbacks"))


@query("""WITH q AS (SELECT sale_id AS topic_id, client_id AS domain, priority, sold_at AS created_at FROM sales WHERE status = 'open'), n AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY priority NULLS FIRST, created_at NULLS FIRST, topic_id NULLS FIRST) AS n FROM q)
SELECT topic_id, domain, priority, created_at::TIMESTAMP AS created_at FROM n WHERE n <= 2 ORDER BY priority NULLS FIRST, created_at NULLS FIRST, topic_id NULLS FIRST LIMIT 200""")
def next_sales(spark: SparkSession, d: str) -> DataFrame:
    """Open sales as a queue: the next 200 by priority and age, at most two of a client."""
    status = F.when(F.col("status") == "open", "pending").otherwise(F.col("status"))
    queue = table(spark, d, "sales").select(F.col("sale_id").alias("topic_id"), F.col("client_id").alias("domain"), status.alias("status"), "priority", F.col("sold_at").cast("timestamp_ntz").alias("created_at"))
    return topics.dequeued(queue, 200, 2).drop("status")


# --- deduplication -----------------------------------------------------------------------------


@query("""WITH RECURSIVE x AS (SELECT min(doc_id) AS id FROM documents GROUP BY text), v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IN (SELECT id FROM x)),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.4),
o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS i FROM (SELECT DISTINCT b AS vec_id FROM p)),
k(i, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT k.i + 1, CASE WHEN (SELECT count(*) FROM p WHERE p.b = o.vec_id AND NOT list_contains(k.gone, p.a)) > 0 THEN list_append(k.gone, o.vec_id) ELSE k.gone END FROM k JOIN o ON o.i = k.i + 1)
SELECT id AS doc_id FROM x WHERE id NOT IN (SELECT unnest(gone) FROM (SELECT gone FROM k ORDER BY i DESC LIMIT 1))""")
def hybrid_dedup(spark: SparkSession, d: str) -> DataFrame:
    """One document of each text, then none whose vector is like that of an earlier one that stays."""
    pairs = dedup.similar_pairs(table(spark, d, "embeddings"), 0.4)
    return dedup.hybrid(table(spark, d, "documents").select("doc_id", "text"), pairs, "doc_id", "text").select("doc_id")
