"""Queries that run exports, timed streams, sketches and the vector index over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sampling, sketches, vectors, versions
from ..rounds import folder, kept
from ..sources import exports, runs
from ..sources.readers import table
from ..streaming import seen, streams, timed
from . import binding as B

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- exports -----------------------------------------------------------------------------------

_ITEM = "event_id long, ts timestamp_ntz, event_type string, value double"


def _items(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts", "event_type", "value")


@query("SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS place, event_id, ts::TIMESTAMP AS ts, event_type, value FROM events")
def export_pages(spark: SparkSession, d: str) -> DataFrame:
    """Events written as pages in order of time and read back in parts."""
    url = folder(spark, "export")
    exports.write_export(_items(spark, d), url, ["ts", "event_id"])
    return exports.read_export(spark, url, _ITEM, task_items="20000")


@query("SELECT row_number() OVER (ORDER BY value <= 50 DESC, ts, event_id) - 1 AS place, event_id, ts::TIMESTAMP AS ts, event_type, value FROM events WHERE value IS NOT NULL")
def export_resumed(spark: SparkSession, d: str) -> DataFrame:
    """The export grows between two runs of one stream, which goes on from its checkpoint's count."""
    url, out, checkpoint = folder(spark, "export"), folder(spark, "read"), folder(spark, "checkpoint")
    for part in (F.col("value") <= 50, F.col("value") > 50):
        exports.write_export(_items(spark, d).where(part), url, ["ts", "event_id"])
        streams.run_available(exports.stream_export(spark, url, _ITEM), checkpoint, path=out)
    return spark.read.parquet(out)


# --- timed streams -----------------------------------------------------------------------------


def _stream(spark: SparkSession, d: str) -> DataFrame:
    timed.use_state_store(spark)
    return streams.events(spark, f"{d}/events.parque[t]")  # a pattern, as a stream takes a single file by one alone


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 3600 SECOND THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM g),
c AS (SELECT user_id::VARCHAR AS user_id, min(ts)::TIMESTAMP AS started, max(ts)::TIMESTAMP AS ended, count(*) AS events FROM n GROUP BY user_id, session)
SELECT *, CASE WHEN epoch_us(ended) + 3600000000 <= (epoch_us((SELECT max(ts)::TIMESTAMP FROM events)) // 1000 - 600000) * 1000 THEN 'ended' ELSE 'live' END AS reason FROM c""")
def timed_chains(spark: SparkSession, d: str) -> DataFrame:
    """Chains that a stream's timers have ended, and those that its state still holds."""
    out, checkpoint = folder(spark, "chains"), folder(spark, "checkpoint")
    streams.run_available(timed.chains(_stream(spark, d), "user_id", most=1 << 20), checkpoint, path=out)
    both = spark.read.parquet(out).unionByName(timed.live_chains(spark, checkpoint, "user_id"))
    return both.withColumns({"started": F.col("started").cast("timestamp_ntz"), "ended": F.col("ended").cast("timestamp_ntz")})


_PASSED = "epoch_us(ts::TIMESTAMP) <= (epoch_us((SELECT max(ts)::TIMESTAMP FROM {})) // 1000 - 600000) * 1000"


@query(f"""WITH z AS (SELECT event_id, event_type, ts, value, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS sd, count(*) OVER w AS n FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 99 PRECEDING))
SELECT event_type, event_id, round((value - mean) / sd, 4) AS z, CASE WHEN abs((value - mean) / sd) > 4.5 THEN 'critical' ELSE 'warning' END AS severity FROM z WHERE n >= 20 AND sd > 0 AND abs((value - mean) / sd) > 3 AND {_PASSED.format("events")}""")
def timed_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """Alerts of a stream that takes rows in order of time: all those that the watermark has passed."""
    out = folder(spark, "alerts")
    streams.run_available(timed.anomalies(_stream(spark, d), "event_type"), folder(spark, "checkpoint"), path=out)
    return spark.read.parquet(out).select("event_type", "event_id", F.round("z", 4).alias("z"), "severity")


@query(f"""WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
n AS (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 21600 SECOND PRECEDING AND CURRENT ROW) AS signs FROM s)
SELECT user_id::VARCHAR AS user_id, event_id, signs FROM n WHERE signs >= 2 AND {_PASSED.format("s")}""")
def timed_threats(spark: SparkSession, d: str) -> DataFrame:
    """Errors of a user as signs: the second and later ones within six hours."""
    out = folder(spark, "threats")
    signs = _stream(spark, d).where("event_type = 'error'")
    streams.run_available(timed.threats(signs, "user_id", 21600, 2), folder(spark, "checkpoint"), path=out)
    return spark.read.parquet(out).select("user_id", "event_id", "signs")


# --- sketches ----------------------------------------------------------------------------------


@query("""SELECT time_bucket(INTERVAL 86400 SECOND, ts::TIMESTAMP) AS window_start, event_type AS name, count(value) AS n, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high,
true AS p50_near, true AS p90_near, true AS p95_near, true AS p99_near, true AS users_near, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def sketch_days(spark: SparkSession, d: str) -> DataFrame:
    """Days from minutes by merged sketches; each percentile's true rank, and the number of users, are held against the stated errors."""
    m = B.metrics(spark, d)
    minutes = kept(sketches.sketched(m, 60, distinct="user_id"), "minutes")
    days = sketches.answered(sketches.merged(sketches.merged(minutes, 3600), 86400))
    errors = sketches.rank_errors(days, m, 86400).select("window_start", "name", *[(F.col(p) <= sketches.RANK_ERROR).alias(f"{p}_near") for p in sketches.PERCENTILES])
    users = m.groupBy(F.window("ts", "86400 seconds")["start"].alias("window_start"), "name").agg(F.countDistinct("user_id").alias("users"))
    rows = days.join(errors, ["window_start", "name"]).join(users, ["window_start", "name"])
    near = F.abs(F.col("distinct") - F.col("users")) <= F.greatest(F.lit(1.0), 4 * sketches.DISTINCT_ERROR * F.col("users"))
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "name", "n", F.round("total", 4).alias("total"), "low", "high", *[f"{p}_near" for p in sketches.PERCENTILES], near.alias("users_near"), "users")


# --- similar vectors ---------------------------------------------------------------------------


def _doubled(spark: SparkSession, d: str) -> DataFrame:
    """Each vector and a near copy of it, moved a little in one component; ids of copies are below 0."""
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    moved = F.zip_with("embedding", F.sequence(F.lit(0), F.size("embedding") - 1), lambda x, i: F.when(i == F.col("vec_id") % F.size("embedding"), x + F.lit(0.1)).otherwise(x))
    copy = v.withColumn("embedding", moved).withColumn("vec_id", -1 - F.col("vec_id"))
    return v.unionByName(copy)


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings UNION ALL SELECT -1 - vec_id, list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN i - 1 = vec_id % len(embedding) THEN x + 0.1 ELSE x END) FROM embeddings),
n AS (SELECT vec_id, e, list_dot_product(e, e) AS q FROM v)
SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.e, b.e) / sqrt(a.q * b.q), 6) AS cosine FROM n a JOIN n b ON a.vec_id < b.vec_id AND list_dot_product(a.e, b.e) / sqrt(a.q * b.q) >= 0.95""")
def similar_vectors_indexed(spark: SparkSession, d: str) -> DataFrame:
    """Near copies of all vectors by the hyperplane index; planned for 0.99999 at the threshold, so that none is missed here."""
    return vectors.similar_pairs(_doubled(spark, d), 0.95, recall=0.99999).withColumn("cosine", F.round("cosine", 6))


# --- versions ----------------------------------------------------------------------------------

_SPLIT = "2024-03-01"


@query(f"""WITH ch AS (SELECT *, coalesce(valid_at >= TIMESTAMP '{_SPLIT}', false) AS late FROM client_changes),
l AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY late, client_id ORDER BY seq DESC NULLS LAST, valid_at DESC NULLS LAST, change_id DESC NULLS LAST) = 1),
one AS (SELECT client_id, segment, city, balance FROM clients),
two AS (SELECT * FROM one WHERE NOT EXISTS (SELECT 1 FROM l WHERE NOT late AND l.client_id IS NOT DISTINCT FROM one.client_id) UNION ALL SELECT client_id, segment, city, balance FROM l WHERE NOT late AND op IS DISTINCT FROM 'D'),
three AS (SELECT * FROM two WHERE NOT EXISTS (SELECT 1 FROM l WHERE late AND l.client_id IS NOT DISTINCT FROM two.client_id) UNION ALL SELECT client_id, segment, city, balance FROM l WHERE late AND op IS DISTINCT FROM 'D')
SELECT 1 AS version, * FROM one UNION ALL SELECT 2, * FROM two UNION ALL SELECT 3, * FROM three UNION ALL SELECT 4, * FROM two""")
def client_versions(spark: SparkSession, d: str) -> DataFrame:
    """Clients and two commits of their changes, then a return to the first commit; every version is read back."""
    names = ["client_id", "segment", "city", "balance"]
    t = versions.VersionedTable(spark, folder(spark, "versions"))
    t.create(table(spark, d, "clients").select(*names), ["client_id"], ["balance"], buckets=16)
    changes = table(spark, d, "client_changes").withColumn("late", F.coalesce(F.col("valid_at") >= F.lit(_SPLIT).cast("timestamp_ntz"), F.lit(False)))
    for late in (False, True):
        t.commit(changes.where(F.col("late") == late), ["seq", "valid_at", "change_id"], F.col("op") == "D")
    t.restore(2)
    out = [t.read(n).select(F.lit(n).alias("version"), *names) for n in (1, 2, 3, 4)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


# --- first sights and runs ---------------------------------------------------------------------


@query("""WITH g AS (SELECT client_id, ts::TIMESTAMP AS ts, epoch_us(ts::TIMESTAMP) // 86400000000 AS g FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
f AS (SELECT client_id, g, min(ts) AS ts FROM g GROUP BY client_id, g),
n AS (SELECT *, lag(g) OVER (PARTITION BY client_id ORDER BY g) AS before FROM f)
SELECT client_id, ts FROM n WHERE before IS NULL OR before < g - 1""")
def returning_clients(spark: SparkSession, d: str) -> DataFrame:
    """First clicks of clients that were away for a whole day, by Bloom filters of two days in a stream's state."""
    timed.use_state_store(spark)
    out = folder(spark, "seen")
    clicks = streams.events(spark, f"{d}/clicks.parque[t]", "client_id long, ts timestamp_ntz").where("client_id IS NOT NULL AND ts IS NOT NULL")
    streams.run_available(seen.first_seen(clicks, "client_id", buckets=8), folder(spark, "checkpoint"), path=out)
    return spark.read.parquet(out).select("client_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("""SELECT 'clicks' AS source, 'done' AS status, count(*) AS rows, count_if(ts IS NULL) AS untimed, count_if(client_id IS NULL) AS nobody FROM clicks
UNION ALL SELECT 'clients', 'done', count(*), NULL, count_if(client_id IS NULL) FROM clients UNION ALL SELECT 'stamps', 'done', count(*), NULL, NULL FROM stamps
UNION ALL SELECT 'nothing', 'empty', 0, 0, 0 FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'nowhere', 'missing', 0, NULL, NULL FROM region WHERE r_regionkey = 0""")
def source_report(spark: SparkSession, d: str) -> DataFrame:
    """Tables as sources, one of them empty and one missing: status and counts from the passes that wrote them."""
    sources = {n: lambda n=n: spark.read.parquet(f"{d}/{n}.parquet") for n in ("clicks", "clients", "stamps", "nowhere")}
    sources["nothing"] = lambda: spark.read.parquet(f"{d}/clicks.parquet").where("kind = 'no such kind'")
    figures = {k: (c, F.col(c).isNull()) for k, c in (("untimed", "ts"), ("nobody", "client_id"))}
    _, report = runs.ingest(spark, sources, folder(spark, "sources"), figures)
    return report.select("source", "status", "rows", *[F.col("figures")[k].alias(k) for k in figures])


# --- greedy choice -----------------------------------------------------------------------------

_CHOSEN = 24


def _choice_sql() -> str:
    """The plain loop, a maximum over all rows for each place."""
    steps = ["c0 AS MATERIALIZED (SELECT doc_id, least(1.0, n_chars / 1500.0)::DOUBLE AS score, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS words, 0.0::DOUBLE AS overlap FROM documents WHERE doc_id IS NOT NULL AND n_chars IS NOT NULL)"]
    for k in range(_CHOSEN):
        value = "score" if k == 0 else "score * (1 - 0.3::DOUBLE) + 0.3::DOUBLE * (1 - overlap)"
        steps.append(f"b{k} AS MATERIALIZED (SELECT * FROM c{k} ORDER BY {value} DESC, score DESC, doc_id LIMIT 1)")
        steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c.doc_id, c.score, c.words, greatest(c.overlap, CASE WHEN len(c.words) = 0 THEN 0 ELSE len(list_intersect(c.words, b.words)) / len(c.words)::DOUBLE END) AS overlap FROM c{k} c, b{k} b WHERE c.doc_id <> b.doc_id)")
    return f"WITH {', '.join(steps)} {' UNION ALL '.join(f'SELECT doc_id, score, {k} AS place FROM b{k}' for k in range(_CHOSEN))}"


@query(_choice_sql())
def diverse_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents to label next: long ones whose words differ from those chosen before."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.least(F.lit(1.0), F.col("n_chars") / 1500.0).alias("score"))
    return sampling.diverse(docs, _CHOSEN, "doc_id", "text", "score")
