"""Readers of log, feedback, record and state files; a pluggable registry of sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.probing import iso_timestamp, json_key, strip
from ..operators import interactions as I


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; event times become instants, which watermarks need."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if name == "events" else df


#: Options under which each form is read.
FORMS = {"parquet": {}, "orc": {}, "csv": {"header": "true", "mode": "PERMISSIVE"}, "json": {}}


def stored(spark: SparkSession, path: str | list[str], form: str, schema: str | None = None, **options) -> DataFrame:
    """Files of a column or text form; CSV and JSON are read under ``schema`` where one is given, without a pass that infers it."""
    reader = spark.read.format(form).options(**(FORMS[form] | options))
    return (reader.schema(schema) if schema else reader).load(path)


def database(spark: SparkSession, url: str, name: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 8, **options) -> DataFrame:
    """A database's table; with ``key`` in ``parts`` ranges that are read at once."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if key is not None:
        reader = reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.load()


def within(df: DataFrame, ts: Column, since: str | None = None, until: str | None = None) -> DataFrame:
    """Rows of the time range, both ends included; rows whose time can't be read stay."""
    for bound, outside in ((since, lambda b: ts < b), (until, lambda b: ts > b)):
        if bound is not None:
            df = df.where(~F.coalesce(outside(F.lit(bound).cast("timestamp")), F.lit(False)))
    return df


def json_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(line, file): JSON objects, one a line; blank and malformed lines are left out."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    rows = reader.text(path).select(strip(F.col("value")).alias("line"), F.col("_metadata.file_path").alias("file"))
    return rows.where(F.try_parse_json("line").isNotNull() & F.col("line").startswith("{"))


def bad_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines that are not JSON objects, for a quarantine table."""
    rows = spark.read.text(path).select(strip(F.col("value")).alias("line"), F.col("_metadata.file_path").alias("file"))
    return rows.where((F.col("line") != "") & (F.try_parse_json("line").isNull() | ~F.col("line").startswith("{")))


def json_documents(spark: SparkSession, path: str | list[str], wrappers: Sequence[str] = (), glob: str | None = None) -> DataFrame:
    """(line, file): the objects of whole-file JSON: an array, a wrapper's array, or a single object."""
    reader = spark.read.option("wholetext", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    files = reader.text(path).select(strip(F.col("value")).alias("doc"), F.col("_metadata.file_path").alias("file"))
    array = F.coalesce(F.when(F.col("doc").startswith("["), F.col("doc")), *[F.when(json_key(F.col("doc"), w).startswith("["), json_key(F.col("doc"), w)) for w in wrappers])
    items = F.when(array.isNotNull(), F.from_json(array, "array<string>")).otherwise(F.array("doc"))
    rows = files.select(F.explode(items).alias("line"), "file")
    return rows.where(F.col("line").startswith("{"))


def items_after(spark: SparkSession, path: str, seen: int) -> DataFrame:
    """(place, line): the objects of a JSON array file beyond those seen in an earlier poll."""
    files = spark.read.option("wholetext", True).text(path).select(F.from_json(strip(F.col("value")), "array<string>").alias("items"))
    return files.select(F.posexplode("items").alias("place", "line")).where(F.col("place") >= seen)


def cases_or(spark: SparkSession, path: str, schema: str, fallback: Callable[[], DataFrame]) -> DataFrame:
    """Evaluation cases of a JSON file, or those that ``fallback`` makes where there is no such file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return fallback()
    return json_documents(spark, path).select(F.from_json("line", schema).alias("c")).select("c.*")


def telemetry(spark: SparkSession, path, since: str | None = None, until: str | None = None, types: Sequence[str] | None = None, glob: str | None = None) -> DataFrame:
    line = F.col("line")
    rows = json_lines(spark, path, glob)
    rows = within(rows, iso_timestamp(json_key(line, "timestamp")), since, until)
    if types:
        rows = rows.where(json_key(line, "event_type").isin(*types))
    return rows.select(
        *[json_key(line, k).alias(k) for k in ("event_id", "event_type", "timestamp", "session_id", "user_id", "properties", "metrics")],
        F.from_json(json_key(line, "tags"), "array<string>").alias("tags"), F.col("file").alias("source_file"),
    )


def feedback(spark: SparkSession, path, since: str | None = None, until: str | None = None, patterns: Sequence[str] | None = None, glob: str | None = None) -> DataFrame:
    line = F.col("line")
    rows = within(json_documents(spark, path, ("events", "feedback", "history"), glob), iso_timestamp(json_key(line, "timestamp")), since, until)
    if patterns:
        rows = rows.where(json_key(line, "pattern").isin(*patterns))
    names = ("id", "event_id", "timestamp", "response", "pattern", "notification_text", "context")
    return rows.select(*[json_key(line, k).alias(k) for k in names], json_key(line, "time_to_respond").try_cast("double").alias("time_to_respond"), F.col("file").alias("source_file"))


def auth_records(spark: SparkSession, path, since: str | None = None, until: str | None = None, glob: str | None = None) -> DataFrame:
    line = F.col("line")
    rows = within(json_documents(spark, path, ("records", "auth_history"), glob), iso_timestamp(json_key(line, "timestamp")), since, until)
    numbers = ("voice_confidence", "final_confidence", "network_trust", "temporal_confidence", "device_trust", "risk_score")
    return rows.select(
        *[json_key(line, k).alias(k) for k in ("id", "timestamp", "outcome", "decision", "command", "intent", "user_id", "network_ssid_hash", "device_state")],
        *[json_key(line, k).try_cast("double").alias(k) for k in numbers], F.from_json(json_key(line, "reasoning"), "array<string>").alias("reasoning"), F.col("file").alias("source_file"),
    )


#: Forms of a log line.
FULL_LINE = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?)\s+(\w+)\s+([\w.]+)\s+-\s+(.*)$"
SHORT_LINE = r"^(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2})\s+(.*)$"
CORRECTION_WORDS = ("correction", "corrected", "wrong", "actually")


def log_lines(spark: SparkSession, path, glob: str = "*.log") -> DataFrame:
    """(timestamp, level, component, message, is_correction) of text logs in either form; other lines are left out."""
    rows = spark.read.option("pathGlobFilter", glob).text(path)
    full = lambda k: F.nullif(F.regexp_extract("value", FULL_LINE, k), F.lit(""))
    short = lambda k: F.nullif(F.regexp_extract("value", SHORT_LINE, k), F.lit(""))
    rows = rows.select(iso_timestamp(F.coalesce(full(1), short(1))).alias("timestamp"), full(2).alias("level"), full(3).alias("component"), F.coalesce(full(4), short(2)).alias("message"))
    return rows.where("timestamp IS NOT NULL").withColumn("is_correction", F.lower("message").rlike("|".join(CORRECTION_WORDS)))


def log_records(lines: DataFrame) -> DataFrame:
    """JSON log records with either name of each field."""
    line = F.col("line")
    either = lambda *keys: F.coalesce(*[F.nullif(json_key(line, k), F.lit("")) for k in keys])
    return lines.select(
        either("event_id", "id").alias("event_id"), iso_timestamp(either("timestamp", "time")).alias("timestamp"), either("event_type", "type").alias("event_type"), either("user_input", "query").alias("user_input"),
        either("assistant_response", "response").alias("response"), either("system_context", "context").alias("system_context"), F.coalesce(json_key(line, "success").try_cast("boolean"), F.lit(True)).alias("success"),
        json_key(line, "confidence").try_cast("double").alias("confidence"), either("latency_ms", "duration_ms").try_cast("double").alias("latency_ms"),
        (F.coalesce(json_key(line, "is_correction").try_cast("boolean"), F.lit(False)) | json_key(line, "corrected_response").isNotNull()).alias("is_correction"),
        json_key(line, "original_response").alias("original_response"), json_key(line, "corrected_response").alias("corrected_response"), json_key(line, "session_id").alias("session_id"), either("component", "source").alias("component"),
    )


def latest_log_events(spark: SparkSession, folder: str, since: str | None = None, until: str | None = None, limit: int = 1000) -> DataFrame:
    """The newest events of the JSON lines in a folder's *.log and *.jsonl files."""
    rows = within(log_records(json_lines(spark, folder, "{*.log,*.jsonl}")), F.col("timestamp"), since, until)
    return rows.orderBy(F.desc("timestamp"), "event_id").limit(limit)


def event_store(spark: SparkSession, path: str) -> DataFrame:
    """Automation events of a JSON array file, with defaults for what is missing."""
    line = F.col("line")
    return json_documents(spark, path).select(
        json_key(line, "event_id").alias("event_id"), iso_timestamp(json_key(line, "timestamp")).alias("timestamp"), F.coalesce(json_key(line, "event_type"), F.lit("unknown")).alias("event_type"), json_key(line, "action_type").alias("action_type"),
        F.coalesce(json_key(line, "batch_size").try_cast("int"), F.lit(1)).alias("batch_size"), json_key(line, "goal").alias("goal"), *[F.coalesce(json_key(line, k).try_cast("double"), F.lit(0.0)).alias(k) for k in ("execution_time_ms", "time_saved_ms", "tokens_saved")],
        F.get_json_object(line, "$.vision_analysis.parser_mode").alias("parser_mode"), F.coalesce(json_key(line, "used_parser").try_cast("boolean"), F.lit(False)).alias("assisted"), json_key(line, "session_id").alias("session_id"),
    )


def tail(df: DataFrame, order: str, limit: int) -> DataFrame:
    """The last rows in order."""
    return df.orderBy(F.desc(order)).limit(limit)


def state_fields(spark: SparkSession, path: str) -> DataFrame:
    """(file, fields): state snapshots as maps of text."""
    return json_documents(spark, path).select("file", F.from_json("line", "map<string,string>").alias("fields"))


Reader = Callable[..., DataFrame]


class Sources:
    """Readers by source type.  A type without a reader yields nothing; a source that fails is reported and left out."""

    def __init__(self):
        self.readers: dict[str, Reader] = {
            "telemetry": lambda spark, path, **o: I.from_telemetry(telemetry(spark, path, **o)),
            "feedback": lambda spark, path, **o: I.from_feedback(feedback(spark, path, **o)),
            "auth_record": lambda spark, path, **o: I.from_auth(auth_records(spark, path, **o)),
        }
        self.failures: dict[str, str] = {}

    def register(self, kind: str, reader: Reader) -> None:
        self.readers[kind] = reader

    def read(self, spark: SparkSession, kind: str, path, order: int = 0, **options) -> DataFrame | None:
        if kind not in self.readers:
            self.failures[f"{kind}:{path}"] = "no reader"
            return None
        try:
            out = self.readers[kind](spark, path, **options)
            out.schema  # noqa: B018  resolves the path
        except Exception as error:
            self.failures[f"{kind}:{path}"] = str(error)[:200]
            return None
        return out.withColumns({"_src_order": F.lit(order).cast("bigint"), "_line_no": F.monotonically_increasing_id()})

    def read_all(self, spark: SparkSession, sources: Sequence[tuple[str, str]], **options) -> DataFrame | None:
        parts = [df for k, (kind, path) in enumerate(sources) if (df := self.read(spark, kind, path, k, **options)) is not None]
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else None

    def read_folder(self, spark: SparkSession, folder: str, **options) -> DataFrame | None:
        """A folder by naming convention; a file may match two.  Raw logs and states have no reader of their own until one is registered."""
        globs = (("raw_log", "*.log"), ("telemetry", "*.jsonl"), ("state_file", "*_state.json"), ("feedback", "*feedback*.json"), ("auth_record", "*auth*.json"))
        parts = [df for k, (kind, glob) in enumerate(globs) if (df := self.read(spark, kind, folder, k, glob=glob, **options)) is not None]
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else None
