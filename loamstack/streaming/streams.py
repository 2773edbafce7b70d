"""Structured Streaming twins of the telemetry operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LATE = "10 minutes"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, path: str, schema: str = EVENTS, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet event files as a stream with event times as instants."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def json_events(spark: SparkSession, path: str, schema: str, me: str | None = None, max_age: str = "1d", archive: str | None = None) -> DataFrame:
    """A folder of event files; with ``me``, only others' events that name this receiver or nobody; with ``archive`` files that are done are moved there."""
    reader = spark.readStream.schema(schema).option("maxFileAge", max_age)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.json(path)
    return rows if me is None else rows.where((F.col("source") != me) & ((F.size("target_sources") <= 0) | F.array_contains("target_sources", me)))


def windowed(stream: DataFrame, seconds: int = 60, keys: tuple[str, ...] = ("event_type",), late: str = LATE, slide: int | None = None) -> DataFrame:
    from ..operators.telemetry import windowed as batch

    return batch(stream.withWatermark("ts", late), seconds, keys, True, slide)


def sessions(stream: DataFrame, key: str, gap: str = "1 hour", late: str = LATE) -> DataFrame:
    rows = stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("events"))
    return rows.select(key, F.col("w.start").alias("started"), F.col("w.end").alias("closes"), "events")


def deduplicated(stream: DataFrame, *keys: str, late: str = "5 minutes") -> DataFrame:
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))


def anomalies(stream: DataFrame, key: str, span: int = 100, least: int = 20, limit: float = 3.0) -> DataFrame:
    """Alerts from the last ``span`` values of each key, kept as state."""

    def check(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        out = []
        for event, ts, value in zip(rows["event_id"], rows["ts"], rows["value"]):
            held = [*held[-(span - 1) :], float(value)]
            if len(held) >= least:
                s = pd.Series(held)
                sd = s.std()
                if sd > 0 and abs(z := (value - s.mean()) / sd) > limit:
                    out.append((k[0], event, ts, value, z, "critical" if abs(z) > limit * 1.5 else "warning"))
        state.update((held,))
        yield pd.DataFrame(out, columns=[key, "event_id", "ts", "value", "z", "severity"])

    schema = f"{key} string, event_id long, ts timestamp, value double, z double, severity string"
    return stream.groupBy(key).applyInPandasWithState(check, schema, "held array<double>", "append", GroupStateTimeout.NoTimeout)


def count_triggers(stream: DataFrame, key: str, threshold: int) -> DataFrame:
    """A row for each multiple of the threshold that the running count of a key passes, wherever batches are cut."""

    def count(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else 0
        after = before + sum(len(b) for b in batches)
        state.update((after,))
        passed = range(before // threshold + 1, after // threshold + 1)
        yield pd.DataFrame({key: [k[0]] * len(passed), "total": [n * threshold for n in passed]})

    return stream.groupBy(key).applyInPandasWithState(count, f"{key} string, total long", "total long", "append", GroupStateTimeout.NoTimeout)


def correlated(requests: DataFrame, responses: DataFrame, key: str = "correlation_id", within: str = "1 minute", late: str = LATE) -> DataFrame:
    """Requests with the response of the same correlation within an interval."""
    a = requests.withWatermark("ts", late).alias("a")
    b = responses.withWatermark("ts", late).alias("b")
    return a.join(b, F.expr(f"a.{key} = b.{key} AND b.ts BETWEEN a.ts AND a.ts + INTERVAL {within}")).select(F.col(f"a.{key}").alias(key), F.col("a.ts").alias("asked"), F.col("b.ts").alias("answered"))


def rolling_counts(stream: DataFrame, keys: tuple[str, ...], seconds: int = 300, late: str = LATE) -> DataFrame:
    rows = stream.withWatermark("ts", late).groupBy(F.window("ts", f"{seconds} seconds").alias("w"), *keys).agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("window_start"), *keys, "n")


def run_available(out: DataFrame, checkpoint: str, name: str | None = None, mode: str = "append", path: str | None = None, form: str = "parquet") -> StreamingQuery:
    """Process what is there and stop; to a memory table ``name`` or to files at ``path``."""
    writer = out.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = (writer.format("memory").queryName(name) if path is None else writer.format(form).option("path", path)).start()
    query.awaitTermination()
    return query


def fan_out(stream: DataFrame, checkpoint: str, handlers: dict[str, Callable[[DataFrame, int], None]], topic: str = "event_type", everything: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Each batch once, its rows to the handlers of their topic and to the general one."""

    def dispatch(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, handler in handlers.items():
            handler(batch.where(F.col(topic) == name), number)
        if everything is not None:
            everything(batch, number)
        batch.unpersist()

    query = stream.writeStream.foreachBatch(dispatch).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def publish(stream: DataFrame, folder: str, checkpoint: str, name: str = "event_id") -> StreamingQuery:
    """Each event as a file of its own in a folder for its day; ``json_events`` of others read them."""

    def drop(batch: DataFrame, number: int) -> None:
        batch.withColumn("day", F.to_date("ts")).write.mode("append").option("maxRecordsPerFile", 1).partitionBy("day").json(folder)

    query = stream.writeStream.foreachBatch(drop).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query


def tailed(spark: SparkSession, folder: str, schema: str, archive: str | None = None, glob: str = "*.json") -> DataFrame:
    """Files as they come into a folder, whole; with ``archive`` those done are moved there."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("multiLine", True)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder)
