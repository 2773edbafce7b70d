"""What runs tell: each source read in a job of its own with its counts, and the progress of streams."""

from __future__ import annotations

import re
import threading
import time
from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

REPORT = "source string, status string, rows long, figures map<string,long>, seconds double, error string, file string"


def ingest(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], folder: str, figures: dict[str, tuple[str, Column]] | None = None, at_once: int = 4) -> tuple[dict[str, DataFrame], DataFrame]:
    """Each source written to a folder of its own by its own job; (what was written, the report).

    A source whose files cannot be read fails alone, wherever the job meets the bad file; of it nothing is kept.
    The report has a row for each source: ``done``, ``empty``, ``missing`` (no such path) or ``failed`` with the error and
    the file; rows and the counts of ``figures`` (a column and a condition on it; a source without the column has no such
    count) come from the pass that writes.
    """

    def run(name: str) -> tuple[DataFrame | None, tuple]:
        began, target, seen = time.time(), f"{folder}/{name}", Observation()
        try:
            rows = sources[name]()
            asked = {k: c for k, (column, c) in (figures or {}).items() if column in rows.columns}
            rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in asked.items()]).write.mode("overwrite").parquet(target)
            counts = {k: int(v or 0) for k, v in seen.get.items()}
            n = counts.pop("rows", 0)
            return spark.read.schema(rows.schema).parquet(target), (name, "done" if n else "empty", n, counts, time.time() - began, None, None)
        except Exception as error:
            text = str(error)
            gone = isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
            file = re.search(r"\w+:/+[^\s'\"]+", text)
            return None, (name, "missing" if gone else "failed", 0, {}, time.time() - began, text[:500], file and file.group().rstrip(".,"))

    with ThreadPoolExecutor(at_once) as pool:
        done = dict(zip(sources, pool.map(inheritable_thread_target(spark)(run), sources)))
    return {k: df for k, (df, _) in done.items() if df is not None}, spark.createDataFrame([row for _, row in done.values()], REPORT)


class Progress(StreamingQueryListener):
    """The last ``most`` batches of all streams of a session, as rows.  Use within ``with``."""

    SCHEMA = "query string, batch long, rows long, rows_per_second double, seconds double, state_rows long, late_rows long"

    def __init__(self, spark: SparkSession, most: int = 10_000):
        self.spark, self.batches, self.ended, self.lock = spark, deque(maxlen=most), {}, threading.Lock()

    def __enter__(self) -> Progress:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        with self.lock:
            self.batches.append((p.name or str(p.id), p.batchId, p.numInputRows, float(p.processedRowsPerSecond or 0), p.batchDuration / 1000, sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended[str(event.id)] = event.exception

    def frame(self) -> DataFrame:
        with self.lock:
            return self.spark.createDataFrame(list(self.batches), self.SCHEMA)
