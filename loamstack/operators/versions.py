"""Versions in a folder: a log in which each version is put only where none is, and keyed tables over it.

The log of a table holds, for each version, the folder of every bucket of keys.  A commit reads and
writes only the buckets that its changes touch; all other folders are shared with the version before.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..rounds import drop, kept

#: The most buckets of a table: the log's entries and the list of touched buckets grow with it, never with the rows.
MOST_BUCKETS = 4096


class Conflict(Exception):
    """Another writer has committed to what this one has read."""


class Log:
    """JSON entries numbered from 1; of two writers of one number only the first succeeds.

    An entry is written aside and then linked (local folders) or renamed (HDFS, which refuses a name
    that is taken) to its number, so that readers see whole entries only.  Stores whose rename replaces
    files cannot hold a log that has several writers.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def last(self) -> int:
        """The newest number; 0 where there is none."""
        found = self.files.globStatus(self.path(f"{self.folder}/[0-9]*.json"))  # a name for each version
        return max((int(f.getPath().getName()[:12]) for f in found or []), default=0)

    def read(self, number: int) -> dict:
        stream = self.files.open(self.path(self._name(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def put(self, number: int, entry: dict) -> bool:
        """Whether ``entry`` now is that number's; False where the number was taken."""
        aside, target = self.path(f"{self.folder}/_{uuid.uuid4().hex}"), self.path(self._name(number))
        out = self.files.create(aside, True)
        try:
            out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        finally:
            out.close()
        try:
            if self.files.getScheme() == "file":
                local = [unquote(urlparse(p.toUri().toString()).path) for p in (aside, target)]
                try:
                    os.link(*local)
                except FileExistsError:
                    return False
                return True
            return self.files.rename(aside, target)
        finally:
            self.files.delete(aside, False)


class Configs:
    """Versions of a configuration, with the digest of its sorted JSON; a rollback is a new version with old content."""

    def __init__(self, spark: SparkSession, folder: str):
        self.log = Log(spark, folder)

    def save(self, config: dict) -> int:
        """The version given to ``config``; writers at the same time get one each."""
        text = json.dumps(config, sort_keys=True)
        while True:
            number = self.log.last() + 1
            if self.log.put(number, {"version": number, "digest": hashlib.sha256(text.encode()).hexdigest(), "config": config}):
                return number

    def load(self, version: int | None = None) -> dict | None:
        number = version or self.log.last()
        return self.log.read(number)["config"] if number else None

    def rollback(self, version: int) -> int:
        return self.save(self.log.read(version)["config"])


class VersionedTable:
    """A table with one row a key, in ``buckets`` folders by the hash of its key.

    Rows whose key has nulls are one key like any other.  Of several rows of a key in one commit the last by
    ``order`` counts, of equal ones the one whose content hashes highest, so retries agree.  Readers keep
    their version while others commit.  Nothing deletes old folders.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.log = Log(spark, f"{self.folder}/_log")

    # ------------------------------------------------------------ reading

    def version(self) -> int:
        return self.log.last()

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.log.read(version or self.log.last()))

    def _rows(self, entry: dict, only: set[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        paths = [f"{self.folder}/data/{where}/_bucket={b}" for b, where in entry["buckets"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def history(self) -> DataFrame:
        """(version, operation, touched, kept, removed) of each commit."""
        entries = [self.log.read(n) for n in range(1, self.log.last() + 1)]
        rows = [(e["version"], e["operation"], len(e["touched"]), e["kept"], e["removed"]) for e in entries]
        return self.spark.createDataFrame(rows, "version long, operation string, touched long, kept long, removed long")

    # ------------------------------------------------------------ writing

    def create(self, rows: DataFrame, keys: list[str], order: list[str], buckets: int = 64) -> int:
        """Version 1 from ``rows``; Conflict where the folder has a table already."""
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"1 to {MOST_BUCKETS} buckets")
        if self.log.last():
            raise Conflict(f"{self.folder} has a table")
        entry = {"version": 0, "schema": json.loads(rows.schema.json()), "keys": keys, "number": buckets, "buckets": {}}
        return self._commit(rows, order, F.lit(False), entry, "create")

    def commit(self, changes: DataFrame, order: list[str], removed: Column | None = None, base: int | None = None) -> int:
        """The version with ``changes`` in it: rows replace those of their key, rows where ``removed`` holds take theirs away.

        ``base`` is the version that the changes were made from, by default the newest.  Other writers' commits since then
        are taken over if they touched other buckets; else Conflict is raised and nothing has changed.
        """
        entry = self.log.read(base or self.log.last())
        return self._commit(changes, order, F.lit(False) if removed is None else F.coalesce(removed, F.lit(False)), entry, "commit")

    def restore(self, version: int) -> int:
        """The rows of an old version as a new one; no row is copied."""
        old = self.log.read(version)
        while True:
            number = self.log.last() + 1
            if self.log.put(number, old | {"version": number, "operation": "restore", "touched": list(range(old["number"])), "kept": 0, "removed": 0}):
                return number

    def _latest(self, rows: DataFrame, names: list[str], keys: list[str], *order: Column) -> DataFrame:
        """One row of each key, with the last ``_row`` and ``_gone``, and whether the table had the key."""
        tie = F.xxhash64(F.to_json("_row"))
        last = F.max_by(F.struct("_row", "_gone"), F.struct(*order, tie)).alias("_last")
        out = rows.groupBy("_bucket", *[F.col(f"_row.{k}").alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(last, F.max("_old").alias("_old"))
        return out.select("_bucket", "_last.*", "_old")

    def _commit(self, changes: DataFrame, order: list[str], removed: Column, entry: dict, operation: str) -> int:
        names, keys = [f["name"] for f in entry["schema"]["fields"]], entry["keys"]
        bucket = F.pmod(F.xxhash64(*[F.col(f"_row.{k}") for k in keys]), F.lit(entry["number"])).cast("int")
        schema = StructType.fromJson(entry["schema"])
        tagged = changes.select(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).alias("_row"), removed.alias("_gone"), F.struct(*order).alias("_order"), F.lit(False).alias("_old"))
        # a key with very many changes comes down to one a task before the shuffle
        new = kept(self._latest(tagged.withColumn("_bucket", bucket), names, keys, F.col("_order")), "changes")
        touched = {r[0] for r in new.select("_bucket").distinct().collect()}  # at most MOST_BUCKETS
        if not touched and operation == "commit":
            drop(new)
            return entry["version"]
        old = self._rows(entry, touched).select(F.struct(*names).alias("_row")).select(bucket.alias("_bucket"), "_row", F.lit(False).alias("_gone"), F.lit(True).alias("_old"))
        both = old.unionByName(new).repartition("_bucket")  # the grouping by key and the writing by bucket both keep to it
        figures = Observation()
        result = self._latest(both, names, keys, ~F.col("_old")).observe(figures, F.count_if(~F.col("_gone")).alias("kept"), F.count_if(F.col("_gone") & F.col("_old")).alias("removed"))
        where = uuid.uuid4().hex
        result.where(~F.col("_gone")).select("_bucket", "_row.*").write.partitionBy("_bucket").parquet(f"{self.folder}/data/{where}")
        drop(new)
        made = self.log.files.globStatus(self.log.path(f"{self.folder}/data/{where}/_bucket=*"))  # at most MOST_BUCKETS
        written = {int(f.getPath().getName().split("=")[1]): where for f in made or []}
        counts = figures.get
        while True:
            buckets = {int(b): w for b, w in entry["buckets"].items() if int(b) not in touched} | written
            number = entry["version"] + 1
            now = entry | {"version": number, "operation": operation, "buckets": buckets, "touched": sorted(touched), "kept": counts.get("kept", 0), "removed": counts.get("removed", 0)}
            if self.log.put(number, now):
                return number
            entry = self.log.read(number)
            if operation == "create" or touched & set(entry["touched"]):
                raise Conflict(f"version {number} of {self.folder} has changed the same buckets")
