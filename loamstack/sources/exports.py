"""Paged exports as a Spark data source: read in parts, read as a stream by count, written page by page.

An export is a growing sequence of JSON items that keeps its order: behind an HTTP address that answers
``?offset=&limit=`` with ``{"items": [...], "total": n}``, or in a folder of page files
with commit records.  The source gives (place, item); items are parsed by ``from_json`` in the JVM.

* Batch: the total is asked once and cut into ranges, each a task that fetches its pages.
* Stream: the offset is the count of items read.  A restart goes on from the checkpoint's count, so nothing
  is lost or repeated; an export that has become shorter fails the query.
* Writing: each task puts pages of its own down; the driver then puts one commit record of their
  names and counts.  Pages without a record (of failed tasks or batches) are never read.  A stream's
  record has the batch's number in its name, so a batch that is run again commits once.

Folders may be in any store that Arrow's file systems reach (local, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

NAME = "paged_export"
ITEMS = "place long, item string"
#: Items of one page, and items that one task fetches.
PAGE_ITEMS, TASK_ITEMS = 1000, 50_000
#: Answers that are asked for again, how often, and the first pause in seconds, which doubles.
AGAIN, TRIES, PAUSE = (408, 425, 429, 500, 502, 503, 504), 5, 0.2


class HttpPages:
    """An export behind an address.  Options: ``items`` and ``total`` name the answer's fields, ``param.*`` and ``header.*`` are sent along."""

    def __init__(self, url: str, options: dict[str, str]):
        self.url = url
        self.items, self.count = options.get("items", "items"), options.get("total", "total")
        self.params = {k[6:]: v for k, v in options.items() if k.startswith("param.")}
        self.headers = {k[7:]: v for k, v in options.items() if k.startswith("header.")}

    def _get(self, offset: int, limit: int) -> dict:
        query = urllib.parse.urlencode(self.params | {"offset": offset, "limit": limit})
        asked = urllib.request.Request(f"{self.url}{'&' if '?' in self.url else '?'}{query}", headers=self.headers)
        return json.loads(_answered(asked))

    def total(self) -> int:
        return int(self._get(0, 0)[self.count])

    def read(self, start: int, stop: int, page: int) -> Iterator[list[str]]:
        while start < stop:
            items = self._get(start, min(page, stop - start))[self.items]
            if not items:
                raise ValueError(f"{self.url} has no item {start}, of {stop} that it told of")
            items = items[: stop - start]
            yield [json.dumps(x, ensure_ascii=False) for x in items]
            start += len(items)  # a server may give shorter pages than it was asked for


def _answered(asked: urllib.request.Request) -> bytes:
    pause = PAUSE
    for k in range(TRIES):
        try:
            with urllib.request.urlopen(asked, timeout=60) as answer:
                return answer.read()
        except urllib.error.HTTPError as error:
            if error.code not in AGAIN or k == TRIES - 1:
                raise
            told = error.headers.get("Retry-After", "")
            time.sleep(float(told) if told.isdigit() else pause)
        except urllib.error.URLError:
            if k == TRIES - 1:
                raise
            time.sleep(pause)
        pause *= 2
    raise AssertionError("unreachable")


class FolderPages:
    """An export in a folder: ``pages/`` has lines of JSON, ``commits/`` records of page names and counts in order of their names."""

    def __init__(self, url: str):
        self.fs, self.path = fs.FileSystem.from_uri(url)

    def commits(self) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.path}/commits", allow_not_found=True))
        return sorted(f.path for f in found if f.is_file and f.base_name.endswith(".json"))

    def pages(self) -> list[tuple[str, int]]:
        out = []
        for path in self.commits():
            with self.fs.open_input_stream(path) as f:
                out += json.loads(f.read())["pages"]
        return [(name, count) for name, count in out]

    def total(self) -> int:
        return sum(count for _, count in self.pages())

    def read(self, start: int, stop: int, page: int) -> Iterator[list[str]]:
        at = 0
        for name, count in self.pages():
            low, high = max(start - at, 0), min(stop - at, count)
            if low < high:
                with self.fs.open_input_stream(f"{self.path}/pages/{name}") as f:
                    yield f.read().decode().split("\n")[low:high]
            at += count

    def put_page(self, items: list[str]) -> tuple[str, int]:
        name = f"{uuid.uuid4().hex}.jsonl"
        self.fs.create_dir(f"{self.path}/pages")
        with self.fs.open_output_stream(f"{self.path}/pages/{name}") as f:
            f.write("\n".join(items).encode())
        return name, len(items)

    def put_commit(self, name: str, pages: list[tuple[str, int]]) -> None:
        """A record is moved into place whole; one that is there stays."""
        self.fs.create_dir(f"{self.path}/commits")
        target = f"{self.path}/commits/{name}.json"
        if self.fs.get_file_info(target).type != fs.FileType.NotFound:
            return
        draft = f"{self.path}/commits/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as f:
            f.write(json.dumps({"pages": pages}).encode())
        self.fs.move(draft, target)

    def remove(self, pages: list[tuple[str, int]]) -> None:
        for name, _ in pages:
            self.fs.delete_file(f"{self.path}/pages/{name}")

    def clear(self) -> None:
        if self.fs.get_file_info(self.path).type == fs.FileType.Directory:
            self.fs.delete_dir_contents(self.path)


def _pages(options: dict[str, str]):
    url = options["path"]
    return HttpPages(url, options) if url.startswith(("http://", "https://")) else FolderPages(url)


@dataclass
class Range(InputPartition):
    start: int
    stop: int


class _Ranges:
    """Ranges of places, and the items of a range as Arrow batches."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.page, self.task = int(options.get("page_items", PAGE_ITEMS)), int(options.get("task_items", TASK_ITEMS))

    def cut(self, start: int, stop: int) -> list[Range]:
        return [Range(k, min(k + self.task, stop)) for k in range(start, stop, self.task)]

    def batches(self, part: Range) -> Iterator[pa.RecordBatch]:
        at = part.start
        for items in _pages(self.options).read(part.start, part.stop, self.page):
            yield pa.record_batch([pa.array(range(at, at + len(items)), pa.int64()), pa.array(items, pa.string())], names=["place", "item"])
            at += len(items)
        if at != part.stop:
            raise ValueError(f"{part.stop - at} items of the export are missing from {at} on")


class _Reader(_Ranges, DataSourceReader):
    def partitions(self) -> list[Range]:
        return self.cut(0, _pages(self.options).total()) or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.batches(partition)


class _StreamReader(_Ranges, DataSourceStreamReader):
    """A batch takes what is there, in as many tasks as it needs."""

    def initialOffset(self) -> dict:
        return {"count": int(self.options.get("from", 0))}

    def latestOffset(self) -> dict:
        return {"count": _pages(self.options).total()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        if end["count"] < start["count"]:
            raise ValueError(f"the export has {end['count']} items, {start['count']} were read before")
        return self.cut(start["count"], end["count"])

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.batches(partition)


@dataclass
class Put(WriterCommitMessage):
    part: int
    pages: list[tuple[str, int]]


class _Pages:
    def __init__(self, options: dict[str, str], overwrite: bool = False):
        self.options, self.overwrite = dict(options), overwrite
        self.page = int(options.get("page_items", PAGE_ITEMS))
        if not isinstance(_pages(self.options), FolderPages):
            raise ValueError("exports are written to folders")

    def put(self, iterator: Iterator[pa.RecordBatch]) -> Put:
        target, pages, held = _pages(self.options), [], []
        for batch in iterator:
            held += batch.column("item").to_pylist()
            while len(held) >= self.page:
                pages.append(target.put_page(held[: self.page]))
                held = held[self.page :]
        if held:
            pages.append(target.put_page(held))
        return Put(TaskContext.get().partitionId(), pages)

    @staticmethod
    def in_order(messages: list[Put | None]) -> list[tuple[str, int]]:
        return [p for m in sorted((m for m in messages if m), key=lambda m: m.part) for p in m.pages]

    def forget(self, messages: list[Put | None]) -> None:
        _pages(self.options).remove(self.in_order(messages))


class _Writer(_Pages, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Put:
        return self.put(iterator)

    def commit(self, messages: list[Put | None]) -> None:
        target = _pages(self.options)
        target.put_commit(f"{len(target.commits()):020d}-{uuid.uuid4().hex}", self.in_order(messages))

    def abort(self, messages: list[Put | None]) -> None:
        self.forget(messages)


class _StreamWriter(_Pages, DataSourceStreamArrowWriter):
    """One commit for each batch; then those named in the option ``notify`` (addresses apart by blanks) are told of it, at least once."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Put:
        return self.put(iterator)

    def commit(self, messages: list[Put | None], batchId: int) -> None:
        target, pages = _pages(self.options), self.in_order(messages)
        target.put_commit(f"{batchId:020d}", pages)
        upto = target.total()
        for url in self.options.get("notify", "").split():
            body = json.dumps({"batch": batchId, "upto": upto}).encode()
            _answered(urllib.request.Request(url, body, {"Content-Type": "application/json", "Idempotency-Key": str(batchId)}, method="POST"))

    def abort(self, messages: list[Put | None], batchId: int) -> None:
        self.forget(messages)


class PagedExport(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return ITEMS

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            _pages(dict(self.options)).clear()
        return _Writer(self.options, overwrite)

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options, overwrite)


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(PagedExport)
    return spark


def _parsed(rows: DataFrame, schema: str) -> DataFrame:
    return rows.select("place", F.from_json("item", schema).alias("x")).select("place", "x.*")


def read_export(spark: SparkSession, url: str, schema: str, **options) -> DataFrame:
    """(place, the columns of ``schema``) of all items."""
    return _parsed(_registered(spark).read.format(NAME).options(**options).load(url), schema)


def stream_export(spark: SparkSession, url: str, schema: str, **options) -> DataFrame:
    """The same as a stream of the items from the checkpoint's count on."""
    return _parsed(_registered(spark).readStream.format(NAME).options(**options).load(url), schema)


#: Times keep their microseconds.
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _as_items(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), JSON).alias("item"))


def write_export(df: DataFrame, url: str, order: list[str] | None = None, overwrite: bool = False, **options) -> None:
    """Append the rows to an export, in order; each task writes a range of it."""
    _registered(df.sparkSession)
    rows = df if order is None else df.repartitionByRange(*order).sortWithinPartitions(*order)
    _as_items(rows).write.format(NAME).mode("overwrite" if overwrite else "append").options(**options).save(url)


def push(stream: DataFrame, url: str, checkpoint: str, topics: list[str] | None = None, topic: str = "topic", **options) -> StreamingQuery:
    """Append a stream's rows to an export and tell its subscribers; with ``topics`` only those of these topics and those for ``all``."""
    _registered(stream.sparkSession)
    rows = stream if topics is None else stream.where(F.col(topic).isin(*topics, "all"))
    query = _as_items(rows).writeStream.format(NAME).options(**options).option("path", url).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
