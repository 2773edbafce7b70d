"""Token ids as raw binary shards with a minimal perfect hash index.

Documents are dealt into ranges of the key and sorted, encoded, and packed into
shard files of a bounded size.  A file holds a header, the index (bit levels of a
minimal perfect hash over the document keys, and for each slot the record and a
fingerprint of its key), the record offsets and the raw ids.  A lookup hashes the key,
ranks one bit, compares the fingerprint and reads one slice, whatever the file's size.
Files are rows of a Parquet table, so that Spark's own writer and reader move them in
any store it knows.

Defined results: null keys come first and are reached by position only; equal keys
follow each other and the index leads to the first; a null or empty text is the end id
alone; an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store
from .tokens import encoder

MAGIC = b"LOAMTOK1"
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: A file is closed when its ids take so many bytes.
SHARD_BYTES = 8 << 20
#: Bits for each key in a level of the hash.
SPREAD = 2.0
MAX_LEVELS = 40


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of the keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 977) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Levels of bits; a key's slot is the rank of the first set bit that it alone claimed."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits, dtype=np.int64) - bits + total)
            total += int(bits.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct."""
        levels, left = [], keys
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            m = max(64, int(SPREAD * len(left)) + 63 & ~63)
            at = (mix(left, len(levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has a bit for it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = (mix(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        return struct.pack("<I", len(self.levels)) + b"".join(struct.pack("<I", len(b)) + np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes, at: int) -> tuple[PerfectHash, int]:
        (n,), at, levels = struct.unpack_from("<I", raw, at), at + 4, []
        for _ in range(n):
            (m,) = struct.unpack_from("<I", raw, at)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, m // 8, at + 4)))
            at += 4 + m // 8
        return cls(levels), at


def pack_file(keys: list[int | None], ids: list[bytes], id_bytes: int) -> bytes:
    """keys: ascending, None first; ids: of each record, as little-endian unsigned 32-bit integers."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], "<i8")
    distinct, first = np.unique(known, return_index=True)
    hashed = PerfectHash.build(distinct)
    record, prints = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    slots = hashed.slots(distinct)
    record[slots], prints[slots] = first + nulls, fingerprints(distinct)
    ends = np.cumsum([len(i) // 4 for i in ids], dtype="<u8")
    index = hashed.to_bytes()
    payload = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{id_bytes}").tobytes()
    head = MAGIC + struct.pack("<IIIII", id_bytes, len(keys), nulls, len(distinct), len(index))
    return b"".join([head, index, record.tobytes(), prints.tobytes(), known.tobytes(), ends.tobytes(), payload])


class TokenFile:
    """Keyed and positional access to one file."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        self.id_bytes, self.count, self.nulls, distinct, index = struct.unpack_from("<IIIII", raw, 8)
        self.hash, at = PerfectHash.from_bytes(raw, 28)
        if at != 28 + index:
            raise ValueError("index length differs")
        self.record = np.frombuffer(raw, "<u4", distinct, at)
        self.prints = np.frombuffer(raw, "<u4", distinct, at + 4 * distinct)
        at += 8 * distinct
        self.keys = np.frombuffer(raw, "<i8", self.count - self.nulls, at)
        at += 8 * (self.count - self.nulls)
        self.ends = np.frombuffer(raw, "<u8", self.count, at).astype(np.int64)
        self.ids = np.frombuffer(raw, f"<u{self.id_bytes}", offset=at + 8 * self.count)

    def records(self, keys: np.ndarray) -> np.ndarray:
        """First record of each key; -1 for a key that is not in the file."""
        slots = self.hash.slots(keys)
        if not self.hash.size:
            return slots
        found = (slots >= 0) & (self.prints[slots] == fingerprints(keys))
        return np.where(found, self.record[slots].astype(np.int64), -1)

    def read(self, record: int) -> np.ndarray:
        return self.ids[self.ends[record - 1] if record else 0 : self.ends[record]]

    def get(self, key: int) -> np.ndarray | None:
        record = int(self.records(np.array([key], np.int64))[0])
        return None if record < 0 else self.read(record)


FILES = "range int, file int, first_key long, last_key long, n_docs long, n_ids long, ids_in_range_before long, bytes binary"


def _writer(file: str, path: str | None, end_id: int):
    tail = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, part = encoder(file, path), TaskContext.get().partitionId()
        id_bytes = 2 if coder.tokenizer.get_vocab_size() <= 65536 and end_id < 65536 else 4
        keys, ids, size, number, before = [], [], 0, 0, 0

        def close() -> pd.DataFrame:
            known = [k for k in keys if k is not None]
            row = (part, number, known[0] if known else None, known[-1] if known else None, len(keys), size // 4, before, pack_file(keys, ids, id_bytes))
            out = pd.DataFrame([row], columns=["range", "file", "first_key", "last_key", "n_docs", "n_ids", "ids_in_range_before", "bytes"])
            return out.astype({"first_key": "Int64", "last_key": "Int64"})

        for rows in batches:
            for key, text in zip(rows["doc_id"].astype("object").where(rows["doc_id"].notna(), None), rows["text"]):
                keys.append(None if key is None else int(key))
                ids.append(coder.encode(text if isinstance(text, str) else None) + tail)
                size += len(ids[-1])
                if size // 4 * id_bytes >= SHARD_BYTES:
                    yield close()
                    keys, ids, size, number, before = [], [], 0, number + 1, before + size // 4
        if keys:
            yield close()

    return write


def write_tokens(docs: DataFrame, file: str = VOCABULARY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """The table of files, in the shared folder; ``docs`` has doc_id and text."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text").alias("tie")
    ordered = docs.select(F.col("doc_id").cast("long"), "text", tie).repartitionByRange(ranges, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    # A folder for each range, so that a lookup leaves the others unread.
    return store.materialize(ordered.select("doc_id", "text").mapInPandas(_writer(file, path, end_id), FILES), "tokens", ["range"])


def directory(files: DataFrame) -> DataFrame:
    """A stored table of each file's range, number, first and last key, by which lookups find their files; some 24 bytes a file."""
    return store.materialize(files.where("first_key IS NOT NULL").select("range", "file", "first_key", "last_key"), "directory")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for raw, start in zip(rows["bytes"], rows["ids_before"]):
            f = TokenFile(raw)
            # Records of equal keys follow each other: the index gives the first, the run's place the rest.
            first = f.records(f.keys)
            run = np.arange(len(f.keys)) - np.searchsorted(f.keys, f.keys, "left")
            if (first < 0).any() or not np.array_equal(first + run, np.arange(f.nulls, f.count)):
                raise ValueError("the index does not lead to its records")
            records = [*range(f.nulls), *(first + run).tolist()]
            begins = np.concatenate([[0], f.ends[:-1]])
            yield pd.DataFrame({
                "doc_id": pd.array([None] * f.nulls + f.keys.tolist(), "Int64"),
                "start": int(start) + begins[records],
                "n_tokens": (f.ends - begins)[records],
                "ids_crc32": [zlib.crc32(f.read(r).astype("<u4").tobytes()) for r in records],
            })


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range of keys: bounded by the number of partitions.
    totals = files.groupBy("range").agg(F.sum("n_ids").alias("n"))
    starts = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_before"))
    placed = files.select("range", "ids_in_range_before", "bytes").join(F.broadcast(starts), "range")
    placed = placed.select("bytes", (F.col("range_before") + F.col("ids_in_range_before")).alias("ids_before"))
    return placed.mapInPandas(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


#: Files whose first keys are held by every task of a lookup; more are looked up through a join by range.
DIRECTORY_FILES = 1 << 20
#: Ranges that a lookup names to the reader, which then opens no others; of more, all files are read.
NAMED_RANGES = 1 << 14


def lookup(files: DataFrame, keys: DataFrame, where: DataFrame | None = None) -> DataFrame:
    """(doc_id, ids) of the distinct keys (doc_id) that the files have; of equal keys the first record.

    The ``directory`` tells which file may have a key.  Only folders of the ranges asked for are opened, and only the files
    asked for go on to tasks; in a file one hash, one rank and one fingerprint find the record.  Nothing of a file
    but its numbers is broadcast.
    """
    directory_ = directory(files) if where is None else where
    asked = keys.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct()
    bounds = directory_.orderBy("first_key", "range", "file").limit(DIRECTORY_FILES + 1).toArrow()  # at most DIRECTORY_FILES rows
    if bounds.num_rows > DIRECTORY_FILES:
        spans = directory_.groupBy("range").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))  # a row for each partition of the writer
        placed = asked.join(F.broadcast(spans), F.col("doc_id").between(F.col("low"), F.col("high"))).select("doc_id", "range").join(directory_, "range")
        placed = placed.where(F.col("doc_id").between(F.col("first_key"), F.col("last_key"))).select("doc_id", "range", "file")
    else:
        columns = {c: bounds[c].to_numpy() for c in ("first_key", "last_key", "range", "file")}
        shared = files.sparkSession.sparkContext.broadcast(columns)  # at most DIRECTORY_FILES rows

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            c = shared.value
            for rows in batches:
                key = rows["doc_id"].to_numpy(np.int64)
                # A key's records may begin at the end of the file before; equal keys lie in neighbouring files.
                low, high = np.searchsorted(c["last_key"], key, "left"), np.searchsorted(c["first_key"], key, "right")
                many = np.maximum(high - low, 0)
                at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                yield pd.DataFrame({"doc_id": np.repeat(key, many), "range": c["range"][at], "file": c["file"][at]})

        placed = asked.mapInPandas(place, "doc_id long, range int, file int")
    wanted = store.materialize(placed.groupBy("range", "file").agg(F.collect_list("doc_id").alias("keys")), "wanted")  # at most the keys of a file
    ranges = [r["range"] for r in wanted.select("range").distinct().limit(NAMED_RANGES + 1).collect()]
    opened = files.select("range", "file", "bytes")
    if len(ranges) <= NAMED_RANGES:
        opened = opened.where(F.col("range").isin(ranges))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for raw, found, number in zip(rows["bytes"], rows["keys"], rows["place"]):
                f, found = TokenFile(raw), np.asarray(found, np.int64)
                records = f.records(found)
                hit = records >= 0
                yield pd.DataFrame({"doc_id": found[hit], "place": number, "ids": [f.read(r).astype(np.int64).tolist() for r in records[hit]]})

    place_of = (F.col("range").cast("long") * (1 << 32) + F.col("file")).alias("place")
    # The keys go to the files: files' bytes are neither broadcast nor, where the keys are few, shuffled.
    rows = opened.join(wanted.hint("broadcast") if len(ranges) <= NAMED_RANGES and wanted.count() <= DIRECTORY_FILES and asked.count() <= DIRECTORY_FILES else wanted.hint("merge"), ["range", "file"]).select("bytes", "keys", place_of)
    return rows.mapInPandas(read, "doc_id long, place long, ids array<long>").groupBy("doc_id").agg(F.min_by("ids", "place").alias("ids"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(store.table(spark, sf_dir, "documents").select("doc_id", "text")))
