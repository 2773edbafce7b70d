"""Benchmark decontamination on a positional inverted index of the training text.

The corpus is indexed in segments of whole documents.  A segment keeps, for each
term of the benchmark's vocabulary, the ascending positions where it stands, as in a
search engine.  A benchmark window is found by taking the positions of its rarest term
over the whole corpus, shifting them by the term's place in the window, and
intersecting with the shifted lists of the next rarest terms until all have agreed;
with a slop each further term may stand that far from its place (proximity).

A benchmark of more than ``BLOCK_BYTES`` is searched block by block against the whole corpus.

Defined results: a null or wordless text has no words and no hits; a wordless or null
benchmark text has no windows; a null item id is written as an empty string; repeated
items count once; repeated documents are each judged; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import memory, store

WINDOW = 13
#: A document is contaminated if it has hits and one word in so many is hit.
HIT_SHARE = 20
#: Words of a segment before it is closed (a document is never cut).
SEGMENT_WORDS = 1_000_000
#: Bytes of benchmark text that are searched at once.
BLOCK_BYTES = 16 << 20

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and other characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if isinstance(text, str) else []


class Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


class Windows:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, str | None]], size: int = WINDOW):
        found: dict[tuple[int, ...], set[str]] = defaultdict(set)
        self.vocabulary = Vocabulary()
        for item, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            for k in range(max(1, len(codes) - size + 1) if codes else 0):
                found[tuple(codes[k : k + size])].add(item)
        self.items = [sorted(i) for i in found.values()]
        self.length = np.array([len(w) for w in found], np.int64)
        self.terms = np.full((len(found), size), -1, np.int64)
        for row, w in enumerate(found):
            self.terms[row, : len(w)] = w

    def by_rarity(self, counts: np.ndarray) -> None:
        """Order the places of each window by their terms' counts over the corpus, the rarest first."""
        known = np.where(self.terms >= 0, counts[self.terms], np.iinfo(np.int64).max)
        self.place = np.argsort(known, axis=1, kind="stable")
        self.ordered = np.take_along_axis(self.terms, self.place, axis=1)


SEGMENTS = "segment long, doc_ids array<bigint>, n_words array<int>, terms array<int>, counts array<int>, postings binary"


def _indexer(vocabulary):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory.begin("decontaminate")
        code, segment = vocabulary.value.__getitem__, TaskContext.get().partitionId() << 32
        ids, lengths, parts, size = [], [], [], 0
        gap = np.array([-1], np.int32)

        def close() -> pd.DataFrame:
            codes = np.concatenate(parts)
            at = np.flatnonzero(codes >= 0)
            order = np.argsort(codes[at], kind="stable")
            terms, starts, counts = np.unique(codes[at][order], return_index=True, return_counts=True)
            positions = at[order].astype("<u4")
            steps = np.diff(positions, prepend=np.uint32(0))
            steps[starts] = positions[starts]
            row = (segment, ids, lengths, terms.tolist(), counts.tolist(), steps.astype("<u4").tobytes())
            return pd.DataFrame([row], columns=["segment", "doc_ids", "n_words", "terms", "counts", "postings"])

        for rows in batches:
            for key, text in zip(rows["doc_id"].astype("object").where(rows["doc_id"].notna(), None), rows["text"]):
                found = words(text)
                ids.append(None if key is None else int(key))
                lengths.append(len(found))
                parts += [np.fromiter(map(code, found), np.int32, len(found)), gap]
                size += len(found) + 1
                if size >= SEGMENT_WORDS:
                    yield close()
                    ids, lengths, parts, size, segment = [], [], [], 0, segment + 1
        if ids:
            yield close()

    return run


def build_index(docs: DataFrame, windows: Windows) -> DataFrame:
    """The table of segments, in the shared folder."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(windows.vocabulary)  # of a block of bounded size
    return store.materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(_indexer(vocabulary), SEGMENTS), "segments")


def term_counts(index: DataFrame, size: int) -> np.ndarray:
    """Occurrences of each term over the whole corpus."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n"))
    counts = np.zeros(max(1, size), np.int64)
    for row in pairs.collect():  # at most as many as the block's vocabulary
        counts[row["terms"]] = row["n"]
    return counts


def intersect(windows: Windows, terms: np.ndarray, counts: np.ndarray, postings: bytes, slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of the windows found in a segment."""
    steps = np.frombuffer(postings, "<u4").astype(np.int64)
    ends = np.cumsum(counts)
    starts = ends - counts
    if not len(steps) or not len(windows.length):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    total = np.cumsum(steps)
    base = np.where(starts > 0, total[starts - 1], 0)
    positions = total - np.repeat(base, counts)
    keys = np.repeat(terms.astype(np.int64) << 33, counts) + positions
    rank = np.full(int(max(terms.max(), windows.terms.max())) + 1, -1, np.int64)
    rank[terms] = np.arange(len(terms))
    # The rarest term's list gives the candidates.
    rare = rank[windows.ordered[:, 0]]
    alive = np.flatnonzero(rare >= 0)
    n = counts[rare[alive]]
    window = np.repeat(alive, n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = positions[np.repeat(starts[rare[alive]], n) + within] - windows.place[window, 0]
    keep = start >= 0
    window, start = window[keep], start[keep]
    for k in range(1, windows.terms.shape[1]):
        if not len(window):
            break
        term = windows.ordered[window, k]
        wanted = (term << 33) + np.maximum(start + windows.place[window, k] - slop, 0)
        at = np.searchsorted(keys, wanted)
        found = keys[np.minimum(at, len(keys) - 1)]
        met = (at < len(keys)) & (found >> 33 == term) & ((found & (1 << 33) - 1) <= start + windows.place[window, k] + slop)
        keep = met | (k >= windows.length[window])
        window, start = window[keep], start[keep]
    return window, start


MATCHES = "segment long, doc int, starts array<int>, lengths array<int>, items array<string>"


def _searcher(windows, slop: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory.begin("decontaminate")
        w = windows.value
        for rows in batches:
            for r in rows.itertuples():
                window, start = intersect(w, np.asarray(r.terms, np.int64), np.asarray(r.counts, np.int64), r.postings, slop)
                lengths = np.asarray(r.n_words, np.int64)
                begins = np.cumsum(lengths + 1) - lengths - 1
                doc = np.searchsorted(begins, start, "right") - 1
                order = np.lexsort((window, start, doc))
                doc, window, start = doc[order], window[order], start[order]
                out = []
                for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) if len(doc) else []:
                    d = int(doc[part[0]])
                    items = {i for x in np.unique(window[part]).tolist() for i in w.items[x]}
                    out.append((r.segment, d, (start[part] - begins[d]).tolist(), w.length[window[part]].tolist(), sorted(items)))
                if out:
                    yield pd.DataFrame(out, columns=["segment", "doc", "starts", "lengths", "items"])

    return run


def find_windows(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """(segment, doc, starts, lengths, items): where windows stand, a row for each document with any."""
    windows.by_rarity(term_counts(index, len(windows.vocabulary)))
    shared = index.sparkSession.sparkContext.broadcast(windows)  # of a block of bounded size
    return index.select("segment", "n_words", "terms", "counts", "postings").mapInPandas(_searcher(shared, slop), MATCHES)


def benchmark_blocks(benchmark: DataFrame) -> list[DataFrame]:
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    return [items] if n <= 1 else [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def contamination(docs: DataFrame, benchmark: DataFrame, slop: int = 0) -> DataFrame:
    """A row for each document: doc_id, n_words, n_hit, n_items, items, contaminated."""
    blocks = benchmark_blocks(benchmark)
    if len(blocks) > 1:
        docs = store.materialize(docs.select("doc_id", "text"), "corpus")  # each block meets the same documents in the same places
    places = matches = None
    for block in blocks:
        windows = Windows([(r["item"], r["text"]) for r in block.collect()])
        index = build_index(docs, windows)
        places = index if places is None else places
        found = find_windows(index, windows, slop)
        if len(blocks) > 1:
            found = store.materialize(found, "matches")
        matches = found if matches is None else matches.unionByName(found)
    places = places.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("doc", "x")).select("segment", "doc", F.col("x.doc_ids").alias("doc_id"), F.col("x.n_words").cast("long").alias("n_words"))
    if len(blocks) > 1:
        matches = matches.groupBy("segment", "doc").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("lengths")).alias("lengths"), F.flatten(F.collect_list("items")).alias("items"))
    hit = F.expr("size(array_distinct(flatten(transform(arrays_zip(starts, lengths), x -> sequence(x.starts, x.starts + x.lengths - 1)))))")
    matches = matches.select("segment", "doc", hit.cast("long").alias("hit"), F.array_sort(F.array_distinct("items")).alias("found"))
    joined = places.join(matches, ["segment", "doc"], "left")
    n_hit, items = F.coalesce("hit", F.lit(0).cast("long")), F.coalesce("found", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(store.table(spark, sf_dir, "documents"), store.table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP2_SQL = f"""
WITH b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {_SQL_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, l, array_to_string(w[i : i + l - 1], ' ') AS g
  FROM (SELECT item, w, least(len(w), {WINDOW}) AS l, unnest(range(1, (len(w) - least(len(w), {WINDOW}) + 2)::BIGINT)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
dw AS (
  SELECT doc_id, l, i, array_to_string(w[i : i + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, (len(w) - l + 2)::BIGINT)) AS i FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
m AS (SELECT doc_id, item, i, l FROM dw JOIN bw USING (l, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
