"""Near-duplicate documents by a signature-coordinate inverted join.

Each document gets the distinct hashes of its five-word shingles and a MinHash
signature.  Documents with equal sets are one representative.  A representative is posted
under each coordinate-value pair of its signature; pairs that no other document has
are counted and dropped.  Two sets with a similarity of 0.75 agree on at least
``MATCHES`` of ``COORDINATES`` coordinates (but for about one pair in 10^8), so of
the pairs ordered by how many documents have them (rarest first) both must share one among
their first ``COORDINATES - MATCHES + 1``: only this prefix is merged, and frequent
values, such as those of passages that many documents share, are skipped.

Two documents meet only in the first list that both have, and lists are not expanded
into all pairs.  The first round holds the documents of a list
against its most central one, which shares the largest part of its shingles with others;
copies of one text then mostly have one component.  The second round takes more central
ones, later rounds the documents outside the list's main component; each is held
against the list's documents of other components.  Pairs whose sizes, shared
shingles or parities rule a link out are not made, those that agree on too few coordinates
are dropped, the others are confirmed on the full sets, and links join components.  The
parity of a set has a bit for each residue of its hashes, set where an odd number have it;
what two sets have in common cancels out, so the bits in which their parities differ are no
more than the shingles that only one has, and no link is lost by it.  A
centre leaves the list after its round and a list of one component is done, so every pair
of a list is tried, ruled out or known to be joined.  A list of n documents that nothing rules
out and nothing links takes n / ``OUTSIDE`` rounds and n * n / 2 trials; long lists are dealt
into parts, so that one list is the work of many tasks.

Defined results: a null or wordless text has an empty set, links with nothing and is its
own component; a row without id is not linked, its component is null and it is kept;
repeated rows have equal sets and share a component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bloom, memory, store
from .components import connected_components

SHINGLE = 5
#: Similarity of a link, in hundredths.
SIMILARITY = 75
COORDINATES = 64
MATCHES = 28
#: Bytes kept of each shingle's hash when sets are confirmed.
HASH_BYTES = 6
#: Central documents of a list that are tried in the second round.
CENTRAL = 32
#: Documents outside a list's main component that are tried in a later round.
OUTSIDE = 256
#: Documents of a list that one task holds against its centres; longer lists are dealt into parts, each with all centres.
PART = 512
#: 64-bit words of a set's parity.
PARITY = 16
MEMORY_WORDS = 200_000

_rng = np.random.default_rng(20240607)
_TERM = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _rng.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64)
_SCALE = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_hashes = WordHashes()


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; of the whole sequence if shorter."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    w = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    if not len(w):
        return w
    with np.errstate(over="ignore"):
        if len(w) < SHINGLE:
            mixed = (w * _TERM[: len(w)]).sum(keepdims=True) + _SHORT[len(w)]
        else:
            n = len(w) - SHINGLE + 1
            mixed = w[:n] * _TERM[0]
            for k in range(1, SHINGLE):
                mixed = mixed + w[k : n + k] * _TERM[k]
        return np.unique(_finish(mixed))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Least 32-bit value of the set under each coordinate's function."""
    low = np.full(COORDINATES, 0xFFFFFFFFFFFFFFFF, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), 256):
            low = np.minimum(low, (hashes[k : k + 256, None] * _SCALE + _SHIFT).min(axis=0))
    return (low >> np.uint64(32)).astype("<u4")


SIGNED = "doc_id long, n_shingles long, set_key binary, signature binary"


def _begin() -> None:
    memory.begin("near_dup")
    memory.hold("near_dup", _hashes.clear)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    _begin()
    for rows in batches:
        out = []
        for key, text in zip(rows["doc_id"].astype("object").where(rows["doc_id"].notna(), None), rows["text"]):
            hashes = shingle_set(text)
            raw = hashes.tobytes()
            out.append((key, len(hashes), xxhash.xxh3_128_digest(raw) if raw else None, signature(hashes).tobytes() if raw else None))
        yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "set_key", "signature"]).astype({"doc_id": "Int64"})


def _post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """rep, signature -> a row for each coordinate-value pair."""
    high = np.arange(COORDINATES, dtype=np.int64) << 32
    for rows in batches:
        values = np.frombuffer(b"".join(rows["signature"]), "<u4").reshape(-1, COORDINATES).astype(np.int64) + high
        yield pd.DataFrame({"pair": values.reshape(-1), "rep": np.repeat(rows["rep"].to_numpy(), COORDINATES)})


def prefix_posts(reps: DataFrame) -> DataFrame:
    """(pair, rep): the coordinate-value pairs among a document's rarest that another document has."""
    posts = store.materialize(reps.select("rep", "signature").mapInPandas(_post, "pair long, rep long"), "posts")
    shared = posts.groupBy("pair").count().where("count > 1")
    known = posts.join(shared, "pair").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("count", "pair"))).alias("pairs"))  # at most COORDINATES
    kept = known.where(F.size("pairs") >= MATCHES).select("rep", F.explode(F.expr(f"slice(pairs, 1, size(pairs) - {MATCHES - 1})")).alias("p"))
    out = store.materialize(kept.select(F.col("p.pair").alias("pair"), "rep"), "prefixes")
    store.drop(posts)
    return out


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bit for each residue of the hashes, set where an odd number of them have it."""
    odd = np.bincount((hashes % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    _begin()
    for rows in batches:
        keys, packed, bits = [], [], []
        for text in rows["text"]:
            hashes = shingle_set(text)
            keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            bits.append(parity(hashes))
            short = np.unique(hashes >> np.uint64(64 - 8 * HASH_BYTES))
            packed.append(short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes())
        yield pd.DataFrame({"rep": rows["doc_id"], "set_key": keys, "hashes": packed, "parity": bits})


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // HASH_BYTES, 8), np.uint8)
    out[:, :HASH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BYTES)
    return out.reshape(-1).view("<u8")


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """rep, hashes -> a row for each shingle."""
    for rows in batches:
        found = [_unpack(h).astype(np.int64) for h in rows["hashes"]]
        if found:
            yield pd.DataFrame({"rep": np.repeat(rows["rep"].to_numpy(), [len(f) for f in found]), "hash": np.concatenate(found)})


def candidate_sets(posts: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, n, shared, signature, parity, hashes) of the representatives that have posts.

    ``shared`` counts the shingles that another of them has: no intersection can be larger.
    """
    wanted = reps.join(posts.select("rep").distinct(), "rep", "left_semi").select("rep", "set_key", "signature")
    wanted = store.materialize(wanted, "wanted")
    # Only texts that the filter lets pass are shuffled.
    texts = bloom.apart(docs, "doc_id", wanted.select(F.col("rep").alias("doc_id")))[0].join(wanted.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sets = texts.mapInPandas(_sets, "rep long, set_key binary, hashes binary, parity array<long>").join(wanted, ["rep", "set_key"])
    stored = store.materialize(sets.select("rep", "signature", "parity", "hashes"), "sets")
    sets = stored.dropDuplicates(["rep"])
    rows = store.materialize(sets.select("rep", "hashes").mapInPandas(_spread, "rep long, hash long"), "shingles")
    twice = rows.groupBy("hash").count().where("count > 1").select("hash")
    shared = rows.join(twice, "hash").groupBy("rep").agg(F.count("*").cast("int").alias("shared"))
    n = (F.octet_length("hashes") / HASH_BYTES).cast("int")
    out = store.materialize(sets.select("rep", n.alias("n"), "signature", "parity", "hashes").join(shared, "rep"), "candidates")
    for t in (rows, wanted, stored):
        store.drop(t)
    return out


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidates that agree on enough coordinates and whose full sets are similar enough."""
    for rows in batches:
        if not len(rows):
            continue
        a = np.frombuffer(b"".join(rows["sig_a"]), "<u4").reshape(-1, COORDINATES)
        b = np.frombuffer(b"".join(rows["sig_b"]), "<u4").reshape(-1, COORDINATES)
        rows = rows[(a == b).sum(axis=1) >= MATCHES]
        keep = []
        for x, y in zip(rows["set_a"], rows["set_b"]):
            x, y = _unpack(x), _unpack(y)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= SIMILARITY * (len(x) + len(y) - both))
        yield rows.loc[np.array(keep, bool), ["a", "b"]]


def confirmed(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    side = candidates.select("rep", "signature", "hashes")
    both = pairs.join(side.toDF("b", "sig_b", "set_b"), "b").join(side.toDF("a", "sig_a", "set_a"), "a")
    return store.materialize(both.select("a", "b", "sig_a", "sig_b", "set_a", "set_b").mapInPandas(_confirm, "a long, b long"), "links")


def _may_link(n_a: str, shared_a: str, n_b: str, shared_b: str) -> F.Column:
    """Whether the largest possible intersection is large enough for the sets' sizes."""
    return F.least(shared_a, shared_b, n_a, n_b) * (100 + SIMILARITY) >= (F.col(n_a) + F.col(n_b)) * SIMILARITY


def _differ_little(n_a: str, parity_a: str, n_b: str, parity_b: str) -> F.Column:
    """Whether the parities differ in no more bits than linked sets have shingles apart."""
    apart = sum((F.bit_count(F.col(parity_a)[k].bitwiseXOR(F.col(parity_b)[k])) for k in range(PARITY)), F.lit(0))
    return apart * (100 + SIMILARITY) <= (F.col(n_a) + F.col(n_b)) * (100 - SIMILARITY)


def link_components(reps: DataFrame, docs: DataFrame) -> DataFrame | None:
    """(node, root) of the representatives that are linked with another; None if there are none."""
    posts = prefix_posts(reps)
    candidates = candidate_sets(posts, reps, docs)
    prefixes = posts.groupBy("rep").agg(F.collect_list("pair").alias("prefix"))  # at most COORDINATES
    prefixes = store.materialize(prefixes.join(candidates.select("rep", "parity"), "rep"), "prefix")
    posts = posts.join(candidates.select("rep", "n", "shared"), "rep")
    old: list[DataFrame] = []
    labels, links, number = None, None, 0
    while True:
        named = posts.withColumn("root", F.col("rep")) if labels is None else posts.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
        named = store.materialize(named, "named")
        for t in old:
            store.drop(t)
        # A document that is too poor in shared shingles for the smallest set of the list leaves it.
        least = named.groupBy("pair").agg(F.min("n").alias("least"))
        able = store.materialize(named.join(least, "pair").where(F.least("shared", "n") * (100 + SIMILARITY) >= (F.col("n") + F.col("least")) * SIMILARITY).drop("least"), "able")
        # The list's main component is that of the document with the largest share of shared shingles.
        central = F.struct((F.col("shared") / F.col("n")).alias("share"), (-F.col("rep")).alias("order"), "rep", "root")
        lists = able.groupBy("pair").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(central).alias("main"), F.ceil(F.count("*") / PART).cast("int").alias("parts")).where("low <> high").select("pair", "main", "parts")
        live = store.materialize(able.join(lists, "pair"), "live")
        store.drop(able)
        if live.isEmpty():
            return labels
        if number == 0:
            chosen = live.where("rep = main.rep")
        else:
            order = Window.partitionBy("pair").orderBy(F.desc(F.col("shared") / F.col("n")), "rep")
            chosen = (live if number == 1 else live.where("root <> main.root")).withColumn("place", F.row_number().over(order))
            chosen = chosen.where(F.col("place") <= (CENTRAL if number == 1 else OUTSIDE))
        chosen = store.materialize(chosen.select("pair", "rep", "root", "n", "shared", "parts").toDF("pair", "centre", "centre_root", "centre_n", "centre_shared", "parts"), "centres")
        # Two documents meet in the first of the lists that both have, not in each.
        left = live.drop("main").join(prefixes, "rep").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int")).drop("parts")
        right = chosen.join(prefixes.toDF("centre", "centre_prefix", "centre_parity"), "centre").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        first = F.array_min(F.array_intersect("prefix", "centre_prefix")) == left["pair"]
        met = (left["pair"] == right["pair"]) & (left["part"] == right["part"]) & (F.col("root") != F.col("centre_root")) & _may_link("n", "shared", "centre_n", "centre_shared") & _differ_little("n", "parity", "centre_n", "centre_parity") & first
        pairs = left.join(right, met).select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b")).distinct()
        pairs = store.materialize(pairs, "pairs")
        found = confirmed(pairs, candidates)
        old = [named, live, chosen, pairs]
        links = found if links is None else links.unionByName(found)
        labels = connected_components(links)
        posts = live.select("pair", "rep", "n", "shared").join(chosen.select("pair", F.col("centre").alias("rep")), ["pair", "rep"], "left_anti")
        number += 1


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id, kept."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    signed = store.materialize(docs.mapInPandas(_sign, SIGNED), "signed")
    linkable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    reps = store.materialize(linkable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")), "reps")
    labels = link_components(reps, docs)
    roots = reps.select("set_key", "rep")
    if labels is not None:
        roots = roots.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("root", "rep").alias("rep"))
    found = signed.select("doc_id", "n_shingles", "set_key").join(roots, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("rep", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(store.table(spark, sf_dir, "documents"))
