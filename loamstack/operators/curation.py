"""Quality scores, contamination and normalisation of documents.

The formulas are this library's: length is 1 inside the range with linear ramps outside,
diversity the mean of type-token and distinct-bigram ratios, perplexity that of a unigram
model of the corpus, contamination the share of a text's distinct n-grams that a benchmark has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import unit_interval
from ..functions.probing import strip
from ..functions.scores import word_list
from ..rounds import drop, kept

#: N-grams of a benchmark that are sent to all tasks.
MOST_HASHES = 1 << 20
#: Words of a corpus's model that are sent to all tasks.
MOST_WORDS = 1 << 18
#: Characters of the texts that are hashed at once.
BITE = 1 << 22
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
_HASHES = (("loam-n-grams-one", np.uint64(0x9E3779B97F4A7C15)), ("loam-n-grams-two", np.uint64(0xC2B2AE3D27D4EB4F)))


def length_score(text: Column, low: int = 50, high: int = 1000) -> Column:
    n = F.length(text)
    return F.when(n < low, n / low).when(n > high, F.lit(high) / n).otherwise(F.lit(1.0))


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words.  The words are bound to a lambda variable, so that they are split once and not for each run."""
    runs = lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(words), runs)[0]


def diversity_score(text: Column) -> Column:
    """Mean of the shares of distinct words and of distinct pairs of neighbours; the words are split once."""

    def score(words: Column) -> Column:
        n = F.size(words)
        pairs = F.transform(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
        types = F.size(F.array_distinct(words)) / F.nullif(n, F.lit(0))
        bigrams = F.size(F.array_distinct(pairs)) / F.nullif(n - 1, F.lit(0))
        return F.when(n == 0, 0.0).when(n == 1, 1.0).otherwise((types + bigrams) / 2)

    return F.transform(F.array(word_list(F.lower(text))), score)[0]


def unigram_perplexity(docs: DataFrame, key: str, text: str, most_words: int = MOST_WORDS) -> DataFrame:
    """(key, perplexity) under the corpus's own word frequencies.

    The most frequent words, as many as ``most_words`` at most, are sent to all tasks, where a document's words
    add up to one row before anything is shuffled.  Only the rarer words of documents go to a join by the word.
    """
    words = docs.select(key, F.explode(word_list(F.lower(F.col(text)))).alias("w"))
    model = kept(words.groupBy("w").agg(F.count("*").alias("total")), "model")
    sums = model.agg(F.sum("total").alias("all"), F.count("*").alias("n")).first()  # one row
    logs = model.select("w", "total", F.log(F.col("total") / F.lit(sums["all"])).alias("logp"))
    summed = lambda df: df.groupBy(key).agg(F.sum("logp").alias("logp"), F.count("*").alias("n"))
    if sums["n"] <= most_words:
        rows = summed(words.join(F.broadcast(logs.select("w", "logp")), "w"))
    else:
        steps = model.groupBy("total").agg(F.count("*").alias("n")).orderBy(F.desc("total"))  # at most sqrt(2 x words) counts
        least, held = None, 0
        for total, n in steps.toLocalIterator():
            held += n
            if held > most_words:
                break
            least = total
        common = F.col("total") >= least if least is not None else F.lit(False)
        sent = F.broadcast(logs.where(common).select("w", "logp"))
        near = summed(words.join(sent, "w"))
        rare = words.join(sent.select("w"), "w", "left_anti").groupBy(key, "w").agg(F.count("*").alias("n"))
        rare = rare.join(logs.where(~common).select("w", "logp"), "w").select(key, (F.col("n") * F.col("logp")).alias("logp"), "n")
        rows = near.unionByName(rare)
    return rows.groupBy(key).agg(F.exp(-F.sum("logp") / F.sum("n")).alias("perplexity"))


def composite(scores: dict[str, float]) -> Column:
    """Weighted mean of score columns."""
    return sum((w * F.col(c) for c, w in scores.items()), F.lit(0.0)) / sum(scores.values())


def ngram_hashes(words: Column, n: int) -> Column:
    """Distinct 64-bit hashes of the runs of n words, made of the words' hashes without writing the runs out."""
    hashed = lambda w: F.when(F.size(w) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(F.slice(w, i, n))))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), hashed)[0]


def gram_hashes(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, second hash) of the distinct runs of n words of each text, all texts of a batch at once.

    Words are hashed once each; a run's hash is a polynomial of its words' hashes, modulo 2^64, then mixed.
    """
    split = [[w for w in _SPACE.split(t) if w] for t in texts]
    of = np.repeat(np.arange(len(split)), [len(w) for w in split])
    size = len(of) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    codes, words = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))
    inside = of[:size] == of[n - 1 :]
    hashes = []
    for key, factor in _HASHES:
        h, run = pd.util.hash_array(words, hash_key=key, categorize=False)[codes], np.zeros(size, np.uint64)
        for i in range(n):
            run = run * factor + h[i : size + i]
        run ^= run >> np.uint64(29)
        hashes.append((run * factor)[inside])
    text, first, second = of[:size][inside], *hashes
    order = np.lexsort((first, text))
    text, first, second = text[order], first[order], second[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (first[1:] != first[:-1])
    return text[new], first[new], second[new]


def _bites(texts: pd.Series) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of at most ``BITE`` characters, or one text, each with the place of its first."""
    begin, chars, bite = 0, 0, []
    for k, t in enumerate(texts):
        t = t or ""
        if bite and chars + len(t) > BITE:
            yield begin, bite
            begin, chars, bite = k, 0, []
        bite.append(t)
        chars += len(t)
    if bite:
        yield begin, bite


def ngram_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", n: int = 13, threshold: float = 0.3, most_hashes: int = MOST_HASHES, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, matched, total, ratio, contaminated), and the columns to keep, over distinct n-grams of white-space words.

    A benchmark of at most ``most_hashes`` n-grams is sent to all tasks as two hashes of each (16 MB at most),
    and one narrow pass over the documents counts them: every row is judged by itself, without id or with
    a repeated one too.  A larger one is joined (``_joined_contamination``).  A null text has no n-grams.
    """
    low = lambda df: df.select(F.lower("text").alias("text"))

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for _, bite in _bites(part["text"]):
                _, first, second = gram_hashes(bite, n)
                yield pd.DataFrame({"first": first.view(np.int64), "second": second.view(np.int64)}).drop_duplicates()

    bench = kept(low(benchmark).mapInPandas(hashed, "first long, second long").distinct(), "benchmark")
    if bench.limit(most_hashes + 1).count() > most_hashes:
        drop(bench)
        rows = _joined_contamination(docs, benchmark, key, n)
        if keep:
            rows = docs.select(key, *keep).join(rows.dropDuplicates([key]), key, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total", "matched")})
    else:
        table = bench.toPandas()  # most_hashes rows
        drop(bench)
        pairs = np.unique(np.ascontiguousarray(table.to_numpy(np.int64)).reshape(-1, 2).view([("a", np.int64), ("b", np.int64)]).ravel())
        sent = docs.sparkSession.sparkContext.broadcast((np.unique(pairs["a"]), pairs))

        @F.pandas_udf("matched long, total int")
        def count(texts: pd.Series) -> pd.DataFrame:
            firsts, both = sent.value
            matched, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int32)
            for begin, bite in _bites(texts):
                text, first, second = gram_hashes(bite, n)
                total[begin : begin + len(bite)] = np.bincount(text, minlength=len(bite))
                seen = np.isin(first.view(np.int64), firsts)
                found = np.empty(int(seen.sum()), both.dtype)
                found["a"], found["b"] = first.view(np.int64)[seen], second.view(np.int64)[seen]
                matched[begin : begin + len(bite)] = np.bincount(text[seen][np.isin(found, both)], minlength=len(bite))
            return pd.DataFrame({"matched": matched, "total": total})

        rows = docs.select(key, *keep, count(F.lower("text")).alias("_c")).select(key, *keep, F.col("_c.total").alias("total"), F.col("_c.matched").alias("matched"))
    rows = rows.withColumn("ratio", F.when(F.col("total") > 0, F.col("matched") / F.col("total")).otherwise(0.0))
    return rows.withColumn("contaminated", F.col("ratio") >= threshold)


def _joined_contamination(docs: DataFrame, benchmark: DataFrame, key: str, n: int) -> DataFrame:
    """(key, total, matched) by joins: hashes of all n-grams are held against those of the benchmark, and the n-grams
    themselves are written out, shuffled and compared only for documents with a hash in common."""
    words = word_list(F.lower(F.col("text")))
    grams = lambda df, *c: df.select(*c, F.explode(F.array_distinct(ngrams(words, n))).alias("g"))
    bench = grams(benchmark).distinct().withColumn("h", F.xxhash64(F.transform(F.split("g", " "), lambda w: F.xxhash64(w))))
    own = docs.select(key, ngram_hashes(words, n).alias("hashes"))
    heard = own.select(key, F.explode("hashes").alias("h")).join(bench.select("h").distinct(), "h", "left_semi").select(key).distinct()
    hits = grams(docs.join(heard, key, "left_semi"), key).join(bench, "g", "left_semi").groupBy(key).agg(F.count("*").alias("matched"))
    return own.select(key, F.size("hashes").alias("total")).join(hits, key, "left").withColumn("matched", F.coalesce("matched", F.lit(0)))


def normalised_text(text: Column, urls: str | None = "<URL>", emails: str | None = "<EMAIL>") -> Column:
    out = text
    if urls is not None:
        out = F.regexp_replace(out, r"https?://[^\s<>\"]+", urls)
    if emails is not None:
        out = F.regexp_replace(out, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", emails)
    return strip(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def normalised_code(code: Column) -> Column:
    """Without comments, trailing blanks and runs of empty lines."""
    out = F.regexp_replace(code, r"(?s)/\*.*?\*/", "")
    out = F.regexp_replace(out, r"(?m)(^|\s)(?:#|//).*$", "$1")
    return strip(F.regexp_replace(F.regexp_replace(out, r"(?m)[ \t]+$", ""), r"\n{3,}", "\n\n"))


def conversation_messages(turns: DataFrame) -> DataFrame:
    """(conv_id, messages, turns): the ordered messages of each conversation."""
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"), F.size("t").alias("turns"))


def preprocessed(docs: DataFrame, benchmark: DataFrame, min_quality: float = 0.6) -> DataFrame:
    """Documents with the first gate that they fail as ``reject_reason``: quality, contamination, duplicate.

    Texts are normalised, scored and held against the benchmark in one narrow pass; for the last gate
    they are told apart by their hashes, and of the text only what is asked for afterwards is shuffled.
    """
    from pyspark.sql import Window

    rows = docs.withColumn("text", normalised_text(F.col("text")))
    rows = rows.withColumns({"length_score": length_score(F.col("text")), "diversity": diversity_score(F.col("text")), "_hash": F.sha2("text", 256)})
    rows = ngram_contamination(rows, benchmark, keep=tuple(c for c in rows.columns if c != "doc_id")).drop("matched", "total", "ratio")
    rows = rows.withColumn("quality", composite({"length_score": 0.5, "diversity": 0.5}))
    rows = rows.withColumn("reject_reason", F.when(F.col("quality") < min_quality, "low_quality").when(F.col("contaminated") & F.col("doc_id").isNotNull(), "contaminated"))
    # rejected rows take no part in the last gate: each goes where its id sends it
    passed = F.col("reject_reason").isNull()
    rows = rows.withColumn("_gate", F.when(passed, F.col("_hash"))).withColumn("_spread", F.when(~passed, F.xxhash64("doc_id", "_hash")))
    n = F.row_number().over(Window.partitionBy("_gate", "_spread").orderBy("doc_id"))
    out = rows.withColumn("_n", n).withColumn("reject_reason", F.when(passed & (F.col("_n") > 1), "duplicate").otherwise(F.col("reject_reason")))
    return out.select(*docs.columns, "length_score", "diversity", "quality", "reject_reason")


def preprocessing_statistics(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total"), F.count_if(F.col("reject_reason").isNull()).alias("kept"), F.count_if(F.col("reject_reason") == "duplicate").alias("duplicates"), F.round(F.avg("quality"), 6).alias("mean_quality"))


def perturbed(docs: DataFrame, key: str, text: str, copies: int = 1, rate: float = 0.05, seed: int = 0) -> DataFrame:
    """Copies in which a hash of the key, copy and place turns a share of the letters into ``*``."""
    rows = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    letters = F.split(F.col(text), "")
    noisy = F.transform(letters, lambda c, i: F.when(c.rlike("[A-Za-z]") & (unit_interval(F.col(key), F.col("copy"), i, seed=seed) < rate), "*").otherwise(c))
    return rows.withColumn(text, F.array_join(noisy, ""))


def mixture(parts: dict[str, DataFrame], weights: dict[str, float], size: int, key: str, seed: int = 0) -> DataFrame:
    """Rows of each part in proportion to its weight, by hash order."""
    total, out = sum(weights.values()), None
    for name, df in parts.items():
        n = int(size * weights[name] / total)
        one = df.orderBy(unit_interval(F.col(key), seed=seed), key).limit(n).withColumn("part", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def entropy(probabilities: Column) -> Column:
    return F.aggregate(probabilities, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log(p)).otherwise(0.0))


def margin(probabilities: Column) -> Column:
    """One minus the lead of the likeliest class."""
    s = F.sort_array(probabilities, False)
    return 1 - (F.element_at(s, 1) - F.coalesce(F.try_element_at(s, F.lit(2)), F.lit(0.0)))


def least_confidence(probabilities: Column) -> Column:
    return 1 - F.array_max(probabilities)


def vote_entropy(votes: Column) -> Column:
    n = F.size(votes)
    return entropy(F.transform(F.array_distinct(votes), lambda v: F.size(F.filter(votes, lambda x: x == v)) / n))
