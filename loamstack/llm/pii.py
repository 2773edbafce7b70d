"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Emails, addresses, card numbers and phone numbers are matched by fixed patterns.  These
and secrets (quoted hexadecimal keys that something is set to) are the seed entities.
Every token that looks like an identifier (it has a digit or an at sign), and every run of up
to ``RUN`` of them, is a mention with lexical patterns at several levels: its shape (runs of
digits by length, letters, hexadecimal keys), the word before it with the signs between, the
signs around it, and its shape with each of the latter or with its first and last
characters.  Mentions make a graph of patterns and instances.  In each of ``ROUNDS`` rounds
in Spark a pattern scores, for each kind, the lower confidence bound of the share of its
distinct instances that are of the kind; patterns of a high score and enough seeds are trusted,
and the unseen instances that they hold count for what the pattern scores in the next round, so
that they induce patterns of their own.  The unseen mentions of trusted patterns are added.

Offsets are code points, ends exclusive.  Defined results: a null or empty text has no
spans; repeated rows have their own spans; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom, memory, store

KINDS = ("email", "ip", "card", "phone")
#: Kind of the seeds that no fixed pattern of the contract has, and of the spans that contexts add.
SECRET, ADDED = "secret", "context"
ROUNDS = 3
#: Distinct seeds that a pattern needs, the score from which it is trusted, and the standard errors of its lower bound.
MIN_SEEDS = 5
TRUSTED = 0.8
ERRORS = 2.0
#: Tokens of a mention at most.
RUN = 3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits begins, as one that fails there fails in all of the run.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, at, last = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, last := found.end()))
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        if text.count(".") >= 3:
            for m in _IP.finditer(text):
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
                    out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if len(m[0]) >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


_SECRET = re.compile(r"""[=:]\s{0,4}(["'])([0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})\1""")
_KEY = re.compile(r"(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{16,}", re.IGNORECASE)
_RUNS = re.compile(r"([0-9]+)|([^\W\d_]+)|(\s+)")
_WORDS = re.compile(r"\w+")


def secrets(text: str) -> list[tuple[str, int, int]]:
    """Seeds of the kind ``SECRET``."""
    if '"' not in text and "'" not in text:
        return []
    return [(SECRET, *m.span(2)) for m in _SECRET.finditer(text) if not m[2].isdigit() and not m[2].isalpha()]


def shape(text: str) -> str:
    """Digits by the length of their run, letters and white space without it, other signs as they are."""
    if _KEY.fullmatch(text):
        return f"key{len(text)}"
    return _RUNS.sub(lambda m: f"9{len(m[1])}" if m[1] else "a" if m[2] else " ", text)


def _short(pattern: str) -> str:
    """Long patterns by their hash."""
    return pattern if len(pattern) <= 64 else pattern[:1] + xxhash.xxh3_128_hexdigest(pattern.encode("utf-8", "surrogatepass"))


def mention(text: str, start: int, end: int, words: list[tuple[int, int]]) -> tuple[str, list[str]]:
    """(instance, patterns); words: places of all words of the text."""
    token = text[start:end]
    k = bisect_right(words, (start, start)) - 1
    while k >= 0 and words[k][1] > start:
        k -= 1
    before = re.sub(r"\d+", "0", text[slice(*words[k])].lower()) if k >= 0 else ""
    between = _RUNS.sub(" ", text[words[k][1] if k >= 0 else 0 : start])
    left, right = text[start - 1 : start], text[end : end + 1]
    around = f"{'' if left.isspace() else left}|{'' if right.isspace() else right}"
    form, instance = shape(token), xxhash.xxh3_128_hexdigest(token.lower().encode("utf-8", "surrogatepass"))
    patterns = [f"s {form}", f"S {form} {before}{between}", f"A {form} {around}", f"E {form} {token[:2].lower()} {token[-2:].lower()}"]
    # No word before and no sign around tell nothing by themselves.
    patterns += [f"b {before}{between}"] * (k >= 0) + [f"a {around}"] * (around != "|")
    return instance, [_short(p) for p in patterns]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Identifier-like tokens, and runs of them, that no span of ``taken`` touches."""
    out, at, spans = [], 0, sorted((a, b) for _, a, b in taken)
    k, run = 0, []
    while found := _MARK.search(text, at):
        start = found.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        stop = _SPACE.search(text, found.end())
        end = stop.start() if stop else len(text)
        if not run or text[run[-1][1] : start] != " ":
            run = []
        at = end
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if k < len(spans) and spans[k][0] < end:
            run = []
            continue
        run = [*run[1 - RUN :], (start, end)] if RUN > 1 else [(start, end)]
        for first, _ in run:
            a, b = first, end
            while a < b and not (text[a].isalnum() or text[a] == "+"):
                a += 1
            while b > a and not text[b - 1].isalnum():
                b -= 1
            if b - a >= 4 and (a, b) not in out[-RUN:]:
                out.append((a, b))
    return out


SPAN = "struct<kind:string,start:int,end:int>"
FOUND = f"row long, doc_id long, base array<{SPAN}>, secrets array<{SPAN}>, mentions array<struct<start:int,end:int,kind:string,instance:string,patterns:array<string>>>"


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memory.begin("pii")
    row = TaskContext.get().partitionId() << 36
    for rows in batches:
        out = []
        for key, text in zip(rows["doc_id"].astype("object").where(rows["doc_id"].notna(), None), rows["text"]):
            base, found, mentions = [], [], []
            if isinstance(text, str) and _MARK.search(text):
                base = base_spans(text)
                touched = sorted((a, b) for _, a, b in base)
                found = [s for s in secrets(text) if not any(a < s[2] and s[1] < b for a, b in touched)]
                places = [*base, *found, *((None, *c) for c in candidates(text, [*base, *found]))]
                words = [m.span() for m in _WORDS.finditer(text)] if places else []
                mentions = [{"start": a, "end": b, "kind": kind, **dict(zip(("instance", "patterns"), mention(text, a, b, words)))} for kind, a, b in places]
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in some] for some in (base, found)]
            out.append((row, key, *spans, mentions))
            row += 1
        yield pd.DataFrame(out, columns=["row", "doc_id", "base", "secrets", "mentions"]).astype({"doc_id": "Int64"})


def find_base(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, mentions), in the shared folder."""
    return store.materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(_find, FOUND), "found")


def lower_bound(hits: F.Column, n: F.Column) -> F.Column:
    """Wilson's lower bound of a share."""
    z, p = F.lit(ERRORS), hits / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def trusted_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, score, seeds, instances) of the patterns that are trusted after ``rounds`` rounds over the graph."""
    m = found.select(F.explode("mentions").alias("m")).select("m.*")
    edges = m.select("instance", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    edges = store.materialize(edges, "graph")
    seeded = edges.where("kind IS NOT NULL").select("pattern", "instance", "kind", F.lit(1.0).alias("belief"))
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("instances"))
    trusted = None
    for _ in range(rounds):
        held = seeded
        if trusted is not None:
            # An unseen instance counts for what the best trusted pattern that holds it scores.
            unseen = edges.where("kind IS NULL").select("pattern", "instance")
            heard = unseen.join(trusted.select("pattern", "kind", "score"), "pattern").groupBy("instance", "kind").agg(F.max("score").alias("belief"))
            held = seeded.unionByName(unseen.join(heard, "instance"))
        scores = held.groupBy("pattern", "kind").agg(F.sum("belief").alias("hits"), F.count_if(F.col("belief") == 1).alias("seeds")).join(sizes, "pattern")
        scores = scores.withColumn("score", lower_bound(F.col("hits"), F.col("instances"))).where((F.col("seeds") >= MIN_SEEDS) & (F.col("score") >= TRUSTED))
        trusted = store.materialize(scores.select("pattern", "kind", "score", "seeds", "instances"), "patterns")
    return trusted


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row, doc_id, base, added): spans of each row of ``docs``; secrets are among the added ones."""
    found = find_base(docs)
    trusted = trusted_patterns(found, rounds).select("pattern").distinct()
    unseen = found.select("row", F.explode("mentions").alias("m")).where("m.kind IS NULL").select("row", "m.start", "m.end", F.explode("m.patterns").alias("pattern"))
    added = unseen.join(trusted, "pattern").groupBy("row").agg(F.collect_set(F.struct(F.lit(ADDED).alias("kind"), "start", "end")).alias("added"))
    none = F.array().cast(f"array<{SPAN}>")
    return found.select("row", "doc_id", "base", "secrets").join(added, "row", "left").select("row", "doc_id", "base", F.array_sort(F.concat(F.coalesce("added", none), "secrets")).alias("added"))


def spans_text(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; rows and columns stay.

    Rows are numbered by their place, so ``docs`` must be read from stored files.
    """
    row, spans_of = store.unused(docs, "_loam_row"), store.unused(docs, "_loam_spans")
    keyed = docs.withColumn(row, F.monotonically_increasing_id())
    found = personal_data(keyed.select(F.col(row).alias("doc_id"), "text"))
    spans = found.select(F.col("doc_id").alias(row), F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias(spans_of)).where(F.size(spans_of) > 0)
    # A span that begins inside the one before it adds nothing but its tail.
    masked = F.expr(
        f"aggregate({spans_of}, named_struct('at', 0, 'out', ''), (s, x) -> named_struct("
        "'at', greatest(s.at, x.end),"
        "'out', CASE WHEN x.start < s.at THEN s.out ELSE concat(s.out, substr(text, s.at + 1, x.start - s.at), '[', upper(x.kind), ']') END),"
        "s -> concat(s.out, substr(text, s.at + 1)))"
    )
    text = F.when(F.col(spans_of).isNull(), F.col("text")).otherwise(masked)
    # Rows without spans, which are most, are not shuffled.
    spans = store.materialize(spans, "spans")
    may, rest = bloom.apart(keyed, row, spans.select(row))
    masked_rows = may.join(spans, row, "left").select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
    return rest.select(*docs.columns).unionByName(masked_rows)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(store.table(spark, sf_dir, "documents"))
    n = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *n, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_context"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
