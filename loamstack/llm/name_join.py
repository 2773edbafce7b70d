"""Names of two tables that are at most one edit apart, by walking the tries of both sides together.

Each side's distinct names form a trie.  It is cut at a depth: the names below a node, a
subtree, become one minimal acyclic word automaton.  A pair of subtrees (one of each side) is
made only if the edit automaton is still alive after their prefixes, and each pair is a
row of its own, so pairs are spread over all tasks.  The two automata of a pair are walked together
under the edit automaton (insertion, deletion, substitution, exchange of two neighbours), so
prefixes that names share are walked once on either side.

Which prefixes keep it alive is found without holding all against all: two prefixes that one edit
may join have a form in common with one character left out, which is an equality join.  Subtrees
with more than ``NAMES`` names, and forms that more than ``PAIRS`` pairs of prefixes share, are cut again at twice
the depth; at the length of the longest name a subtree is one name and pairs are results.

Where at most one edit is allowed the unrestricted distance of Damerau and Levenshtein and the
restricted one agree: editing a substring again takes two edits at least.

Defined results: null names and those empty in their compared form take no part; a row without
id takes part (its null id adds nothing to a least id or a checksum); repeated client rows count
as often as they stand there; a vendor's rows with one form are one, with several forms each
adds its clients; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import marshal
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType

from . import store

#: Depth of the first cut.
DEPTH = 6
#: Names of one side that a subtree may have, and pairs of prefixes with one form in common, before it is cut again.
NAMES = 1024
PAIRS = 4096
#: What is left out of a name.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def compared(name: Column) -> Column:
    """A-Z in lower case and without blanks."""
    return F.translate(name, UPPER + BLANKS, LOWER)


def misspelt(name: Column, key: Column) -> Column:
    """The name as a careless writer has it: for an even checksum h of the key two neighbours exchanged at h mod (length - 1)."""
    h, size = F.crc32(key.cast("string").cast("binary")), F.length(name)
    at = F.pmod(h, F.greatest(size - 1, F.lit(1))).cast("int")
    exchanged = F.concat(F.substring(name, F.lit(1), at), F.substring(name, at + 2, F.lit(1)), F.substring(name, at + 1, F.lit(1)), F.substring(name, at + 3, size))
    return F.when((F.pmod(h, F.lit(2)) == 0) & (size >= 2), exchanged).otherwise(name)


# ---------------------------------------------------------------- automata


def automaton(words: list[str]) -> tuple[list[dict[str, int]], list[bool], int]:
    """(edges, final, root) of the minimal acyclic automaton of sorted distinct words.

    Words come in order, so what lies below the last word's path and off the next word's is
    complete and is replaced by an equal state where there is one.
    """
    edges: list[dict[str, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, str, int]] = []  # (parent, character, child) of the last word

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, char, child = path.pop()
            edges[parent][char] = known.setdefault((final[child], tuple(edges[child].items())), child)

    last = ""
    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        settle(same)
        at = path[-1][2] if path else 0
        for char in word[same:]:
            edges.append({})
            final.append(False)
            edges[at][char] = len(edges) - 1
            path.append((at, char, len(edges) - 1))
            at = len(edges) - 1
        final[at] = True
        last = word
    settle(0)
    return edges, final, 0


def _word(path: tuple | None) -> str:
    out = []
    while path is not None:
        path, char = path
        out.append(char)
    return "".join(reversed(out))


def walk(left: tuple, right: tuple, most: int = 1) -> dict[tuple[str, str], int]:
    """{(word of left, word of right): distance} of the pairs at most ``most`` (0 or 1) edits apart."""
    (le, lf, lroot), (re, rf, rroot) = left, right
    found: dict[tuple[str, str], int] = {}
    todo = [(lroot, rroot, 0, None, None)]
    while todo:
        a, b, used, pa, pb = todo.pop()
        if lf[a] and rf[b]:
            pair = (_word(pa), _word(pb))
            if found.get(pair, used) >= used:
                found[pair] = used
        ea, eb = le[a], re[b]
        for char, x in ea.items() if len(ea) <= len(eb) else ((c, ea[c]) for c in eb if c in ea):
            if char in eb:
                todo.append((x, eb[char], used, (pa, char), (pb, char)))
        if used >= most:
            continue
        for c, x in ea.items():
            todo.append((x, b, 1, (pa, c), pb))
            for d, y in eb.items():
                if c != d:
                    todo.append((x, y, 1, (pa, c), (pb, d)))
                    if d in le[x] and c in re[y]:
                        todo.append((le[x][d], re[y][c], 1, ((pa, c), d), ((pb, d), c)))
        for d, y in eb.items():
            todo.append((a, y, 1, pa, (pb, d)))
    return found


def alive(p: str, q: str) -> bool:
    """Whether names with these prefixes of equal length may be at most one edit apart."""
    i = next((k for k in range(len(p)) if p[k] != q[k]), None)
    if i is None:
        return True
    exchanged = p[i + 1 : i + 2] in ("", q[i]) and q[i + 1 : i + 2] in ("", p[i]) and p[i + 2 :] == q[i + 2 :]
    return p[i + 1 :] == q[i + 1 :] or p[i + 1 :] == q[i:-1] or p[i:-1] == q[i + 1 :] or exchanged


@F.pandas_udf(BooleanType())
def _alive(p: pd.Series, q: pd.Series) -> pd.Series:
    return pd.Series([alive(x, y) for x, y in zip(p, q)], dtype=bool)


@F.pandas_udf(BinaryType())
def _automaton(names: pd.Series) -> pd.Series:
    return pd.Series([marshal.dumps(automaton(sorted(words))) for words in names])


def _walked(most: int):
    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for a, b in zip(rows["left"], rows["right"]):
                out.extend((u, v, d) for (u, v), d in walk(marshal.loads(a), marshal.loads(b), most).items())
            yield pd.DataFrame(out, columns=["a", "b", "distance"])

    return pairs


# ---------------------------------------------------------------- the join


def _cut(names: DataFrame, depth: int) -> DataFrame:
    """(name, prefix): names shorter than the depth are filled up, so that all prefixes are of one length."""
    return names.select("name", F.rpad("name", depth, "\0").alias("prefix"))


def _forms(cut: DataFrame, depth: int, prefix: str) -> DataFrame:
    """(prefix, form) with one character left out; as many rows as characters at most."""
    nodes = cut.select("prefix").distinct()
    left_out = F.transform(F.sequence(F.lit(1), F.lit(depth)), lambda i: F.concat(F.substring(F.col("prefix"), F.lit(1), i - 1), F.substring(F.col("prefix"), i + 1, F.lit(depth))))
    return nodes.select(F.col("prefix").alias(prefix), F.explode(F.array_distinct(left_out)).alias("form"))


def _automata(cut: DataFrame, wanted: DataFrame, side: str) -> DataFrame:
    """(prefix, automaton) of the wanted subtrees, none of which has more than ``NAMES`` names but at the last cut."""
    names = cut.join(wanted.hint("merge"), "prefix", "left_semi").groupBy("prefix").agg(F.collect_list("name").alias("names"))
    return names.select(F.col("prefix").alias(f"{side}_prefix"), _automaton("names").alias(side))


def similar_names(left: DataFrame, right: DataFrame, most: int = 1, depth: int = DEPTH) -> DataFrame:
    """(a, b, distance) of all pairs of distinct names (column ``name`` of both) at most ``most`` edits apart."""
    if most not in (0, 1):
        raise ValueError("at most one edit: beyond it the edit automaton would need more states")
    left, right = (store.materialize(x.select("name").where("name <> ''").distinct(), "names") for x in (left, right))
    longest = left.unionByName(right).agg(F.max(F.length("name"))).first()[0] or 0
    out = None
    while True:
        lcut, rcut = _cut(left, depth), _cut(right, depth)
        forms = [_forms(lcut, depth, "p"), _forms(rcut, depth, "q")]
        last = depth >= longest
        sizes = [cut.groupBy("prefix").count() for cut in (lcut, rcut)]
        shared = forms[0].groupBy("form").agg(F.count("*").alias("np")).join(forms[1].groupBy("form").agg(F.count("*").alias("nq")).hint("merge"), "form")
        shared = store.materialize(shared.withColumn("crowded", F.lit(not last) & (F.col("np") * F.col("nq") > PAIRS)).select("form", "crowded"), "forms")
        few, many = shared.where("NOT crowded").select("form"), shared.where("crowded").select("form")
        pairs = forms[0].join(few.hint("merge"), "form").join(forms[1].hint("merge"), "form").select("p", "q").distinct().where(_alive("p", "q"))
        pairs = pairs.join(sizes[0].select(F.col("prefix").alias("p"), F.col("count").alias("np")).hint("merge"), "p").join(sizes[1].select(F.col("prefix").alias("q"), F.col("count").alias("nq")).hint("merge"), "q")
        pairs = store.materialize(pairs.withColumn("large", F.lit(not last) & (F.greatest("np", "nq") > NAMES)).select("p", "q", "large"), "pairs")
        ready = pairs.where("NOT large")
        la = _automata(lcut, ready.select(F.col("p").alias("prefix")).distinct(), "left")
        ra = _automata(rcut, ready.select(F.col("q").alias("prefix")).distinct(), "right")
        both = ready.join(la.hint("merge"), ready["p"] == la["left_prefix"]).join(ra.hint("merge"), ready["q"] == ra["right_prefix"])
        found = store.materialize(both.select("left", "right").mapInPandas(_walked(most), "a string, b string, distance int"), "found")
        out = found if out is None else out.unionByName(found)
        if last:
            break
        deeper = [
            pairs.where("large").select(F.col(side).alias("prefix")).union(form.join(many.hint("merge"), "form", "left_semi").select(F.col(side).alias("prefix"))).distinct()
            for side, form in zip("pq", forms)
        ]
        left, right = (store.materialize(cut.join(d.hint("merge"), "prefix", "left_semi").select("name"), "names") for cut, d in zip((lcut, rcut), deeper))
        if left.isEmpty() or right.isEmpty():
            break
        depth *= 2
    return out.groupBy("a", "b").agg(F.min("distance").alias("distance"))


def vendor_clients(clients: DataFrame, vendors: DataFrame, most: int = 1) -> DataFrame:
    """A row for each vendor and distance at which its misspelt name has clients: their number, least id and sum of id checksums."""
    crc = F.crc32(F.col("client_id").cast("string").cast("binary"))
    named = clients.select("client_id", compared(F.col("name")).alias("a")).where("a <> ''")
    named = store.materialize(named.groupBy("a").agg(F.count("*").alias("n"), F.min("client_id").alias("first"), F.sum(crc).alias("crc")), "clients")
    sold = vendors.select("vendor_id", compared(misspelt(F.col("name"), F.col("vendor_id"))).alias("b")).where("b <> ''").distinct()
    sold = store.materialize(sold, "vendors")
    pairs = similar_names(named.select(F.col("a").alias("name")), sold.select(F.col("b").alias("name")), most)
    met = pairs.join(named.hint("merge"), "a").join(sold.hint("merge"), "b")
    return met.groupBy(F.col("vendor_id").cast("long").alias("vendor_id"), "distance").agg(F.sum("n").alias("n_clients"), F.min("first").cast("long").alias("first_client_id"), F.sum("crc").alias("clients_crc"))


def op12_edit_distance_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendor_clients(store.table(spark, sf_dir, "clients"), store.table(spark, sf_dir, "vendors"))


_FORM = f"regexp_replace(translate({{}}, '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]', '', 'g')"
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}::VARCHAR) + 1), lambda k: ascii(({0}::VARCHAR)[k])::BIGINT)), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295)"
#: Checksums are written out, as DuckDB has none of this kind; names are held against each other position by position.
OP12_SQL = f"""
WITH bits AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0,0,0,0,0,0,0,0]::BIGINT[]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(0, 256))::BIGINT AS i))),
c AS MATERIALIZED (SELECT client_id, {_CRC.format("client_id")} AS crc, {_FORM.format("name")} AS a FROM clients, bits WHERE name IS NOT NULL),
h AS (SELECT vendor_id, name, {_CRC.format("vendor_id")} AS h, length(name) AS n FROM vendors, bits WHERE name IS NOT NULL),
w AS (SELECT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2 THEN substring(name, 1, (h % (n - 1))::BIGINT) || substring(name, (h % (n - 1) + 2)::BIGINT, 1) || substring(name, (h % (n - 1) + 1)::BIGINT, 1) || substring(name, (h % (n - 1) + 3)::BIGINT) ELSE name END AS name FROM h),
v AS MATERIALIZED (SELECT DISTINCT vendor_id, {_FORM.format("name")} AS b FROM w),
p AS MATERIALIZED (SELECT DISTINCT a, b, length(a) AS la, length(b) AS lb FROM (SELECT DISTINCT a FROM c WHERE a <> ''), (SELECT DISTINCT b FROM v WHERE b <> '') WHERE abs(length(a) - length(b)) <= 1),
m AS (
  SELECT *, CASE WHEN la = lb THEN list_filter(range(1, la + 1), lambda i: a[i] <> b[i]) END AS x,
    CASE WHEN la > lb THEN a WHEN la < lb THEN b END AS long, CASE WHEN la > lb THEN b WHEN la < lb THEN a END AS short FROM p),
d AS (
  SELECT a, b, CASE WHEN a = b THEN 0
    WHEN la = lb AND (len(x) = 1 OR len(x) = 2 AND x[2] = x[1] + 1 AND a[x[1]] = b[x[2]] AND a[x[2]] = b[x[1]]) THEN 1
    WHEN la <> lb AND len(list_filter(range(1, length(long) + 1), lambda i: substring(long, 1, i - 1) || substring(long, i + 1) = short)) > 0 THEN 1 END AS distance FROM m)
SELECT vendor_id, distance::INT AS distance, count(*)::BIGINT AS n_clients, min(client_id)::BIGINT AS first_client_id, sum(crc)::BIGINT AS clients_crc
FROM d JOIN c USING (a) JOIN v USING (b) WHERE distance IS NOT NULL GROUP BY vendor_id, distance
"""
