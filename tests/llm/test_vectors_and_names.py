"""Clusters, name joins and near vectors against plain loops, and their defined results for odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamstack.llm import clusters, name_join, pivots

VECTORS = "vec_id long, embedding array<double>, label int, cluster int, unit string"


# ---------------------------------------------------------------- clusters


def plain_clusters(vectors, k, rounds):
    """Python's integers throughout."""
    rows = [(i, [math.floor(c * 256) if abs(c) < 2**53 else int(c) * 256 for c in v], v) for i, v in vectors if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    hashed = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    centres = [list(r[1]) for r in hashed[:k]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        held = {}
        for _, q, _ in rows:
            held.setdefault(near(q)[1], []).append(q)
        centres = [[sum(col) // len(held[n]) for col in zip(*held[n])] if n in held else c for n, c in enumerate(centres)]
    found = [(i, *near(q)[::-1]) for i, q, _ in rows]
    whole = sum(d for _, _, d in found)
    fits = lambda v: v if v < 2**63 else None
    return sorted(((i, n, fits(d), fits(sum(e for _, m, e in found if m == n)), fits(whole), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for i, n, d in found), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("scale", [1.0, 2.0**30, 2.0**45, 1e60, 1e307])
def test_clusters_are_exact_at_every_magnitude(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(64) * (scale if i % 3 else 1)]) for i in range(90)]
    rows += [(None, rows[4][1]), (7, rows[7][1]), (200, None), (201, [1.0] * 63), (202, [math.nan] + [0.0] * 63), (203, [math.inf] + [0.0] * 63), (204, [None] + [0.0] * 63), (205, [])]
    table = spark.createDataFrame([(i, v, None, 1, "x") for i, v in rows], VECTORS).repartition(3)
    assert rows_of(clusters.clustered(table, 5, 3)) == plain_clusters(rows, 5, 3)


def test_ties_go_to_the_smaller_number_and_few_vectors_give_few_centroids(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(6)]
    table = spark.createDataFrame([(i, v, None, 1, "x") for i, v in rows], VECTORS)
    assert rows_of(clusters.clustered(table)) == plain_clusters(rows, 40, 5)
    assert clusters.clustered(table.limit(0)).count() == 0
    assert clusters.clustered(table.withColumn("embedding", F.lit(None).cast("array<double>"))).count() == 0


def test_wide_rows_leave_the_product_of_the_others_exact():
    q = np.array([[2**22] * 64, [3] * 64, [2**26] * 64], np.int64)
    c = np.array([[2**22 - 1] * 64, [2] * 64], np.int64)
    number, distance = clusters.nearest(q, c)
    assert [(int(n), int(d)) for n, d in zip(number, distance)] == [min(((int(sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)))), k) for k, y in enumerate(c))[::-1] for x in q]


# ---------------------------------------------------------------- names


def distance(a, b):
    """Damerau and Levenshtein without restriction."""
    far, last = len(a) + len(b), {}
    d = {(-1, -1): far}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = far, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = far, j
    for i in range(1, len(a) + 1):
        held = 0
        for j in range(1, len(b) + 1):
            k, n = last.get(b[j - 1], 0), held
            same = a[i - 1] == b[j - 1]
            held = j if same else held
            d[i, j] = min(d[i - 1, j - 1] + (not same), d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, n - 1] + (i - k - 1) + 1 + (j - n - 1))
        last[a[i - 1]] = i
    return d[len(a), len(b)]


def some_names(n, seed, letters="abcdé\U0001f600"):
    rnd = random.Random(seed)
    return sorted({"".join(rnd.choice(letters) for _ in range(rnd.choice((1, 2, 3, 5, 6, 7, 8)))) for _ in range(n)})


@pytest.mark.parametrize("sizes", [(1024, 4096), (3, 4096), (1024, 4), (2, 2)])
def test_names_against_all_pairs(spark, monkeypatch, sizes):
    monkeypatch.setattr(name_join, "NAMES", sizes[0])
    monkeypatch.setattr(name_join, "PAIRS", sizes[1])
    left, right = some_names(150, 1), some_names(150, 2)
    left, right = left + ["same long" * 3], right + ["same long" * 3]
    expected = {(a, b, distance(a, b)) for a in left for b in right if abs(len(a) - len(b)) < 2 and distance(a, b) <= 1}
    tables = [spark.createDataFrame([(x,) for x in names], "name string") for names in (left, right)]
    found = {tuple(r) for r in name_join.similar_names(*tables, depth=2).collect()}
    assert found == expected


def test_long_names(spark):
    tables = [spark.createDataFrame([(x,) for x in ("x" * n, "y" * 20000)], "name string") for n in (3000, 3001)]
    assert {tuple(r) for r in name_join.similar_names(*tables).collect()} == {("x" * 3000, "x" * 3001, 1), ("y" * 20000, "y" * 20000, 0)}


def test_equal_names_only(spark):
    tables = [spark.createDataFrame([(x,) for x in names], "name string") for names in (["abc", "abd", ""], ["abc", "acb", ""])]
    assert [tuple(r) for r in name_join.similar_names(*tables, most=0).collect()] == [("abc", "abc", 0)]
    with pytest.raises(ValueError):
        name_join.similar_names(*tables, most=2)


def test_prefixes_stay_alive_wherever_an_edit_is_left():
    names = some_names(120, 3, "ab")
    for depth in (1, 2, 4, 6):
        for a in names:
            for b in names:
                if distance(a, b) <= 1:
                    assert name_join.alive(a[:depth].ljust(depth, "\0"), b[:depth].ljust(depth, "\0"))


def test_automata_are_minimal_and_hold_the_words():
    words = sorted(x + y for x in ("", "ab", "b", "cab") for y in ("tion", "tions", "x"))
    edges, final, root = name_join.automaton(words)

    def below(state):
        return [""] * final[state] + [c + w for c, s in sorted(edges[state].items()) for w in below(s)]

    assert below(root) == words
    reached, todo = {root}, [root]
    while todo:
        new = set(edges[todo.pop()].values()) - reached
        reached |= new
        todo += new
    assert len({tuple(below(s)) for s in reached}) == len(reached)


def test_vendor_clients_of_odd_rows(spark):
    clients = [(1, "Ann Lee"), (2, "ANNLEE"), (2, "ANNLEE"), (None, "annlee"), (5, "Annle"), (6, None), (7, " \t "), (8, "Bob"), (9, "É lan")]
    vendors = [(i, n) for i in range(1, 7) for n in ("Ann Lee", "bOb")] + [(1, "Ann Lee"), (None, "annlee"), (8, None), (9, ""), (10, "x"), (11, "é lan")]
    client_table = spark.createDataFrame([(i, n, "zz") for i, n in clients], "client_id long, name string, vendor_id string")
    vendor_table = spark.createDataFrame([(i, n, 4) for i, n in vendors], "vendor_id long, name string, client_id int")

    def form(name):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in name)
        return "".join(c for c in low if c not in " \t\n\x0b\x0c\r")

    def missed(i, name):
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 2 or len(name) < 2:
            return name
        k = h % (len(name) - 1)
        return name[:k] + name[k + 1] + name[k] + name[k + 2 :]

    expected = {}
    for v, b in {(i, form(missed(i, n))) for i, n in vendors if n is not None}:
        for c, n in clients:
            if n is not None and form(n) and b and (d := distance(form(n), b)) <= 1:
                expected.setdefault((v, d), []).append(c)
    wanted = {(v, d, len(c), min((x for x in c if x is not None), default=None), sum(zlib.crc32(str(x).encode()) for x in c if x is not None) or None) for (v, d), c in expected.items()}
    assert {tuple(r) for r in name_join.vendor_clients(client_table, vendor_table).collect()} == wanted
    for a, b in ((client_table.limit(0), vendor_table), (client_table, vendor_table.limit(0)), (client_table.limit(0), vendor_table.limit(0))):
        assert name_join.vendor_clients(a, b).count() == 0


# ---------------------------------------------------------------- near vectors


def plain_links(rows, cosine=0.93):
    usable = [k for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in usable}
    near = {k: set() for k in range(len(rows))}
    for a in usable:
        for b in usable:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                near[a].add(b)
                near[b].add(a)
    return near


def plain_result(rows, near):
    root = list(range(len(rows)))
    find = lambda k: k if root[k] == k else find(root[k])
    for a, bs in near.items():
        for b in bs:
            root[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(near[k]), None if i is None else least[find(k)], i is None or i == least[find(k)]) for k, (i, _, _) in enumerate(rows)), key=str)


def near_at(rng, v, cosine):
    u = rng.standard_normal(len(v))
    u -= (u @ v) * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine**2) * u / np.linalg.norm(u)


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    """Copies, one tight group of many permutations, a loose one and chains; small blocks, so that lists are cut."""
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rng = np.random.default_rng(11)
    base = rng.standard_normal((260, 24))
    rows = [(i, [float(c) for c in v], i % 3) for i, v in enumerate(base)]
    tight = [near_at(rng, base[1], 0.995) for _ in range(120)] + [near_at(rng, base[1], 0.97) for _ in range(60)]
    loose = [near_at(rng, base[2], c) for c in np.linspace(0.94, 0.999, 80)]
    chain = [base[4]]
    for _ in range(20):
        chain.append(near_at(rng, chain[-1], 0.96))
    rows += [(1000 + k, [float(c) for c in v], 1) for k, v in enumerate([*tight, *chain])] + [(2000 + k, [float(c) * 3 for c in v], 2) for k, v in enumerate(loose)]
    rows += [(3000 + k, rows[5][1], 2) for k in range(30)]
    table = spark.createDataFrame([(i, v, label, 0, "x") for i, v, label in rows], VECTORS).repartition(5)
    near = plain_links(rows)
    found, expected = {r[0]: r for r in rows_of(pivots.similar_vectors(table))}, {r[0]: r for r in plain_result(rows, near)}
    assert sum(r[1] for r in found.values()) >= 0.9 * sum(r[1] for r in expected.values())
    assert all(found[i][1] <= expected[i][1] for i in expected)
    assert sum(found[i] == expected[i] for i in expected) >= 0.9 * len(expected)


def test_recall_at_the_limit(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(1500):
        v = rng.standard_normal(64)
        rows += [(2 * k, v, 0), (2 * k + 1, near_at(rng, v, float(rng.uniform(0.931, 0.96))), 0)]
    table = spark.createDataFrame([(i, [float(c) for c in v], label, 0, "x") for i, v, label in rows], VECTORS)
    linked = pivots.similar_vectors(table).where("n_links > 0").count()
    assert 0.9 * 3000 <= linked <= 3000


def test_a_ball_is_counted_without_pairs_and_open_pairs_are_looked_at():
    rng = np.random.default_rng(2)
    i, j = np.triu_indices(50, 1)
    ends = pivots._forest(i, j, np.arange(50) + 100)
    assert len(ends[0]) == 49 and set(ends[1]) == {100}
    a, b = rng.permutation(30), rng.permutation(30)
    child, root = pivots._forest(a[:20], b[:20], np.arange(30))
    label = dict(zip(child, root))
    assert all(label.get(x, x) == label.get(y, y) for x, y in zip(a[:20], b[:20]))


def test_near_vectors_of_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (1, v, 0), (2, v, 1), (3, v, None), (None, v, 0), (4, None, 0), (5, [0.0, -0.0], 0), (6, [math.nan, 1.0], 0), (7, [None, 1.0], 0), (8, [math.inf], 0), (9, [], 0), (10, [1e200, 2e200, 3e200], 0), (11, [1e-300, 2e-300, 3e-300], 0), (12, [1.0, 2.0], 0), (13, [-1.0, -2.0, -3.0], 0)]
    table = spark.createDataFrame([(i, x, label, 5, "body") for i, x, label in rows], VECTORS)
    found = {(r[0], r[1], r[2], r[3]) for r in rows_of(pivots.similar_vectors(table))}
    linked = {(1, 3, 1, True), (10, 3, 1, False), (11, 3, 1, False)}
    assert found == linked | {(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 9, 12, 13)} | {(None, 0, None, True)}
    assert pivots.similar_vectors(table.limit(0)).count() == 0
    assert pivots.similar_vectors(table.where("vec_id = 4")).count() == 1
