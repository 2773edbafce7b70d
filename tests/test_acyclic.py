"""Cycle-refusing insertion in parts against the plain fold, with bounds so small that every path is taken."""

import random

import pytest

from loamstack.operators import acyclic, graph


def plain(rows):
    succ, out = {}, []
    for place, a, b in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        seen, stack = set(), [b]
        while stack and a not in seen:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack += succ.get(x, ())
        if a not in seen:
            succ.setdefault(a, set()).add(b)
            out.append((place, a, b))
    return sorted(out)


def taken(spark, rows, **bounds):
    df = spark.createDataFrame(rows, "place long, source string, target string")
    return sorted((r["place"], r["source"], r["target"]) for r in acyclic.acyclic(df, "place", **bounds).collect())


@pytest.mark.parametrize("nodes, edges, bounds", [(6, 40, {}), (30, 200, {"chunk": 16})])
def test_equals_the_fold(spark, nodes, edges, bounds):
    rnd = random.Random(nodes)
    rows = [(rnd.randrange(edges), f"n{rnd.randrange(nodes)}", f"n{rnd.randrange(nodes)}") for _ in range(edges)]
    assert taken(spark, rows, **bounds) == plain(rows)


def test_components_too_large_for_a_task_are_cut(spark, monkeypatch):
    """One strong component of five nodes with bounds of four; three edges close cycles."""
    calls, settled = [], acyclic._settled
    monkeypatch.setattr(acyclic, "_settled", lambda *a: calls.append(1) or settled(*a))
    rows = [(k, f"n{a}", f"n{b}") for k, (a, b) in enumerate([(0, 1), (1, 2), (2, 3), (3, 0), (3, 4), (4, 1), (2, 0), (1, 2)])]
    assert taken(spark, rows, most_nodes=4, chunk=2) == plain(rows) == [r for r in rows if r[0] not in (3, 5, 6)]
    assert len(calls) >= 3


def test_many_edges_of_few_nodes(spark):
    """100,000 edges, of which a chunk orders the nodes and joins settle the rest."""
    rnd = random.Random(1)
    rows = [(k, f"n{rnd.randrange(250)}", f"n{rnd.randrange(250)}") for k in range(100_000)]
    first, ahead = {}, {f"n{k}": set() for k in range(250)}
    for k, a, b in rows:
        if (a, b) not in first:
            first[a, b] = a != b and a not in ahead[b]
            if first[a, b] and b not in ahead[a]:
                for x, far in ahead.items():
                    if x == a or a in far:
                        far |= ahead[b] | {b}
    assert taken(spark, rows, chunk=2048) == sorted(r for r in rows if first[r[1:]])


def test_strong_components(spark):
    """A long cycle, two that share no node, a tail and a chain."""
    ring = [(k, (k + 1) % 60) for k in range(60)]
    rows = ring + [(59, 1000), (1000, 1001), (2000, 2001), (2001, 2002), (2002, 2000), (2002, 3000)]
    sets = {}
    for r in acyclic.strong_components(spark.createDataFrame(rows, "u long, v long")).collect():
        sets.setdefault(r["component"], set()).add(r["node"])
    assert sorted(sorted(s) for s in sets.values() if len(s) > 1) == [list(range(60)), [2000, 2001, 2002]]


def test_nulls_loops_and_nothing(spark):
    rows = [(1, "a", "b"), (2, None, "a"), (3, "b", None), (4, "a", "a"), (5, "b", "a"), (6, "a", "b")]
    df = spark.createDataFrame(rows, "place long, source string, target string")
    assert sorted(r["place"] for r in graph.acyclic(df, "place").collect()) == [1, 6]
    assert graph.acyclic(df.limit(0), "place").collect() == []
