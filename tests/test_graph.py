"""The commit graph against plain walks over random histories."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import graph


def reached(parents, node):
    seen, todo = {node}, [node]
    while todo:
        for p in parents.get(todo.pop(), []):
            if p not in seen:
                seen.add(p)
                todo.append(p)
    return seen


def history(rng, kind):
    """Edges (child, parent, ordinal) of a few dozen commits: lines with few merges, wide merges, or several roots."""
    n, out = rng.randrange(20, 60), []
    for i in range(1, n):
        if kind == "roots" and rng.random() < 0.08:
            continue
        several = rng.random() > (0.9 if kind == "lines" else 0.6)
        for o, p in enumerate(dict.fromkeys(rng.randrange(0 if kind == "wide" else max(0, i - 8), i) for _ in range(rng.choice([2, 2, 3]) if several else 1))):
            out.append((f"c{i:03}", f"c{p:03}", o))
    return n, out


@pytest.mark.parametrize("kind", ["lines", "wide", "roots"])
def test_bases_and_branches_match_plain_walks(spark, kind):
    rng = random.Random(kind)
    edges, pairs = [], []
    for copy in range(4):  # four histories in one table, each with its own main line
        n, own = history(rng, kind)
        edges += [(f"{copy}{a}", f"{copy}{b}", o) for a, b, o in own]
        pairs += [(f"{copy}c{rng.randrange(n):03}", f"{copy}c{rng.randrange(n):03}") for _ in range(25)]
    pairs += [("zz", "zz"), ("zz", "0c001"), (None, "0c001"), ("0c001", None), ("0c003", "1c003")]
    parents = {}
    for a, b, _ in edges:
        parents.setdefault(a, []).append(b)
    e = spark.createDataFrame(edges, "child string, parent string, ordinal int")
    both = spark.createDataFrame(pairs, "left string, right string")
    index = graph.index_commits(e, graph._named(both))
    want = set()
    for a, b in pairs:
        if a is not None and b is not None:
            common = reached(parents, a) & reached(parents, b)
            want |= {(a, b, x) for x in common - set().union(*[reached(parents, y) for x in common for y in parents.get(x, [])], set())}
    assert sorted(map(tuple, graph.merge_base(e, both, index=index).collect())) == sorted(want) and len(want) > 30
    left = {(a, x) for a, b in pairs if a is not None for x in reached(parents, a) - (reached(parents, b) if b is not None else set())}
    assert sorted(map(tuple, graph.branch_commits(e, both.toDF("head", "base"), index=index).collect())) == sorted(left)


def test_long_line_with_merged_branches(spark):
    """A line of 3000 commits and 150 branches, one merged behind the other: places are told by the index, near the branch."""
    edges = [(f"m{i:05}", f"m{i - 1:05}", 0) for i in range(1, 3000)]
    pairs, want = [], []
    for b in range(150):
        base, merge = 18 * b + 1, 18 * b + 40
        names = [f"m{base:05}", *[f"b{b:03}.{j}" for j in range(5)]]
        edges += [(names[j + 1], names[j], 0) for j in range(5)] + [(f"m{merge:05}", names[-1], 1)]
        pairs.append((names[-1], f"m{merge - 1:05}"))
        want.append((names[-1], f"m{merge - 1:05}", f"m{base:05}"))
    e = spark.createDataFrame(edges, "child string, parent string, ordinal int")
    both = spark.createDataFrame(pairs, "left string, right string")
    index = graph.index_commits(e)
    assert index.chains.count() == 151
    assert sorted(map(tuple, graph.merge_base(e, both, index=index).collect())) == sorted(want)
    assert graph.branch_commits(e, both.toDF("head", "base"), index=index).count() == 5 * 150
    tips = spark.createDataFrame([("m02999",), ("m00000",)], "tip string")
    assert graph.ancestors(e, tips, index=index).count() == 3000 + 5 * 150 + 1


def test_commits_that_are_their_own_ancestors_are_refused(spark):
    with pytest.raises(ValueError):
        graph.index_commits(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string"))


@pytest.mark.parametrize("kind", ["wide", "numbers"])
def test_few_layers_are_closed_without_walks(spark, monkeypatch, kind):
    """Histories of few layers need no index, whose walks take a round for each chain."""

    def refuse(*args, **kwargs):
        raise AssertionError("an index")

    monkeypatch.setattr(graph, "index_commits", refuse)
    rng = random.Random(kind)
    if kind == "numbers":
        n, edges = 300, [(i, p, 0) for i in range(2, 300) for p in sorted({i // 2, i // 3} - {0})]
        pairs, kinds = [(i, i + 1) for i in range(1, 290)] + [(5, None), (400, 400)], "bigint"
    else:
        n, edges = history(rng, kind)
        pairs, kinds = [(f"c{rng.randrange(n):03}", f"c{rng.randrange(n):03}") for _ in range(40)] + [("zz", "zz"), ("c001", None), (None, "c001")], "string"
    parents = {}
    for a, b, _ in edges:
        parents.setdefault(a, []).append(b)
    e = spark.createDataFrame(edges, f"child {kinds}, parent {kinds}, ordinal int")
    both = spark.createDataFrame(pairs, f"left {kinds}, right {kinds}")
    want = set()
    for a, b in pairs:
        if a is not None and b is not None:
            common = reached(parents, a) & reached(parents, b)
            want |= {(a, b, x) for x in common - set().union(*[reached(parents, y) for x in common for y in parents.get(x, [])], set())}
    assert sorted(map(tuple, graph.merge_base(e, both).collect())) == sorted(want)
    left = {(a, x) for a, b in pairs if a is not None for x in reached(parents, a) - (reached(parents, b) if b is not None else set())}
    assert sorted(map(tuple, graph.branch_commits(e, both.toDF("head", "base")).collect())) == sorted(left)
    tips = both.select("left").toDF("tip")
    assert sorted(map(tuple, graph.ancestors(e, tips).collect())) == sorted({(a, x) for a, _ in pairs if a is not None for x in reached(parents, a)})


def test_many_ancestors_are_left_to_the_index(spark, monkeypatch):
    monkeypatch.setattr(graph, "ANCESTORS", 5)
    e = spark.createDataFrame([(i, i - 1) for i in range(1, 9)], "child int, parent int")
    assert graph.merge_base(e, spark.createDataFrame([(8, 6)], "left int, right int")).collect() == [(8, 6, 6)]
    monkeypatch.undo()
    monkeypatch.setattr(graph, "LAYERS", 3)
    assert graph.ancestors(e, spark.createDataFrame([(7,)], "tip int")).count() == 8


def test_what_is_known_of_a_commit_is_its_edges(spark):
    """A code an edge, and one for a root: two thirds of what codes for the commits themselves would add."""
    e = spark.createDataFrame([(i, p) for i in range(2, 100) for p in {i // 2, i // 3} - {0}], "child int, parent int")
    links, tips, _ = graph._small_numbers(e, spark.createDataFrame([(99,), (200,)], "node int"))
    got = {r.id: sorted((c >> 32, c & graph.ITSELF) for c in r.known) for r in graph._closed(links, tips, True).collect()}
    parents = {i: sorted({i // 2, i // 3} - {0}) for i in range(2, 100)}
    assert got[99] == sorted([(x, p) for x in reached(parents, 99) for p in parents.get(x, [graph.ITSELF])]) and got[200] == [(200, graph.ITSELF)]


def test_named_edges_are_made_once(spark):
    """What makes edges may be dear: cleaning of all commits."""
    seen = spark.sparkContext.accumulator(0)

    def told(x):
        seen.add(1)
        return x

    rows = [(f"c{i}", f"c{i // p}") for i in range(2, 50) for p in (2, 3)]
    e = spark.createDataFrame(rows, "child string, parent string").withColumn("child", F.udf(told, "string").asNondeterministic()("child"))
    links, tips, names = graph._small_numbers(e, spark.createDataFrame([("c7",), (None,), ("zz",)], "node string"))
    name = {r.id: r.node for r in names.collect()}
    assert sorted(name) == list(range(len({x for r in rows for x in r}) + 1))
    assert {(name[r.child], name[r.parent]) for r in links.collect()} == set(rows) and {name[r.node] for r in tips.collect()} == {"c7", "zz"}
    assert seen.value == len(rows)
