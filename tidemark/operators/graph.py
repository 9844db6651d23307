"""The commit graph: ancestors, merge bases, branch commits, and pull requests read off merge commits.

All of them rest on an index of the history that takes a logarithmic number of rounds. Commits and their first parents are
a forest; pointer doubling gives every commit its depth and the longest line of children above it, and so the chain that it
lies on: chains follow first parents, and the ancestors of a commit on any chain are all places up to some furthest one.
A walk over the history keeps one such place for each chain that it reaches and goes from chain to chain over the other
edges (merges, and the bottoms of chains), all pairs of a call at once, so it takes as many rounds as chains follow on one
another, not as many as there are commits.

Every tree of first parents has a main chain, the one at its root. How far up the main chain a commit reaches never falls
towards its children, and is kept for each edge between chains; a walk that looks for some commits leaves out edges to all
that reach less far than they do, so pairs of a branch and its base are settled near the branch, not at the root.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.sources.sinks import forget, settled

#: Lengths of the stretches into which places are cut to find the edges of an interval: an interval is in 65 of them at most.
STRETCHES, MOST = [16 * 64**i for i in range(5)], 64
#: What a history may have at most, for ancestors to be kept as arrays: layers, and ancestors (with their edges) of a commit.
LAYERS, ANCESTORS = 32, 4096
#: The parent of a code that stands for a commit without parents.
ITSELF = (1 << 32) - 1


def commit_edges(commits: DataFrame) -> DataFrame:
    """(child, parent, ordinal): one edge for each parent of a commit."""
    return commits.select(F.col("sha").alias("child"), F.posexplode("parent_shas").alias("ordinal", "parent"))


@dataclass(frozen=True)
class CommitIndex:
    """nodes: (node, tree, chain, pos), every commit's place. chains: (chain, tree, main, bottom, floor): whether it is the
    main chain of its tree, its lowest place, and how far up the main chain that reaches. cross: (chain, pos, to_chain,
    to_pos, to_tree, to_reach, to_line, level, stretch), the edges between chains, each once for each length of stretches;
    to_line is the tree whose main chain the edge leads to, if it does.

    Where an edge leaves a tree for another one, places on the main chain say nothing: floor and to_reach are null there."""

    nodes: DataFrame
    chains: DataFrame
    cross: DataFrame


def _first_parents(edges: DataFrame, more: DataFrame | None) -> DataFrame:
    """(node, jump): every node with its first parent, by ordinal where there is one."""
    ordinal = F.col("ordinal") if "ordinal" in edges.columns else F.lit(0)
    first = edges.groupBy(F.col("child").alias("node")).agg(F.min(F.struct(ordinal, F.col("parent"))).alias("x")).select("node", F.col("x.parent").alias("jump"))
    nodes = edges.select(F.col("child").alias("node")).unionByName(edges.select(F.col("parent").alias("node")))
    if more is not None:
        nodes = nodes.unionByName(more.where("node IS NOT NULL").select("node"))
    return nodes.distinct().join(first, "node", "left")


def _ranked(first: DataFrame) -> DataFrame:
    """(node, tree, chain, pos) by pointer doubling. After k rounds a node knows its ancestor 2 ** k steps down (jump), if it
    has one, how many steps it has been followed down and to where, and the furthest child fewer than 2 ** k steps up."""
    state, more = _counted(first.select("node", "jump", F.when(F.col("jump").isNull(), 0).otherwise(1).alias("pos"), F.coalesce("jump", "node").alias("tree"), F.struct(F.lit(0).alias("up"), F.col("node").alias("chain")).alias("best")), "chains", F.col("jump").isNotNull())
    n, step = state.count(), 1
    while more:
        if step > 2 * n:
            raise ValueError("some commits are their own ancestors")
        far = state.select(F.col("node").alias("__at"), F.col("jump").alias("__jump"), F.col("pos").alias("__pos"), F.col("tree").alias("__tree"))
        above = state.where("jump IS NOT NULL").groupBy(F.col("jump").alias("node")).agg(F.max(F.struct((F.col("best.up") + step).alias("up"), F.col("best.chain").alias("chain"))).alias("__above"))
        moved = state.join(far, F.col("jump") == F.col("__at"), "left").join(above, "node", "left")
        moved = moved.select("node", F.col("__jump").alias("jump"), (F.col("pos") + F.coalesce("__pos", F.lit(0))).alias("pos"), F.coalesce("__tree", "tree").alias("tree"), F.greatest("best", "__above").alias("best"))
        after, more = _counted(moved, "chains", F.col("jump").isNotNull())
        forget(state)
        state, step = after, 2 * step
    return state.select("node", "tree", F.col("best.chain").alias("chain"), "pos")


def _reaches(points: DataFrame, known: DataFrame) -> DataFrame:
    """points (chain, pos, ...) with reach: the largest `reach` of known (chain, pos, reach) on the chain, up to pos."""
    both = known.select("chain", "pos", "reach").withColumn("__asks", F.lit(0)).unionByName(points.withColumn("__asks", F.lit(1)), allowMissingColumns=True)
    upto = Window.partitionBy("chain").orderBy("pos", "__asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("reach", F.max("reach").over(upto)).where("__asks = 1").drop("__asks")


def _stretched(df: DataFrame) -> DataFrame:
    at = [F.struct(F.lit(i).alias("level"), F.floor(F.col("pos") / size).cast("bigint").alias("stretch")) for i, size in enumerate(STRETCHES)]
    return df.select("*", F.inline(F.array(*at)))


def index_commits(edges: DataFrame, more: DataFrame | None = None) -> CommitIndex:
    """The index of the commits of edges (child, parent, perhaps ordinal), and of the nodes of `more` (node)."""
    edges = edges.where("child <> parent")
    nodes = settled(_ranked(_first_parents(edges, more)), "commits")
    main = nodes.where("pos = 0").select("tree", F.col("chain").alias("__main"))
    child = nodes.select(F.col("node").alias("child"), "tree", "chain", "pos")
    parent = nodes.select(F.col("node").alias("parent"), *[F.col(c).alias(f"to_{c}") for c in ("tree", "chain", "pos")])
    found = edges.select("child", "parent").join(child, "child").join(parent, "parent").where("chain <> to_chain").drop("child", "parent").distinct()
    strays = found.where("tree <> to_tree").select("tree").distinct().withColumn("__stray", F.lit(True))
    lines = main.join(strays, "tree", "left").select("tree", "__main", F.coalesce("__stray", F.lit(False)).alias("__stray"))
    to = lines.select(F.col("tree").alias("to_tree"), F.col("__main").alias("__to_main"), F.col("__stray").alias("__to_stray"))
    found = found.join(lines.drop("__stray"), "tree").join(to, "to_tree")
    known = F.when(~F.col("__to_stray"), F.when(F.col("to_chain") == F.col("__to_main"), F.col("to_pos")))
    asks = (F.col("to_chain") != F.col("__to_main")) & ~F.col("__to_stray")
    found = settled(found.select("tree", "chain", "pos", "to_tree", "to_chain", "to_pos", (F.col("chain") == F.col("__main")).alias("__of_main"), asks.alias("__asks_on"), known.alias("reach")), "edges")
    key = ["chain", "pos", "to_chain", "to_pos"]
    while found.where("__asks_on").limit(1).count():  # what other chains reach is known once all that they lead to is
        inside = found.where("tree = to_tree AND NOT __of_main AND reach IS NOT NULL")
        points = found.where("__asks_on").select(F.col("to_chain").alias("chain"), F.col("to_pos").alias("pos"), F.col("chain").alias("__c"), F.col("pos").alias("__p"))
        fresh = _reaches(points, inside).select(F.col("__c").alias("chain"), F.col("__p").alias("pos"), F.col("chain").alias("to_chain"), F.col("pos").alias("to_pos"), F.col("reach").alias("__fresh"))
        new = F.coalesce(F.col("__fresh") > F.coalesce("reach", F.lit(-1)), F.lit(False))
        after, changed = _counted(found.join(fresh, key, "left").withColumn("__new", new).withColumn("reach", F.greatest("reach", "__fresh")).drop("__fresh"), "edges", F.col("__new"))
        forget(found)
        found = after.drop("__new")
        if not changed:
            break
    of_chain = nodes.groupBy("chain", "tree").agg(F.min("pos").alias("bottom"))
    floors = found.where("tree = to_tree").groupBy("chain", F.col("pos").alias("bottom")).agg(F.max("reach").alias("floor"))
    chains = of_chain.join(lines, "tree").join(floors, ["chain", "bottom"], "left")
    chains = chains.select("chain", "tree", (F.col("chain") == F.col("__main")).alias("main"), "bottom", F.when(~F.col("__stray"), F.when(F.col("chain") == F.col("__main"), F.col("bottom")).otherwise(F.col("floor"))).alias("floor"))
    chains = settled(chains, "chains")
    line = chains.where("main AND floor IS NOT NULL").select(F.col("chain").alias("to_chain"), F.col("tree").alias("to_line"))
    cross = found.join(line, "to_chain", "left").select("chain", "pos", "to_chain", "to_pos", "to_tree", F.col("reach").alias("to_reach"), "to_line")
    return CommitIndex(nodes, chains, settled(_stretched(cross), "cross"))


def _between(spans: DataFrame, cross: DataFrame) -> DataFrame:
    """Each span (chain, over, upto, ...) with the edges of its chain from places over < pos <= upto."""
    length, level = F.col("upto") - F.col("over"), F.lit(len(STRETCHES) - 1)
    for i in reversed(range(len(STRETCHES) - 1)):
        level = F.when(length <= STRETCHES[i] * MOST, i).otherwise(level)
    size = F.element_at(F.array(*map(F.lit, STRETCHES)), level + 1)
    first, last = (F.floor(c / size).cast("bigint") for c in (F.col("over") + 1, F.col("upto")))
    dealt = spans.where("upto > over").withColumn("level", level).withColumn("stretch", F.explode(F.sequence(first, last)))
    return dealt.join(cross, ["chain", "level", "stretch"]).where("pos > over AND pos <= upto").drop("level", "stretch")


def _counted(df: DataFrame, name: str, open_: Column) -> tuple[DataFrame, int]:
    """df written as a table, and how many of its rows are open, counted on the way."""
    seen = Observation()
    table = settled(df.observe(seen, F.count_if(open_).alias("n")), name)
    return table, seen.get["n"]


def _closure(index: CommitIndex, seeds: DataFrame, sought: DataFrame) -> DataFrame:
    """(pid, chain, r): how far up each chain the ancestors of seeds (pid, chain, r) go, as far as is needed to tell which of
    the commits sought are among them; sought (pid, tree, low) has the tree in which they all lie and the least place on its
    main chain that they reach, or null and -1."""
    facts = ["tree", "low", "line"]  # line: the tree whose main chain the chain is, if places on it say anything
    lines = index.chains.select("chain", F.when(F.col("main") & F.col("floor").isNotNull(), F.col("tree")).alias("line"))
    first = seeds.groupBy("pid", "chain").agg(F.max("r").alias("r")).join(sought, "pid").join(lines, "chain")
    state, more = _counted(first.select("pid", "chain", "r", F.lit(-1).alias("done"), *facts), "closure", F.col("r") > F.col("done"))
    over = F.greatest("done", F.when(F.col("line") == F.col("tree"), F.col("low")))
    while more:
        found = _between(state.where("r > done").select("pid", "chain", over.alias("over"), F.col("r").alias("upto"), "tree", "low"), index.cross)
        found = found.where(~F.coalesce((F.col("tree") == F.col("to_tree")) & (F.col("to_reach") < F.col("low")), F.lit(False)))
        hops = found.select("pid", F.col("to_chain").alias("chain"), F.col("to_pos").alias("r"), F.lit(-1).alias("done"), "tree", "low", F.col("to_line").alias("line"))
        both = state.select("pid", "chain", "r", F.col("r").alias("done"), *facts).unionByName(hops)
        after, more = _counted(both.groupBy("pid", "chain").agg(*[F.max(c).alias(c) for c in ("r", "done", *facts)]), "closure", F.col("r") > F.col("done"))
        forget(state)
        state = after
    return state.select("pid", "chain", "r")


def _sought(index: CommitIndex, open_: DataFrame) -> DataFrame:
    """(pid, tree, low) of the open places (pid, chain, over): those of a chain above `over`."""
    rows = open_.join(index.chains, "chain").select("pid", "tree", F.when(F.col("main") & F.col("floor").isNotNull(), F.col("over") + 1).otherwise(F.col("floor")).alias("low"))
    found = rows.groupBy("pid").agg(F.min("tree").alias("a"), F.max("tree").alias("b"), F.min("low").alias("low"), F.bool_or(F.col("low").isNull()).alias("unknown"))
    one = (F.col("a") == F.col("b")) & ~F.col("unknown")
    return found.select("pid", F.when(one, F.col("a")).alias("tree"), F.when(one, F.col("low")).otherwise(-1).alias("low"))


def _seeds(index: CommitIndex, pairs: DataFrame, side: str) -> DataFrame:
    """(pid, chain, at): the place of a side's commit, and that on the main chain of its tree which it reaches."""
    own = pairs.select("pid", F.col(side).alias("node")).join(index.nodes, "node").join(index.chains.select("chain", "main", "floor"), "chain")
    own = own.select("pid", "tree", "chain", "pos", "main", "floor")
    known = index.cross.where("level = 0").join(index.chains.select("chain", "tree", "main"), "chain").where("tree = to_tree AND NOT main")
    side_way = _reaches(own.where("NOT main AND floor IS NOT NULL").select("chain", "pos", "pid", "tree"), known.select("chain", "pos", F.col("to_reach").alias("reach")))
    mains = index.chains.where("main").select("tree", F.col("chain").alias("__main"))
    reached = side_way.where("reach IS NOT NULL").join(mains, "tree").select("pid", F.col("__main").alias("chain"), F.col("reach").alias("at"))
    return own.select("pid", "chain", F.col("pos").alias("at")).unionByName(reached)


def _walk(index: CommitIndex, pairs: DataFrame) -> DataFrame:
    """(pid, chain, l, r) for pairs (pid, left, right): how far up each chain left and right reach, -1 for not at all. It is
    exact as to what left reaches and right does not (r < pos <= l), and has every best common ancestor as the lower of the
    two of a chain."""
    none = F.lit(-1)
    most = [F.max(c).alias(c) for c in ("l", "r", "done")]
    left = _seeds(index, pairs, "left").select("pid", "chain", F.col("at").alias("l"), none.alias("r"), none.alias("done"))
    right = _seeds(index, pairs, "right").select("pid", "chain", none.alias("l"), F.col("at").alias("r"), none.alias("done"))
    over = F.greatest("r", "done")
    state, more = _counted(left.unionByName(right).groupBy("pid", "chain").agg(*most), "walk", F.col("l") > over)
    while more:
        sought = settled(_sought(index, state.where(F.col("l") > over).select("pid", "chain", over.alias("over"))), "sought")
        closed = _closure(index, state.where("r >= 0").join(sought, "pid", "left_semi").select("pid", "chain", "r"), sought)
        met = settled(state.unionByName(closed.select("pid", "chain", none.alias("l"), "r", none.alias("done"))).groupBy("pid", "chain").agg(*most), "walk")
        found = _between(met.select("pid", "chain", over.alias("over"), F.col("l").alias("upto")), index.cross)
        gone = met.withColumn("done", F.greatest("done", F.when(F.col("l") > over, F.col("l"))))
        hops = found.select("pid", F.col("to_chain").alias("chain"), F.col("to_pos").alias("l"), none.alias("r"), none.alias("done"))
        after, more = _counted(gone.unionByName(hops).groupBy("pid", "chain").agg(*most), "walk", F.col("l") > over)
        for old in (state, sought, closed, met):
            forget(old)
        state = after
    return state.select("pid", "chain", "l", "r")


def _numbered(pairs: DataFrame) -> DataFrame:
    return settled(pairs.where("left IS NOT NULL").distinct().withColumn("pid", F.monotonically_increasing_id()), "pairs")


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("left").alias("node")).unionByName(pairs.select(F.col("right").alias("node")))


def _small_numbers(edges: DataFrame, tips: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """edges (child, parent) and tips (node) with commits as numbers below 2 ** 31, and their names (id, node); None where the
    commits are such numbers themselves."""
    edges = edges.where("child <> parent").select("child", "parent").distinct()
    nodes = edges.select(F.col("child").alias("node")).unionByName(edges.select(F.col("parent").alias("node"))).unionByName(tips.select("node"))
    if all(k in ("tinyint", "smallint", "int", "bigint") for k in dict(nodes.dtypes).values()):
        least, most = nodes.agg(F.min("node"), F.max("node")).first()
        if least is None or (least >= 0 and most < (1 << 31)):
            number = lambda df: df.select([F.col(c).cast("bigint").alias(c) for c in df.columns])
            return number(edges), number(tips.select("node")), None
    edges = settled(edges, "edges")  # read more than once, and what makes them may be dear
    nodes = edges.select(F.explode(F.array("child", "parent")).alias("node")).unionByName(tips.select("node"))
    dealt = settled(nodes.where("node IS NOT NULL").distinct().withColumn("b", F.pmod(F.xxhash64("node"), F.lit(1024))), "nodes")
    before = dealt.groupBy("b").agg(F.count(F.lit(1)).alias("n")).select("b", F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("b").orderBy("node"))
    names = settled(dealt.withColumn("rank", rank).join(before, "b").select((F.col("before") + F.col("rank") - 1).cast("bigint").alias("id"), "node"), "names")
    ends = edges.join(names.select(F.col("id").alias("__c"), F.col("node").alias("child")), "child").join(names.select(F.col("id").alias("__p"), F.col("node").alias("parent")), "parent")
    return ends.select(F.col("__c").alias("child"), F.col("__p").alias("parent")), tips.join(names, "node").select(F.col("id").alias("node")), names


def _closed(edges: DataFrame, tips: DataFrame, with_edges: bool) -> DataFrame | None:
    """(id, known): the ancestors of each of tips (node) and of all that they reach, themselves included; with_edges: their edges
    as codes, child << 32 | parent, and a code with ITSELF for each that has no parents. None if the history has more layers or ancestors than
    that is meant for. A commit's layer is its longest way from a tip; the deepest are done first."""
    edges = settled(edges, "links")
    layer, more = _counted(tips.where("node IS NOT NULL").select(F.col("node").alias("id")).distinct(), "layer", F.lit(True))
    layers = []
    while more:
        if len(layers) > LAYERS:
            return None
        layers.append(layer)
        layer, more = _counted(edges.join(layer, F.col("child") == F.col("id"), "left_semi").select(F.col("parent").alias("id")).distinct(), "layer", F.lit(True))
    if not layers:
        return tips.select(F.col("node").alias("id"), F.array("node").alias("known"))
    at = reduce(DataFrame.unionByName, [x.withColumn("depth", F.lit(i)) for i, x in enumerate(layers)]).groupBy("id").agg(F.max("depth").alias("depth"))
    at = settled(at, "layers")
    below = at.select(F.col("id").alias("parent"), F.col("depth").alias("below"))
    links = settled(at.join(edges.withColumnRenamed("child", "id"), "id", "left").join(below, "parent", "left").select("id", "depth", "parent", "below"), "links")
    asked: dict[int, list[int]] = {}
    for depth, far in links.where("below IS NOT NULL").select("depth", "below").distinct().collect():
        asked.setdefault(depth, []).append(far)
    code = lambda parent: F.shiftleft(F.col("id"), 32).bitwiseOR(parent)
    own = F.array(code(F.col("parent"))) if with_edges else F.array("id")
    roots = F.array(code(F.lit(ITSELF))) if with_edges else F.array("id")
    done: dict[int, DataFrame] = {}
    for depth in reversed(range(len(layers))):
        mine = links.where(F.col("depth") == depth)
        made = mine.where("parent IS NULL").select("id", roots.alias("known"))
        if depth in asked:
            there = reduce(DataFrame.unionByName, [done[i] for i in asked[depth]]).select(F.col("id").alias("parent"), "known")
            each = mine.join(there, "parent").select("id", F.concat(own, "known").alias("known"))
            made = made.unionByName(each.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("known"))).alias("known")))
        seen = Observation()
        done[depth] = settled(made.observe(seen, F.max(F.size("known")).alias("n")), "known")
        if (seen.get["n"] or 0) > ANCESTORS:
            return None
    return reduce(DataFrame.unionByName, list(done.values()))


def _by_arrays(edges: DataFrame, pairs: DataFrame, with_edges: bool, found: Column, both_sides: bool = True) -> DataFrame | None:
    """(left, right, node) for pairs (left, right): the commits whose numbers `found` gives, of l and r, what _closed knows of
    both; None where it declines."""
    links, tips, names = _small_numbers(edges, _named(pairs))
    known = _closed(links, tips, with_edges)
    if known is None:
        return None
    if names is None:
        ids = pairs.select("left", "right", F.col("left").cast("bigint").alias("__l"), F.col("right").cast("bigint").alias("__r"))
    else:
        ids = pairs.join(names.select(F.col("node").alias("left"), F.col("id").alias("__l")), "left").join(names.select(F.col("node").alias("right"), F.col("id").alias("__r")), "right", "left")
    both = ids.join(known.select(F.col("id").alias("__l"), F.col("known").alias("l")), "__l")
    if both_sides:
        both = both.join(known.select(F.col("id").alias("__r"), F.col("known").alias("r")), "__r", "left")
    both = both.select("left", "right", F.explode(found).alias("id"))
    if names is None:
        return both.select("left", "right", F.col("id").cast(edges.schema["child"].dataType).alias("node"))
    return both.join(names, "id").select("left", "right", "node")


def _left_only(edges: DataFrame, pairs: DataFrame, index: CommitIndex | None) -> DataFrame:
    """(left, right, node): for each pair the commits that left reaches and right does not; a null right reaches nothing."""
    pairs = _numbered(pairs)
    if index is None:
        none = F.array().cast("array<bigint>")
        found = _by_arrays(edges, pairs.select("left", "right"), False, F.array_except("l", F.coalesce("r", none)))
        if found is not None:
            return found
    index = index or index_commits(edges, _named(pairs))
    own = _walk(index, pairs).where("l > r").join(index.chains.select("chain", "bottom"), "chain")
    places = own.select("pid", "chain", F.explode(F.sequence(F.greatest(F.col("r") + 1, F.col("bottom")), F.col("l"))).alias("pos"))
    return places.join(index.nodes.select("chain", "pos", "node"), ["chain", "pos"]).join(pairs, "pid").select("left", "right", "node")


def ancestors(edges: DataFrame, tips: DataFrame, index: CommitIndex | None = None) -> DataFrame:
    """(tip, node): every node that a tip (one column, tip) reaches over edges (child, parent), itself included."""
    pairs = tips.select(F.col("tip").alias("left"), F.lit(None).cast(tips.schema["tip"].dataType).alias("right"))
    if index is None:
        found = _by_arrays(edges, pairs.where("left IS NOT NULL").distinct(), False, F.col("l"), both_sides=False)
        if found is not None:
            return found.select(F.col("left").alias("tip"), "node")
    return _left_only(edges, pairs, index).select(F.col("left").alias("tip"), "node")


def _undominated(index: CommitIndex, tops: DataFrame) -> DataFrame:
    """Of commits (pid, chain, pos), several a pid, those that no other one of the pid descends from: those that aren't
    among the ancestors of all of their parents."""
    spans = tops.select("pid", "chain", (F.col("pos") - 1).alias("over"), F.col("pos").alias("upto"))
    below = spans.join(index.chains.select("chain", "bottom"), "chain").where("over >= bottom").select("pid", "chain", F.col("over").alias("r"))
    parents = below.unionByName(_between(spans, index.cross).select("pid", F.col("to_chain").alias("chain"), F.col("to_pos").alias("r")))
    sought = settled(_sought(index, spans.select("pid", "chain", "over")), "sought")
    reached = _closure(index, parents, sought)
    return tops.join(reached, ["pid", "chain"], "left").where("r IS NULL OR r < pos").select("pid", "chain", "pos")


def _bases_by_index(index: CommitIndex, pairs: DataFrame) -> DataFrame:
    """(left, right, base) of merge_base, for numbered pairs."""
    common = settled(_walk(index, pairs).where("l >= 0 AND r >= 0").select("pid", "chain", F.least("l", "r").alias("pos")), "common")
    several = common.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pid")
    tops = common.join(several, "pid", "left_anti").unionByName(_undominated(index, settled(common.join(several, "pid", "left_semi"), "common")))
    return tops.join(index.nodes.select("chain", "pos", F.col("node").alias("base")), ["chain", "pos"]).join(pairs, "pid").select("left", "right", "base")


def merge_base(edges: DataFrame, pairs: DataFrame, order: DataFrame | None = None, index: CommitIndex | None = None) -> DataFrame:
    """(left, right, base): the best common ancestors of each pair (left, right), those that no other common ancestor
    descends from. There may be several; order (node, committed_at) keeps one, the latest, then the smallest."""
    pairs = _numbered(pairs.select("left", "right"))
    best = None
    if index is None:  # what is common is closed, so the parents of what is common are all that others descend from
        both = F.array_intersect("l", "r")
        tops = F.array_except(F.transform(both, lambda c: F.shiftright(c, 32)), F.transform(both, lambda c: c.bitwiseAND(F.lit(ITSELF))))
        best = _by_arrays(edges, pairs.select("left", "right"), True, tops)
        best = best if best is None else best.withColumnRenamed("node", "base")
    if best is None:
        best = _bases_by_index(index or index_commits(edges, _named(pairs)), pairs)
    if order is None:
        return best
    dated = best.join(order.select(F.col("node").alias("base"), "committed_at"), "base", "left")
    pick = F.min_by("base", F.struct(-F.coalesce(F.unix_micros(F.col("committed_at").cast("timestamp")), F.lit(0)), F.col("base")))
    return dated.groupBy("left", "right").agg(pick.alias("base"))


def branch_commits(edges: DataFrame, heads: DataFrame, fallback: DataFrame | None = None, index: CommitIndex | None = None) -> DataFrame:
    """(head, node): commits that a head (head, base) reaches and its base does not. A head without any gets those of
    fallback (head, node), such as the commits inside its task's window."""
    own = _beyond_base(edges, heads, index).select("head", "node").distinct()
    if fallback is None:
        return own
    rest = fallback.select("head", "node").join(own.select("head").distinct(), "head", "left_anti")
    return own.unionByName(rest)


def _beyond_base(edges: DataFrame, heads: DataFrame, index: CommitIndex | None = None) -> DataFrame:
    """(head, base, node) of each pair: what the head reaches and its base does not. A null base reaches nothing."""
    pairs = heads.select(F.col("head").alias("left"), F.col("base").alias("right"))
    return _left_only(edges, pairs, index).select(F.col("left").alias("head"), F.col("right").alias("base"), "node")


def derive_pulls(commits: DataFrame, edges: DataFrame, index: CommitIndex | None = None) -> DataFrame:
    """Pull requests of merge commits: number and branch from the message, the author and times from the branch's commits.

    (pr_number, branch, merge_sha, merged_at, opened_at, author, commits, changed_files)"""
    # Fixed value: how a merge commit names its pull request
    said = r"^Merge pull request #(\d+) from (\S+)"
    number = F.regexp_extract("message", said, 1)
    merges = commits.where((number != "") & (F.size("parent_shas") > 1)).select(
        number.cast("int").alias("pr_number"), F.regexp_extract("message", said, 2).alias("branch"),
        F.col("sha").alias("merge_sha"), F.col("authored_at").alias("merged_at"), F.get("parent_shas", F.lit(1)).alias("head"), F.get("parent_shas", F.lit(0)).alias("base"),
    )
    own = _beyond_base(edges, merges.select("head", "base").distinct(), index)
    facts = own.join(commits.select(F.col("sha").alias("node"), "authored_at", "author_name", "changed_files"), "node")
    files = facts.select("head", "base", F.explode("changed_files").alias("f")).groupBy("head", "base").agg(F.count_distinct("f").alias("changed_files"))
    per = facts.groupBy("head", "base").agg(F.max("authored_at").alias("opened_at"), F.min_by("author_name", F.struct("authored_at", "node")).alias("author"), F.count(F.lit(1)).alias("commits"))
    found = merges.join(per, ["head", "base"], "left").join(files, ["head", "base"], "left")
    return found.select("pr_number", "branch", "merge_sha", "merged_at", "opened_at", "author", F.coalesce("commits", F.lit(0)).alias("commits"), F.coalesce("changed_files", F.lit(0)).alias("changed_files"))
