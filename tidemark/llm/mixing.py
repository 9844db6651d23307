"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's weight is its share of all tokens to the power alpha, normalised; alpha 1 keeps the corpus as it is, alpha
0 weighs all sources alike. Alpha is bisected: to the largest value whose weights have a target entropy, or to the
smallest at which no source is repeated more often than a limit. The budget is then spread over the sources by weight.
Each source's documents are dealt into blocks by a hash of the id; for each pass over the source (an epoch) the blocks
are ordered anew by a seeded hash, and passes are taken until the source's budget is spent: whole passes, then whole
blocks of one more permutation, then documents of the block in which the budget ends, in hash order.

Only sums travel: a row for each source and block, of which a source has MOST_BLOCKS at most. A source that holds a
third of the corpus is never gathered; only the one block of each source in which the budget ends is ordered by
document. What comes back to the documents is one row a source, the place in the permutation where its budget ends.

Defined cases: a null source is a source of its own; null and empty texts have no tokens and are taken as often as
whole passes say; rows that repeat an id, or all of a row, are taken or left one by one; null ids are kept like others;
an empty corpus gives no rows. Extra columns of the input are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Documents of a block on average, blocks of a source and sources at most, and bisection steps.
BLOCK_DOCS, MOST_BLOCKS, MOST_SOURCES, STEPS = 256, 4096, 100_000, 60


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def tempered(tokens: dict, alpha: float) -> dict:
    """Weights in proportion to token shares to the power alpha; sources without tokens weigh nothing."""
    total = sum(tokens.values())
    raw = {s: (n / total) ** alpha if n else 0.0 for s, n in tokens.items()}
    whole = sum(raw.values())
    return {s: x / whole if whole else 0.0 for s, x in raw.items()}


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def repetition(tokens: dict, weights: dict, budget: float | None) -> float:
    """How often the most repeated source is passed over; without a budget, with the least that covers every source."""
    rates = [weights[s] / n for s, n in tokens.items() if n]
    return max(rates, default=0.0) * (budget if budget is not None else 1 / min(rates, default=1.0))


def bisect_alpha(tokens: dict, target_entropy: float | None, max_repeat: float | None, budget: float | None) -> float:
    """The largest alpha in [0, 1] that has at least the target entropy, then raised as far as the repetition limit
    asks: entropy falls and repetition falls as alpha rises."""
    alpha = 0.0 if target_entropy is None else _last(lambda a: entropy(tempered(tokens, a)) >= target_entropy - 1e-12)
    if max_repeat is not None and repetition(tokens, tempered(tokens, alpha), budget) > max_repeat * (1 + 1e-9):
        low, high = alpha, 1.0
        for _ in range(STEPS):
            mid = (low + high) / 2
            low, high = (low, mid) if repetition(tokens, tempered(tokens, mid), budget) <= max_repeat else (mid, high)
        alpha = high
    return alpha


def _last(holds) -> float:
    low, high = 0.0, 1.0
    if holds(high):
        return high
    for _ in range(STEPS):
        mid = (low + high) / 2
        low, high = (mid, high) if holds(mid) else (low, mid)
    return low


@dataclass
class Plan:
    """alpha, weights and budgets (in tokens) by source. A source is a string; None stands for a null source."""

    alpha: float
    tokens: dict
    weights: dict
    budgets: dict


def plan(tokens: dict, target_entropy: float | None = None, max_repeat: float | None = None, budget: float | None = None) -> Plan:
    """budget None: the least with which every source is passed over at least once."""
    alpha = bisect_alpha(tokens, target_entropy, max_repeat, budget)
    weights = tempered(tokens, alpha)
    rates = [n / weights[s] for s, n in tokens.items() if n]
    whole = budget if budget is not None else max(rates, default=0.0)
    return Plan(alpha, tokens, weights, {s: round(whole * w) for s, w in weights.items()})


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeat: float | None = None, budget: float | None = None,
        seed: int = 0, id: str = "doc_id", source: str = "source", text: str = "text", tokens: Column | None = None) -> tuple[DataFrame, Plan]:
    """(docs with __tokens, __copies, __weight; the plan): __copies is how often a row is taken."""
    size = word_count(F.col(text)) if tokens is None else tokens
    key = [F.coalesce(F.col(source).cast("string"), F.lit("")), F.col(source).isNull()]
    order = F.xxhash64(F.lit(seed), F.col(id), F.col(text))
    sized = materialize(docs.select(key[0].alias("name"), key[1].alias("none"), size.alias("tokens"), order.alias("order")), "mix-sizes")
    sources = sized.groupBy("name", "none").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: mix groups of them")
    made = plan({(r["name"], r["none"]): r["tokens"] for r in sources}, target_entropy, max_repeat, budget)
    facts = []  # a source's blocks, whole passes, and what is left of its budget for one more pass
    for name, none, n, count in sources:
        passes, rest = divmod(made.budgets[name, none], n) if n else (1, 0)
        facts.append((name, none, min(MOST_BLOCKS, max(1, count // BLOCK_DOCS)), int(passes), int(rest), float(made.weights[name, none])))
    schema = "name string, none boolean, blocks int, passes bigint, rest bigint, weight double"
    facts = F.broadcast(docs.sparkSession.createDataFrame(facts, schema))  # MOST_SOURCES rows at most

    def places(own: str) -> list[Column]:
        """Where a row stands in the next pass: its block's turn, and its block."""
        block = F.pmod(F.xxhash64(F.col(f"{own}order"), F.lit("block")), F.col(f"{own}blocks"))
        turn = F.xxhash64(F.lit(seed), F.lit("epoch"), F.col(f"{own}passes"), F.col(f"{own}name"), block)
        return [turn.alias("turn"), block.alias("block")]

    placed = sized.join(facts, ["name", "none"]).where("rest > 0").select("name", "none", "tokens", "order", "rest", *places(""))
    sums = placed.groupBy("name", "none", "turn", "block", "rest").agg(F.sum("tokens").alias("size"))
    by_turn = Window.partitionBy("name", "none").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = sums.withColumn("before", F.sum("size").over(by_turn) - F.col("size")).where("before < rest")
    end = before.groupBy("name", "none").agg(F.max(F.struct("turn", "block", "before")).alias("end"))
    end = F.broadcast(materialize(end.select("name", "none", F.col("end.turn").alias("turn"), F.col("end.block").alias("block"), F.col("end.before").alias("before")), "mix-ends"))
    inside = placed.join(end, ["name", "none", "turn", "block"])
    by_order = Window.partitionBy("name", "none").orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # equal rows stand at one place; `many` of those at the last place are taken
    one = inside.groupBy("name", "none", "turn", "block", "order", "before", "rest").agg(F.sum("tokens").alias("size"), F.max("tokens").alias("tokens"))
    taken = one.withColumn("before", F.col("before") + F.sum("size").over(by_order) - F.col("size")).where("before < rest")
    many = F.coalesce(F.ceil(F.try_divide(F.col("rest") - F.col("before"), F.col("tokens"))), F.lit((1 << 63) - 1))
    cut = taken.groupBy("name", "none").agg(F.max(F.struct("turn", "block", "order", many.alias("many"))).alias("cut"))
    cut = materialize(facts.join(cut, ["name", "none"], "left"), "mix-cuts")
    cut = F.broadcast(cut.select(*[F.col(c).alias(f"__{c}") for c in cut.columns]))

    rows = docs.withColumns({"__name": key[0], "__none": key[1], "__order": order}).join(cut, ["__name", "__none"])
    here = F.struct(*places("__"), F.col("__order").alias("order"))
    last = F.struct("__cut.turn", "__cut.block", "__cut.order")
    at_cut = F.coalesce(F.col("__cut").isNotNull() & (here == last), F.lit(False))
    plain = rows.where(~at_cut).withColumn("__more", F.when(F.col("__cut").isNotNull() & (here < last), 1).otherwise(0))
    same = F.row_number().over(Window.partitionBy("__name", "__none").orderBy("__order"))  # few: rows equal to the last one
    edge = rows.where(at_cut).withColumn("__more", F.when(same <= F.col("__cut.many"), 1).otherwise(0))
    mixed = plain.unionByName(edge)
    return mixed.select(*docs.columns, size.alias("__tokens"), (F.col("__passes") + F.col("__more")).alias("__copies"), F.col("__weight")), made


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows as often as their copies say, without the columns of the mix."""
    own = [c for c in mixed.columns if c not in ("__tokens", "__copies", "__weight")]
    often = F.when(F.col("__copies") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))).otherwise(F.array().cast("array<bigint>"))
    return mixed.select(*own, F.explode(often).alias("__copy")).drop("__copy")
