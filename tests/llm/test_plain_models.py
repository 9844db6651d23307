"""Mixing and the models against plain versions that share no code with them beyond the hashes they are given."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_models import PLAIN, labelled, rows, texts_of

from tidemark.llm import features, language, mixing, quality, toxicity


def plain_alpha(tokens, limit):
    """The smallest exponent of a fine grid at which the most repeated source is passed over `limit` times at most."""
    total = sum(tokens.values())
    for step in range(100_001):
        raw = {s: (n / total) ** (step / 100_000) for s, n in tokens.items() if n}
        rates = [x / tokens[s] for s, x in raw.items()]
        if max(rates) / min(rates) <= limit:
            return step / 100_000


@pytest.mark.parametrize("seed", [0, 3])
def test_mixing_walks_the_permutations(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    rng = random.Random(seed)
    data = [(i, " ".join(["w"] * rng.randrange(1, 30)), rng.choice("aaaaaaabbc") if i % 11 else None) for i in range(1500)]
    data += [(7, "w w w", "b")] * 40 + [(None, None, "c"), (2000, "", "a")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    mixed, plan = mixing.mix(df, max_repeat=2.5, seed=seed)

    tokens = Counter()
    for _, text, source in data:
        tokens[source] += len((text or "").split())
    alpha = plain_alpha(tokens, 2.5)
    assert abs(plan.alpha - alpha) < 1e-4
    raw = {s: (n / sum(tokens.values())) ** plan.alpha for s, n in tokens.items()}
    weights = {s: x / sum(raw.values()) for s, x in raw.items()}
    whole = max(n / weights[s] for s, n in tokens.items())
    budgets = {s: round(whole * w) for s, w in weights.items()}
    assert plan.budgets == {(s or "", s is None): b for s, b in budgets.items()}

    sizes = Counter(source for _, _, source in data)
    facts = [(s, max(1, sizes[s] // 16), budgets[s] // tokens[s]) for s in sizes]
    facts = spark.createDataFrame(facts, "s string, blocks int, passes bigint")
    order = F.xxhash64(F.lit(seed), "doc_id", "text")
    hashed = df.join(facts, F.col("source").eqNullSafe(F.col("s"))).withColumn("order", order)
    hashed = hashed.withColumn("block", F.pmod(F.xxhash64("order", F.lit("block")), F.col("blocks")))
    hashed = hashed.withColumn("turn", F.xxhash64(F.lit(seed), F.lit("epoch"), "passes", F.coalesce("s", F.lit("")), "block"))
    by_source = defaultdict(list)
    for r in hashed.collect():
        by_source[r.source].append(r)
    want = Counter()
    for s, held in by_source.items():
        left = budgets[s] - (budgets[s] // tokens[s]) * tokens[s]
        for r in sorted(held, key=lambda r: (r.turn, r.block, r.order)):
            want[r.doc_id, r.text, s, budgets[s] // tokens[s] + (left > 0)] += 1
            left -= len((r.text or "").split())
    assert Counter((r.doc_id, r.text, r.source, r["__copies"]) for r in mixed.collect()) == want


def test_isotonic_is_the_min_max_formula():
    rng = np.random.default_rng(1)
    for _ in range(20):
        x, y, w = rng.integers(0, 12, 40).astype(float), rng.integers(0, 2, 40), rng.integers(1, 4, 40).astype(float)
        at = np.unique(x)
        mean = lambda a, b: (w * y)[(x >= a) & (x <= b)].sum() / w[(x >= a) & (x <= b)].sum()
        want = [max(min(mean(a, b) for b in at if b >= v) for a in at if a <= v) for v in at]
        assert np.allclose(np.interp(at, *features.isotonic(x, y, w)), want)


def walked(trees, row):
    total = trees.base
    for feature, cut, value in trees.nodes:
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
        total += value[node - len(feature)]
    return total


def test_trees_take_the_best_splits():
    """Stumps on few distinct values: every split is tried by plain sums, round by round."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (300, 4)).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 1] - 2.5 + (x[:, 3] > 3))))).astype(float)
    made = toxicity.boost(x, y, rounds=15, depth=1)
    margin = np.full(300, math.log(y.mean() / (1 - y.mean())))
    for feature, cut, value in made.nodes:
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        part = lambda at: g[at].sum() ** 2 / (h[at].sum() + 1)  # noqa: B023, E731
        gains = {(j, c): part(x[:, j] <= c) + part(x[:, j] > c) for j in range(4) for c in range(5)}
        right = x[:, feature[0]] > cut[0]
        assert part(~right) + part(right) >= max(gains.values()) - 1e-9
        for side, at in enumerate((~right, right)):
            assert abs(value[side] - 0.1 * g[at].sum() / (h[at].sum() + 1)) < 1e-9
        margin = margin + value[right.astype(int)]
    deep = toxicity.boost(x, y, rounds=10, depth=3)
    assert np.allclose(deep.margins(x), [walked(deep, r) for r in x])
    loss = lambda m: np.mean(np.log1p(np.exp(-np.where(y == 1, m, -m))))
    assert loss(deep.margins(x)) < loss(np.full(300, deep.base))


def test_lexicon_has_the_log_odds_of_counts(spark):
    good, bad = texts_of(PLAIN, 40, 1, 12), [t + rng for t, rng in zip(texts_of(PLAIN, 30, 2, 12), [" gronk", " sn4rl you", " gronk GRONK!!"] * 10, strict=True)]
    df = labelled(spark, bad, good)
    got = toxicity.learn_lexicon(df, "label", "text").weights
    seen, pos = Counter(), Counter()
    for text, y in [(t, 1) for t in bad] + [(t, 0) for t in good]:
        for token in toxicity.tokens(text):
            seen[token] += 1
            pos[token] += y
    want = {}
    for token, n in seen.items():
        odds = math.log((pos[token] + 0.5) / (len(bad) + 1)) - math.log((n - pos[token] + 0.5) / (len(good) + 1))
        if n >= toxicity.LEAST_DOCS and odds > 1:
            want[token] = odds
    assert {"gronk", "snarl"} <= set(want) and got == pytest.approx(want)


def test_hinge_loss_reaches_the_least_of_the_dual():
    """Against projected gradient ascent on the dense dual, run until its own duality gap is closed."""
    rng = np.random.default_rng(3)
    rows_ = [np.unique(rng.integers(0, 30, rng.integers(3, 10))).astype(np.int32) for _ in range(80)]
    y = np.array([1 if 3 in x or rng.random() < 0.3 else -1 for x in rows_])
    r, cost = rng.normal(size=30), np.where(y == 1, 0.5, 0.8)
    w, bias = quality.dual_coordinate_descent(rows_, y, r, cost, 400, 1)
    dense = np.zeros((80, 31))
    for i, x in enumerate(rows_):
        dense[i, x] = r[x] / math.sqrt(len(x))
        dense[i, 30] = 1
    signed = dense * y[:, None]
    gram, alpha = signed @ signed.T, np.zeros(80)
    rate = 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(20_000):
        alpha = np.clip(alpha + rate * (1 - gram @ alpha), 0, cost)
    best = signed.T @ alpha
    primal = lambda v: 0.5 * v @ v + (cost * np.maximum(0, 1 - signed @ v)).sum()
    assert primal(best) - (alpha.sum() - 0.5 * alpha @ gram @ alpha) < 1e-3
    own = np.append(w / np.where(r == 0, 1, r), bias)
    assert primal(own) < primal(best) + 1e-3
    assert np.allclose(own, best, atol=2e-2)


def test_ratios_and_margins_are_plain_sums():
    good, bad = texts_of(PLAIN, 20, 4), [t.upper() for t in texts_of(PLAIN, 10, 5)]
    held = [quality.features(t) for t in good + bad]
    y = np.array([1] * 20 + [0] * 10)
    r = quality.log_count_ratios(held, y)
    counts = {k: Counter(int(f) for x, label in zip(held, y, strict=True) if label == k for f in x) for k in (0, 1)}
    whole = {k: sum(counts[k].values()) + (1 << quality.BITS) for k in (0, 1)}
    for f in set(counts[0]) | set(counts[1]):
        assert abs(r[f] - math.log((counts[1][f] + 1) / whole[1] * whole[0] / (counts[0][f] + 1))) < 1e-9
    model = quality.Quality(r, 0.25, 2.0, -1.0)
    for text, score in zip(good + bad + [""], model.scores(good + bad + [""]), strict=True):
        x = quality.features(text)
        margin = sum(r[f] for f in x) / math.sqrt(len(x)) + 0.25 if len(x) else 0.25
        assert abs(score - 1 / (1 + math.exp(-max(-30, min(30, 2 * margin - 1))))) < 1e-9


def grams(text):
    plain = " " + "".join(c if not c.isascii() or c.isalpha() else " " for c in text.lower()) + " "
    return {plain[i : i + n] for n in language.SIZES for i in range(len(plain) - n + 1)}


def test_languages_match_the_unhashed_kernel(spark):
    kinds = {"aa": "ka ta ma pa ra".split(), "bb": "sch ung ein ver lich".split(), "cc": "eau tion mént oi aïs".split()}
    rng = random.Random(5)
    mixed = lambda k: " ".join("".join(rng.choice(kinds[k] if rng.random() < 0.8 else kinds["aa"]) for _ in range(3)) for _ in range(25))
    data = [(i, mixed(k) + ", 12!", k) for i, k in enumerate(sorted(kinds) * 30)]
    model = language.fit(spark.createDataFrame(data, "doc_id bigint, text string, lang string"))
    sets = [grams(t) for _, t, _ in data]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    names = sorted(kinds)
    each = -(-language.LANDMARKS // len(names))
    marks = [sets[i] for k in names for i in [i for i, _, lang in data if lang == k][:each]]
    mm = np.array([[kernel(a, b) for b in marks] for a in marks])
    km = np.array([[kernel(a, b) for b in marks] for a in sets])
    target = np.array([[1.0 if lang == k else -1.0 for k in names] for _, _, lang in data])
    per = 1 / 30
    ridge = 1e-2 * per * np.trace(km @ np.linalg.pinv(mm) @ km.T) / len(marks)
    a = np.linalg.lstsq(km.T @ km * per + ridge * mm, km.T @ target * per, rcond=None)[0]  # ridge regression in the landmarks' span

    fresh = [mixed(k) for k in sorted(kinds) * 10] + ["ka", "sch oi"]
    z = 8 * np.array([[kernel(grams(t), m) for m in marks] for t in fresh]) @ a
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    got = model.predict(fresh)
    assert list(got["lang_pred"]) == [names[i] for i in z.argmax(1)]
    assert np.abs(got["score"] - p.max(1)).max() < 0.05


def test_the_language_query_leaves_held_out_labels_alone(spark, tmp_path):
    """What is held out may say anything: predictions do not change."""
    from tidemark.llm import queries

    kinds = {"aa": "ka ta ma pa ra".split(), "bb": "sch ung ein ver lich".split()}
    rng = random.Random(9)
    data = [(i, " ".join("".join(rng.choice(kinds[k]) for _ in range(3)) for _ in range(20)), k) for i, k in enumerate(sorted(kinds) * 60)]
    found = []
    for name in ("told", "lied"):
        held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
        df = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
        df = df if name == "told" else df.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
        df.withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = queries.queries()["op8_language"](spark, f"{tmp_path}/{name}")
        assert got.where("held_out").count() > 10
        found.append(sorted(rows(got.select("doc_id", "held_out", "lang_pred", F.round("score", 9)))))
    assert found[0] == found[1]
