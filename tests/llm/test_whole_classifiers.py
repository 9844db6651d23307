"""The whole of op9_quality and op3_toxicity against plain versions: held-out rows, features, fits, calibration, scores.

Of the operators the plain versions take hash numbers and the seeded order of steps as given, and for toxicity the boosted
trees, which test_plain_models.py holds against a plain search of its own.
"""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import queries, toxicity

ALL_BITS = (1 << 64) - 1
CLEAN = "the of tide over stone harbour evening quiet boats return with light wind and slow water under pale moon".split()
JUNK = "BUY now!!! cheap $$$ click here free 100% win WIN prize >>> offer ### deal".split()
RUDE = "gronk snarl gronking sn4rl grrronk".split()


def write(spark, folder, docs, labels, label):
    """Documents and labels as the queries read them; what an operator may not read says nothing true."""
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    df.repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, f"doc_id bigint, {label} int").write.parquet(f"{folder}/labels.parquet")


def crc(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def kind_of(byte):
    if byte < 32:
        return 0
    if byte > 126:
        return 5
    c = chr(byte)
    return 1 if c == " " else 2 if c.isdigit() else 3 if c.isupper() else 4 if c.islower() else 7 + byte % 8


def quality_features(text):
    words, raw = text.split(), text.encode()
    ids = [xxhash.xxh32_intdigest(w.encode()) for w in words]
    pairs = [(a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) & ALL_BITS for a, b in zip(ids, ids[1:])]
    kinds = [kind_of(b) for b in raw]
    fours = Counter(sum(k << 4 * j for j, k in enumerate(kinds[i : i + 4])) for i in range(len(kinds) - 3))
    shapes = [four * 16 + int(min(math.log2(1 + 2000 * n / len(raw)), 10)) for four, n in fours.items()]
    repeats = [int(len(set(ids)) / max(1, len(ids)) * 10), 20 + min(9, int(math.log2(len(ids) + 1)))]
    return {((v ^ 0xA5A5A5A5 * (i + 1)) * 0xD6E8FEB86659FD93 & ALL_BITS) >> 46 for i, part in enumerate((ids, pairs, shapes, repeats)) for v in part}


def plain_sigmoid(margins, labels, weights):
    """a and b of least weighted log loss with Platt's targets and the small penalty, each by bisection in turn."""
    pos, neg = (sum(w for w, y in zip(weights, labels) if y == k) for k in (1, 0))
    target = np.array([(pos + 1) / (pos + 2) if y else 1 / (neg + 2) for y in labels])
    z, w = np.array(margins) / np.std(margins), np.array(weights)

    def root(slope):
        low, high = -60.0, 60.0
        for _ in range(70):
            mid = (low + high) / 2
            low, high = (low, mid) if slope(mid) > 0 else (mid, high)
        return low

    off = lambda a, b: w * (1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))) - target)
    a = b = 0.0
    for _ in range(150):
        a = root(lambda v: (off(v, b) * z).sum() + 1e-3 * v)
        b = root(lambda v: off(a, v).sum() + 1e-3 * v)
    return a / np.std(margins), b


def plain_quality(docs, labels):
    told = dict(labels)
    fitted = [(i, quality_features(t or ""), told[i]) for i, t in sorted(docs) if told.get(i) in (0, 1) and crc(i, 4) != 2]
    learn, test = [x for n, x in enumerate(fitted) if n % 4 != 3], [x for n, x in enumerate(fitted) if n % 4 == 3]
    seen = {k: Counter(f for _, x, y in learn if y == k for f in x) for k in (0, 1)}
    whole = {k: sum(c.values()) + (1 << 18) for k, c in seen.items()}
    ratio = lambda f: math.log((seen[1][f] + 1) / whole[1]) - math.log((seen[0][f] + 1) / whole[0])
    share = {k: sum(y == k for *_, y in learn) / len(learn) for k in (0, 1)}
    values = [{f: ratio(f) / math.sqrt(len(x)) for f in x} for _, x, _ in learn]
    w, bias, alpha, rng = Counter(), 0.0, [0.0] * len(learn), np.random.default_rng(7)
    for _ in range(8):
        for i in rng.permutation(len(learn)):
            v, sign = values[i], 2 * learn[i][2] - 1
            slope = sign * (sum(w[f] * u for f, u in v.items()) + bias) - 1
            new = min(max(alpha[i] - slope / (sum(u * u for u in v.values()) + 1), 0.0), 0.05 / share[learn[i][2]])
            step, alpha[i] = (new - alpha[i]) * sign, new
            bias += step
            for f, u in v.items():
                w[f] += step * u
    margin = lambda x: sum(w[f] * ratio(f) for f in x) / math.sqrt(len(x)) + bias
    every = Counter(y for i, y in labels if crc(i, 4) != 2 and y in (0, 1))
    got = Counter(y for *_, y in fitted)
    weights = [every[y] / got[y] for *_, y in test]
    mean = sum(weights) / len(weights)
    a, b = plain_sigmoid([margin(x) for _, x, _ in test], [y for *_, y in test], [u / mean for u in weights])
    return {i: (crc(i, 4) == 2, 1 / (1 + math.exp(-max(-30, min(30, a * margin(quality_features(t or "")) + b))))) for i, t in docs}


def test_quality_query_is_the_plain_version(spark, tmp_path):
    rng = random.Random(21)
    docs, labels = [], []
    for i in range(220):
        good = rng.random() < 0.6
        text = " ".join(rng.choice(CLEAN if rng.random() < (0.85 if good else 0.35) else JUNK) for _ in range(rng.randrange(4, 40)))
        docs.append((i, text))
        if i % 9:  # some have no label, some a wrong one, and all that are held out a useless one
            labels.append((i, 1 if crc(i, 4) == 2 else int(good) ^ (i % 31 == 1)))
    docs += [(300, None), (301, ""), (302, "Ünï ß 日本語 x"), (303, "a"), (304, " \t ")]
    labels += [(900, 1), (901, 0), (902, 1)]  # of no document
    write(spark, tmp_path, docs, labels, "quality")
    got = {r.doc_id: r for r in queries.queries()["op9_quality"](spark, str(tmp_path)).collect()}
    want = plain_quality(docs, labels)
    assert set(got) == set(want)
    for i, (held, score) in want.items():
        assert got[i].held_out == held and got[i].score == pytest.approx(score, abs=2e-4), i
        if abs(score - 0.7) > 1e-3:
            assert got[i].predicted == (score >= 0.7)
    assert len({round(s, 3) for _, s in want.values()}) > 50


def undo(word):
    """(the word without outer marks and disguise, whether there was any)"""
    core = word.strip("\"'`.,;:!?()[]{}<>*_-~#%&").lower()
    drawn = any(a == b == c for a, b, c in zip(core, core[1:], core[2:]))
    if not core or core.isalpha() and not drawn:
        return core, False
    if sum(c.isalpha() for c in core) * 2 < len(core):
        return core, False
    leet = "".join(dict(zip("0134578@$!|", "oieastbasil")).get(c, c) for c in core)
    short = ""
    for n, c in enumerate(leet):
        length = 1
        while n >= length and leet[n - length] == c:
            length += 1
        ahead = 1
        while n + ahead < len(leet) and leet[n + ahead] == c:
            ahead += 1
        if length + ahead - 1 < 3 or length == 1:
            short += c
    found = "".join(c for c in short if c.isalpha())
    return found, drawn or found != core and not core.replace("-", "").replace("'", "").isalpha()


def with_spelled(words):
    """The words, and those that are spelled by single letters."""
    out, run = list(words), ""
    for w in [*words, "--"]:
        if len(w) == 1 and w.isalpha():
            run += w
        else:
            out += [run] if len(run) > 2 else []
            run = ""
    return out


def toxic_tokens(text):
    plain = {undo(w)[0] for w in with_spelled(text.split())} - {""}
    return plain | {"^" + w[:5] for w in plain if len(w) > 5}


def toxic_features(text, odds):
    words = with_spelled(text.split())
    if not words:
        return [0.0] * 23
    plain = [undo(w) for w in words]
    word = [odds.get(p, 0.0) for p, _ in plain]
    stem = [odds.get("^" + p[:5], 0.0) if len(p) > 5 else 0.0 for p, _ in plain]
    best = sorted(map(max, word, stem), reverse=True)
    hits = [i for i, v in enumerate(word) if v > 1]
    you = [i for i, (p, _) in enumerate(plain) if p in toxicity.SECOND_PERSON]
    gap = min((abs(i - j) for i in hits for j in you), default=99)
    n, stems, letters = len(words), sum(v > 1 for v in stem), sum(c.isalpha() for c in text) or 1
    hidden = [h for _, h in plain]
    return [
        best[0], sum(best[:2]), sum(best[:5]), math.log1p(len(hits)), len(hits) / n, sum(word) / n,
        math.log1p(stems), stems / n, sum(stem) / n, max(stem), max(word), len({word[i] for i in hits}),
        min(gap, 99), float(gap <= 6), len(you) / n, sum(len(w) > 1 and w.isupper() for w in words) / n, sum(c.isupper() for c in text) / letters,
        text.count("!") / n, text.count("?") / n, sum(c in "*#$%&@" for c in text) / n,
        sum(hidden) / n, sum(h and max(a, b) > 1 for h, a, b in zip(hidden, word, stem)), math.log1p(n),
    ]


def plain_toxicity(spark, docs, labels):
    told = {i: y for i, y in labels if crc(i, 5)}
    ids = spark.createDataFrame([(i,) for i, _ in docs], "doc_id bigint")
    part = dict(ids.select("doc_id", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(10))).collect())
    known = [(i, t or "", told[i]) for i, t in sorted(docs) if told.get(i) in (0, 1)]
    first = [(toxic_tokens(t), y) for i, t, y in known if part[i] < 5]
    pos = sum(y for _, y in first)
    count = {k: Counter(t for x, y in first if y == k for t in x) for k in (0, 1)}
    odds = {t: math.log((count[1][t] + 0.5) / (pos + 1)) - math.log((count[0][t] + 0.5) / (len(first) - pos + 1)) for t in count[0] | count[1] if count[0][t] + count[1][t] >= 5}
    odds = {t: v for t, v in odds.items() if v > 1}
    middle, last = ([(toxic_features(t, odds), y) for i, t, y in known if low <= part[i] < high] for low, high in ((5, 8), (8, 10)))
    trees = toxicity.boost(np.array([x for x, _ in middle]), np.array([float(y) for _, y in middle]))
    every = Counter(told.values())
    sizes = Counter(y for _, y in last)
    at = trees.margins(np.array([x for x, _ in last]))
    steps = sorted({m: None for m in at})
    weight = {m: sum(every[y] / sizes[y] for a, (_, y) in zip(at, last) if a == m) for m in steps}
    ones = {m: sum(every[1] / sizes[1] for a, (_, y) in zip(at, last) if a == m and y) for m in steps}
    level = []  # the least, over later ends, of the greatest share, over earlier starts
    for k in range(len(steps)):
        share = lambda a, b: sum(ones[m] for m in steps[a : b + 1]) / sum(weight[m] for m in steps[a : b + 1])
        level.append(min(max(share(a, b) for a in range(k + 1)) for b in range(k, len(steps))))
    out = {}
    for i, t in docs:
        m = float(trees.margins(np.array([toxic_features(t or "", odds)]))[0])
        out[i] = crc(i, 5) == 0, min(1, max(0, np.interp(m, steps, level) + 1e-6 * math.tanh(m)))
    return odds, out


def test_toxicity_query_is_the_plain_version(spark, tmp_path):
    rng = random.Random(22)
    docs, labels = [], []
    for i in range(400):
        rude = rng.random() < 0.4
        words = [rng.choice(CLEAN) for _ in range(rng.randrange(5, 40))]
        if rude or rng.random() < 0.1:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(["you", "YOUR", "we"]), rng.choice([*RUDE, "g r o n k", "GRONK!!", "snarlish"])]
        docs.append((i, " ".join(words) + rng.choice(["", "!", " ??", " #$@"])))
        if i % 11:
            labels.append((i, 0 if crc(i, 5) == 0 else int(rude)))
    docs += [(500, None), (501, ""), (502, "Ünï ß 日本語 x1x"), (503, "a b c d"), (504, " \t "), (505, "n1ce-w0rd it's 'quoted' 12345 aaa ab1")]
    labels += [(900, 1), (901, 0)]
    write(spark, tmp_path, docs, labels, "toxic")
    got = {r.doc_id: r for r in queries.queries()["op3_toxicity"](spark, str(tmp_path)).collect()}
    odds, want = plain_toxicity(spark, docs, labels)
    assert {"gronk", "snarl", "you"} & set(odds) >= {"gronk", "snarl"}
    assert set(got) == set(want)
    for i, (held, score) in want.items():
        assert got[i].held_out == held and got[i].score == pytest.approx(score, abs=1e-6), i
        assert got[i].predicted == (got[i].score >= 0.5)
    assert len({round(s, 3) for _, s in want.values()}) > 5
