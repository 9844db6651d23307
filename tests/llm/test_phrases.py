"""Collocations against plain counting, and their parts."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from helpers import AWKWARD, awkward

from tidemark.llm import phrases


def plain(rows, least, best=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    out = {}
    for (lang, p), a in frequent.items():
        score, cut = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        longer = [b for (other, x), b in frequent.items() if other == lang and len(x) > len(p) and any(x[i : i + len(p)] == p for i in range(len(x)))]
        if not any(100 * b >= 80 * a for b in longer):
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:cut]], f[lang, p[cut:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:best], 1))


def texts(rng, n):
    common = [f"w{i}" for i in range(60)]
    fixed = ["New York city", "in order to", "straße é 日本", "as well as the", "a a a", "a\tb"]
    for _ in range(n):
        said = []
        for _ in range(rng.randrange(40)):
            said.append(rng.choice(fixed) if rng.random() < 0.3 else common[min(int(rng.expovariate(0.1)), 59)] + rng.choice(["", "", "", ",", "\n", ". "]))
        yield " ".join(said), rng.choice(["en", "de", None, "und"])


@pytest.mark.parametrize("together", [50, 2_000_000])
@pytest.mark.parametrize("tile", [4, 1024])
def test_matches_plain_counting(spark, monkeypatch, together, tile):
    monkeypatch.setattr(phrases, "WORDS_TOGETHER", together)
    monkeypatch.setattr(phrases, "TILE", tile)
    rows = list(texts(random.Random(8), 400))
    df = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(map(tuple, phrases.collocations(df, min_count=8, best=40).collect()))
    want = plain(rows, 8, 40)
    assert got == want and len(want) > 60


@pytest.mark.parametrize("tile", [2, 8, 1024])
def test_tiles_count_all_pairs(tile):
    rng = np.random.default_rng(3)
    for size in (0, 1, 5000):
        left, right = (np.minimum(rng.exponential(8, size).astype(int), 99) for _ in range(2))
        a, b, n = phrases.count_pairs(left, right, tile)
        assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == Counter(zip(left.tolist(), right.tolist(), strict=True))
        assert len(a) == len(set(zip(a.tolist(), b.tolist(), strict=True)))


def test_full_bitmap_costs_work_only(spark, monkeypatch):
    """Where every bit is set, all phrases are counted, and the result is the same."""
    monkeypatch.setattr(phrases, "bitmap_of", lambda found, n: b"\xff" * 1024)
    rows = list(texts(random.Random(9), 150))
    got = sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, "text string, lang string"), min_count=6).collect()))
    assert got == plain(rows, 6)


def test_bitmap_holds_every_phrase(spark):
    rows = [("en", f"a{i} b{i % 7}") for i in range(3000)]
    bitmap = np.frombuffer(phrases.bitmap_of(spark.createDataFrame(rows, "lang string, phrase string"), len(rows)), np.uint8)
    a, b = (np.array([phrases.word_hash("en", p.split()[i].encode()) for _, p in rows], np.uint64) for i in (0, 1))
    assert phrases.holds(bitmap, phrases._mixed(a, b)).all()
    assert phrases.holds(bitmap, phrases._mixed(b, a)).mean() < 0.05


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [("en", 1, "a", 9_000_000_000_000_000_001), ("en", 1, "b", 9_000_000_000_000_000_003), ("en", 2, "a b", 8_999_999_999_999_999_999)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, k int, phrase string, n bigint")).first()
    assert got["score"] == 2_000_000 * 8_999_999_999_999_999_999 // 18_000_000_000_000_000_004 and isinstance(got["score"], int)
    assert Decimal(got["score"]) == 999_999


def test_awkward_rows(spark):
    assert sorted(map(tuple, phrases.collocations(awkward(spark), min_count=2).collect())) == plain([(t, lang) for _, t, lang in AWKWARD], 2)
    assert phrases.collocations(awkward(spark, []), min_count=2).collect() == []
    rng = random.Random(1)
    long = " ".join(f"v{rng.randrange(3000)}" for _ in range(400_000)) + " " + "x" * 1_000_000  # two varied megabytes and a huge word
    got = sorted(map(tuple, phrases.collocations(spark.createDataFrame([(long, "en"), (None, None)], "text string, lang string"), min_count=3).collect()))
    assert got == plain([(long, "en")], 3)
