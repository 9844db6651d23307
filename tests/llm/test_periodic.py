"""Runs against a search of all periods, and the query against a plain version of its contract."""

import hashlib
import random
import re
import zlib

from helpers import AWKWARD, awkward

from tidemark.llm import periodic
from tidemark.llm.queries import op12_periodic


def plain_runs(w):
    """Every (start, length, period): a stretch of agreeing places of each lag, kept if no smaller period fits."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found)


def collapsed(w, runs):
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts(rng):
    for _ in range(300):
        letters = "ab" if rng.random() < 0.5 else "abcdef"
        w = []
        while len(w) < rng.randrange(1, 160):
            unit = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
            w += unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit) + 1)]
        yield " ".join(w)


def test_runs_match_a_search_of_all_periods(spark):
    said = list(texts(random.Random(3)))
    df = spark.createDataFrame(list(enumerate(said)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(df).collect()}
    several = 0
    for i, text in enumerate(said):
        w = words(text)
        want = plain_runs(w)
        several += len(want) > 1
        assert [tuple(x) for x in got[i]["runs"]] == want
        assert got[i]["collapsed"] == " ".join(collapsed(w, want)) and got[i]["n_words"] == len(w)
    assert several > 50


def test_long_periods_and_long_texts(spark):
    rng = random.Random(4)
    unit = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]  # a period that no single gram of few words shows
    noise = [f"x{rng.randrange(10**9)}" for _ in range(300_000)]  # several megabytes of varied words
    small = ["a", "b", "a", "c"] * 500
    rows = [(1, " ".join(noise[:1000] + unit * 4 + unit[:77] + noise[1000:])), (2, " ".join(unit * 3 + unit[:19_999])), (3, " ".join(small + unit[:100] + ["z"] * 6 + unit[:5] + ["y"] * 5))]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: [(1000, 80_077, 20_000)], 2: [], 3: [(0, 2000, 4), (2100, 6, 1)]}


def test_awkward_rows(spark):
    got = sorted((repr(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(awkward(spark)).collect())
    want = []
    for i, text, _ in AWKWARD:
        w = words(text)
        runs = [(0, 30_000, 1)] if len(w) == 30_000 else plain_runs(w)
        want.append((repr(i), len(w), runs, " ".join(collapsed(w, runs))))
    assert got == sorted(want)
    assert periodic.periodic_runs(awkward(spark, [])).collect() == []


def contract(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    start, length, period = best

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    return (doc_id, len(runs), start, length, period, None if length is None else 1000 * length // period,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(collapsed(w, runs))))


def test_query_matches_its_contract(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefghijk") + str(rng.randrange(20)) for _ in range(rng.randrange(0, 200)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "a b c d"), (1002, "x x x x x x x")] + [(5000 + i, t) for i, t in enumerate(texts(rng)) if i < 60]
    spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_periodic(spark, str(tmp_path)).collect()), key=repr)
    want = sorted((contract(i, t) for i, t in rows), key=repr)
    assert got == want and sum(r[1] > 0 for r in want) > 40
