import random
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, awkward
from pyspark.sql import functions as F

from tidemark.llm import suffix_dedup
from tidemark.llm.common import materialize


def plain(docs):
    """(doc_id, n_bytes, n_removed, n_spans, kept) by counting every string of LENGTH bytes."""
    raws = [(i, (t or "").encode()) for i, t, *_ in docs]
    size = suffix_dedup.LENGTH
    count = Counter(b[p : p + size] for _, b in raws for p in range(len(b) - size + 1))
    out = []
    for i, b in raws:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - size + 1):
            if count[b[p : p + size]] > 1:
                gone[p : p + size] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéü") for _ in range(rng.randrange(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (30, 45, 80, 120)]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(5, 60)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 2)
            parts.insert(rng.randrange(len(parts) + 1), p[a : a + rng.randrange(150, 500)])
        docs.append((i, " ".join(parts)))
    docs += [(100 + i, docs[i][1]) for i in range(5)] + [(200 + i, docs[i][1][: len(docs[i][1]) // 2] + "#" + docs[i][1][len(docs[i][1]) // 2 :]) for i in range(8)]
    docs += [(300, "ab" * 400), (301, "ab" * 150), (302, "x" * 199), (303, "y" * 200), (304, "y" * 200), (305, "z" * 201), (306, text(20) + " " + passages[3]), (7, docs[7][1])]
    return docs


@pytest.mark.parametrize(("groups", "part", "at_once"), [(4096, 1 << 20, 4000), (2, 3000, 7), (12, 3000, 50)])
def test_repeats_match_plain_counting(spark, monkeypatch, groups, part, at_once):
    monkeypatch.setattr(suffix_dedup, "GROUP_RUNS", groups)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    monkeypatch.setattr(suffix_dedup, "SORTED_RUNS", at_once)
    for seed in (1, 2):
        docs = corpus(seed)
        df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id bigint, text string, mark int, start int, key int")
        got = suffix_dedup.remove_repeats(df.repartition(5)).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == plain(docs)


def test_strings_with_equal_hashes_are_told_apart(spark):
    docs = corpus(1)[:40] + corpus(1)[60:]
    df = spark.createDataFrame([(i, n, t) for n, (i, t) in enumerate(docs)], "doc_id bigint, mark bigint, text string")
    found = suffix_dedup.runs(df)
    ranges = lambda x: {(r.doc_id, r.mark, s) for r in x.collect() for s in range(r.start, r.start + r.n)}
    want = ranges(suffix_dedup.repeats(df))
    blind = found.withColumn("ctx", F.lit(0).cast("bigint")).withColumn("alt", F.lit(0).cast("bigint"))
    half = found.withColumn("ctx", F.col("ctx") % 2).withColumn("alt", F.lit(0).cast("bigint"))
    assert want and all(ranges(suffix_dedup.settle(df, materialize(x, "suffix-runs"))) == want for x in (blind, half))


def test_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] != 7] + [(7, "word " * 300, "en")]
    got = suffix_dedup.remove_repeats(awkward(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == plain(rows)
    assert suffix_dedup.remove_repeats(awkward(spark, [])).count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage, start, middle, end = text(60), text(500_000), text(300_000), text(10)
    rows = [(1, f"{start}1{passage}2{middle}3{passage}4{end}"), (2, f"{end}/{passage}/"), (3, "ab" * 1_500_000), (4, None)]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert bytes(got[1].kept).decode() == f"{start}12{middle}34{end}" and (got[1].n_spans, got[1].n_removed) == (2, 2 * len(passage))
    assert bytes(got[2].kept).decode() == f"{end}//" and got[3].n_removed == 3_000_000 and got[4].n_bytes == 0


def test_a_passage_in_very_many_contexts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_RUNS", 20)
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcd") for _ in range(4)) for _ in range(n))
    passage = text(70)
    docs = [(i, text(rng.randrange(45)) + passage[rng.randrange(30) : 350 - rng.randrange(90)] + text(rng.randrange(45))) for i in range(400)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == plain(docs)


def test_suffixes_are_sorted_within_segments():
    rng = np.random.default_rng(3)
    raw = np.concatenate([rng.integers(97, 99, 3000).astype(np.uint8)] * 2 + [np.zeros(200, np.uint8)])
    starts = rng.permutation(6000)[:500]
    segment = np.sort(rng.integers(0, 9, 500))
    hashes = suffix_dedup.PrefixHashes(raw)
    order = suffix_dedup.sort_suffixes(raw, hashes, starts, segment)
    key = lambda i: (segment[i], raw[starts[i] : starts[i] + suffix_dedup.LENGTH].tobytes())
    assert [key(i) for i in order] == sorted(map(key, range(500)))
    same = suffix_dedup.common_extension(hashes, starts[:-1], starts[1:])
    for i, n in enumerate(same):
        a, b = (raw[s : s + suffix_dedup.LENGTH] for s in starts[i : i + 2])
        assert n == (np.argmin(a == b) if (a != b).any() else suffix_dedup.LENGTH)
    classes = suffix_dedup.repeated_starts(raw, starts, segment)
    assert all((classes[i] == classes[j]) == (key(i) == key(j)) for i in range(0, 500, 7) for j in range(0, 500, 11))
