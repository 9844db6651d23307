
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, awkward
from pyspark.sql import functions as F

from tidemark.llm import components, decontamination, line_dedup, simhash


def rows(df):
    return [tuple(r) for r in df.collect()]


def roots(edges, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(400, x) for x in range(401, 450)]
    found = dict(rows(components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    want = roots(edges, {x for e in edges for x in e if e[0] != e[1]} | {0} & set())
    assert found == {n: r for n, r in want.items()}
    assert rows(components.connected_components(spark.createDataFrame([], "a bigint, b bigint"))) == []


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) > k else [" ".join(w)] if w else []


def plain_fingerprint(text, k=3):
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, k)]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs)) if hs else 0


def test_fingerprints_match_the_definition(spark):
    got = simhash.fingerprints(awkward(spark), 3).select("doc_id", simhash.as_hex(F.col("fp"))).collect()
    assert Counter(map(tuple, got)) == Counter((i, f"{plain_fingerprint(t):016x}") for i, t, _ in AWKWARD)


@pytest.mark.parametrize(("join_up_to", "bits"), [(0, 2), (32, 2), (0, 4), (32, 4), (0, 6)])
def test_links_lose_no_close_pair(spark, monkeypatch, join_up_to, bits):
    monkeypatch.setattr(simhash, "JOIN_UP_TO", join_up_to)
    rng = random.Random(2)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(rng.choice((1, 3, 40))):
            turned = x
            for bit in rng.sample(range(64), bits):
                turned ^= 1 << bit
            fps |= {x, turned}
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = rows(simhash.link_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp bigint"), bits))
    close = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits]
    assert set(map(tuple, map(sorted, got))) <= set(close)
    assert roots(got, fps) == roots(close, fps)


def test_near_duplicates_of_awkward_rows(spark):
    got = simhash.near_duplicates(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r.component_id for r in got}
    assert by[1] == by[8] == 1 and by[3] == by[4] == by[5] == 3
    assert simhash.near_duplicates(awkward(spark, [])).count() == 0


def test_near_copies_find_edited_texts_and_leave_others(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    docs, copies = [], []
    for i in range(60):
        w = [word() for _ in range(220)]
        docs.append((i, " ".join(w)))
        edited = list(w)
        for at in rng.sample(range(220), 3):
            edited[at] = word()
        copies.append((1000 + i, " ".join(edited)))
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(docs + copies, "doc_id bigint, text string")).collect()}
    assert sum(got[1000 + i] == i for i in range(60)) >= 58
    assert all(got[i] == i for i in range(60))
    kept = simhash.keep_one(awkward(spark), simhash.near_copies(awkward(spark)))
    assert kept.columns == awkward(spark).columns and {r.doc_id for r in kept.collect()} >= {1, 3, 7, 9}


def plain_lines(docs, least):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    count = Counter(k for _, t, *_ in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t, *_ in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup_matches_plain_counts(spark):
    docs = awkward(spark)
    assert Counter(rows(line_dedup.LineDedup.build(docs, 3).apply(docs))) == plain_lines(AWKWARD, 3)
    assert line_dedup.LineDedup.build(awkward(spark, []), 3).apply(awkward(spark, [])).count() == 0


@pytest.mark.parametrize("room", [line_dedup.PROBE_BYTES, -1])
def test_lines_of_documents_that_were_not_counted(spark, monkeypatch, room):
    """With filters in every task and, where they are too large for that, with none; among the texts one of nearly 5 MB of varied lines."""
    monkeypatch.setattr(line_dedup, "PROBE_BYTES", room)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 20)
    rng = random.Random(11)
    schema = "doc_id string, text string"
    some = lambda n: "\n".join(f" Line {int(rng.paretovariate(0.4)) % 9000}\t" for _ in range(n))
    counted = [(str(i), some(30)) for i in range(120)]
    others = [("x", some(500_000)), (None, some(5)), (None, some(5)), ("y", None), ("z", ""), ("z", "line 1\n\nLINE 1")]
    state = line_dedup.LineDedup.build(spark.createDataFrame(counted, schema), 4)
    assert state.shards > 20 and len(others[0][1]) > 4_000_000
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    held = Counter(k for _, t in counted for k in {key(x) for x in t.split("\n")} if k)
    want = Counter()
    for i, t in others:
        lines = (t or "").split("\n")
        kept = [x for x in lines if held[key(x)] < 4]
        want[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    got = spark.createDataFrame(others, schema)
    assert Counter(rows(state.apply(got))) == want
    if room > 0:  # nearly all lines that are not frequent are ruled out before they are rows
        asked = line_dedup.likely_lines(got.withColumn("mark", F.lit(0).cast("long")), state.filters, state.shards).count()
        assert 0 <= asked - sum(n * c for (_, _, n, _), c in want.items()) < 0.02 * 500_000


def test_line_dedup_is_reversible(spark):
    more = [(100 + i, "omega\nonly here %d" % i, "en") for i in range(4)]
    old, new = awkward(spark), awkward(spark, more)
    first = line_dedup.LineDedup.build(old, 3)
    second = first.insert(new)
    both = old.unionByName(new)
    assert Counter(rows(second.apply(both))) == plain_lines(AWKWARD + more, 3)
    third = second.delete(new)
    assert Counter(rows(third.apply(old))) == plain_lines(AWKWARD, 3)
    assert Counter(rows(third.counts)) == Counter(rows(first.counts))


def test_an_insertion_far_beyond_the_first_build(spark):
    make = lambda a, b: spark.createDataFrame([(i, f"line {i % 400}\nother {i}", "en") for i in range(a, b)], "doc_id bigint, text string, lang string")
    first = line_dedup.LineDedup.build(make(0, 430), 2)
    grown = first.insert(make(430, 4000))
    all_docs = make(0, 4000)
    assert Counter(rows(grown.apply(all_docs))) == plain_lines([tuple(r) for r in all_docs.collect()], 2)
    assert Counter(rows(grown.delete(make(430, 4000)).apply(make(0, 430)))) == plain_lines([tuple(r) for r in make(0, 430).collect()], 2)


def test_cuckoo_filter_keeps_and_forgets():
    rng = np.random.default_rng(4)
    h = rng.integers(-(2**63), 2**63, (4000, 2), dtype=np.int64)
    held = line_dedup.CuckooFilter(2000)
    assert held.insert(h[:2000, 0], h[:2000, 1])
    assert held.contains(h[:2000, 0], h[:2000, 1]).all()
    assert held.contains(h[2000:, 0], h[2000:, 1]).mean() < 0.01
    held.delete(h[:1000, 0], h[:1000, 1])
    assert held.contains(h[1000:2000, 0], h[1000:2000, 1]).all()
    assert held.contains(h[:1000, 0], h[:1000, 1]).mean() < 0.01


def plain_hits(docs, items, window=10):
    split = lambda t: [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    out = []
    for i, t, *_ in docs:
        w, hit, ids = split(t), set(), set()
        for item, it in items:
            iw = split(it)
            for win in {tuple(iw[j : j + window]) for j in range(max(1, len(iw) - window + 1))} if iw else ():
                for p in range(len(w) - len(win) + 1):
                    if tuple(w[p : p + len(win)]) == win:
                        hit |= set(range(p, p + len(win)))
                        ids.add(str(item))
        out.append((i, len(w), len(hit), tuple(sorted(ids))))
    return Counter(out)


def test_decontamination_matches_plain_search(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("ab cd ef gh ij kl mn 7 ñu éa Ab-c".split())
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.choice((1, 2, 3, 9, 10, 14)))) for i in range(25)] + [(30, None), (31, " - "), (32, "zz yy xx")]
    docs = [(i, text(rng.randrange(60)) + " " + rng.choice(items)[1], "en") if i % 3 else (i, text(40), "en") for i in range(60) if i % 60 not in (5,)] if all(t for _, t in items) else [(i, f"{text(rng.randrange(60))} {rng.choice(items)[1] or ''}", "en") for i in range(60)]
    docs += [(None, None, None), (70, "", None), (71, items[0][1], "en"), (71, items[0][1], "en"), (72, "zz yy xx " * 50, "en")]
    found = decontamination.hits(awkward(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    got = found.select("doc_id", "n_words", decontamination.words_hit(F.col("spans")), "items").collect()
    assert Counter((r[0], r[1], r[2], tuple(r[3])) for r in got) == plain_hits(docs, items)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.hits(awkward(spark), none).where("size(items) > 0").count() == 0
    assert decontamination.hits(awkward(spark, []), none).count() == 0




def test_one_of_each_group_keeps_clashing_names(spark):
    """Columns that are named as those that operators make inside are kept as they are."""
    docs = spark.createDataFrame([(1, "a b c d e f", "x", 1, "y"), (2, "a b c d e f", "x", 1, "y"), (3, "other text", "z", 2, "w")], "doc_id bigint, text string, __row string, __kept int, __kept_row string")
    kept = simhash.keep_one(docs, simhash.near_copies(docs, shingle=5, similarity=0.8))
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [tuple(r) for r in docs.collect() if r["doc_id"] != 2]
