"""Near copies at the edge of the similarity and in crowded blocks, against brute force; rows that share an id or have none."""

import random
from itertools import combinations

import corpus_pipeline
import pytest
from test_dedup import roots, shingles
from tidemark.llm import simhash

SCHEMA = "doc_id bigint, text string"


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def edited(rng, text, places):
    out = list(text)
    for at in places:
        out[at] = words(rng, 1)[0]
    return out


def brute_force(docs):
    sets = {i: set(shingles(t, 5)) for i, t in docs}
    pairs = [(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return roots(pairs, sets)


def components(spark, docs):
    return {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(docs, SCHEMA)).collect()}


@pytest.mark.parametrize(("joined", "shingles"), [(1000, 500_000), (4, 500_000), (4, 3000)])
def test_crowded_blocks_keep_every_link(spark, monkeypatch, joined, shingles):
    """All blocks joined, all but the smallest in chunks, and chunks cut by their shingles."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    monkeypatch.setattr(simhash, "CHUNK_SHINGLES", shingles)
    monkeypatch.setattr(simhash, "JOIN_UP_TO", joined)
    rng = random.Random(5)
    docs = []
    for group in range(4):
        base = words(rng, 200)
        hub = rng.randrange(90)
        for i in range(90):
            # single edits ten words apart, at places of its own: each variant is near 0.8 to the hub, far less to the others
            places = [] if i == hub else [5 * k + rng.randrange(5) + 2 for k in rng.sample(range(38), 4)]
            docs.append((1000 * group + i, " ".join(edited(rng, base, places))))
    want = brute_force(docs)
    assert max(list(want.values()).count(r) for r in want.values()) > 60
    assert components(spark, docs) == want


def test_pairs_around_the_similarity(spark):
    rng = random.Random(6)
    docs = []
    for i in range(300):
        base = words(rng, 204)
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited(rng, base, range(100, 100 + 8 + i % 60))))]
    want = brute_force(docs)
    assert 20 < sum(want[2 * i + 1] == 2 * i for i in range(300)) < 280
    assert components(spark, docs) == want


def test_rows_without_an_id_or_with_one_id_and_other_texts(spark):
    rng = random.Random(7)
    one, two, three, four = (" ".join(words(rng, 60)) for _ in range(4))
    rows = [(None, one), (None, two), (1, three), (1, four), (0, four), (2, three), (2, three), (None, three), (None, two)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(None, one), (None, two), (1, three), (0, four)], key=repr)


def test_benchmark_rows_without_an_id_or_with_one_id(spark, tmp_path):
    rng = random.Random(8)
    item, clean, other = (" ".join(words(rng, 40)) for _ in range(3))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item), (None, clean), (1, f"{other} {item}"), (1, other), (2, None)]
    kept = corpus_pipeline.drop_benchmark(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert kept.columns == ["doc_id", "text"] and sorted(map(tuple, kept.collect()), key=repr) == sorted([(None, clean), (1, other), (2, None)], key=repr)
