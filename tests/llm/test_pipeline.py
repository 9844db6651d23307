"""The pipeline on a small corpus with planted junk, copies and benchmark passages, stage by stage against a plain version."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_dedup import plain_hits, roots, shingles
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import queries


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(30)) for i in range(6)]
    docs, labels = [], []
    for i in range(500):
        docs.append((i, text(rng.randrange(60, 200)), "en", "big" if i % 3 else f"s{i % 5}"))
        labels.append((i, 1, int(i % 10 == 0)))
    junk = set()
    for i in range(500, 700):
        words = text(80).split()
        docs.append((i, " ".join(w.upper() + "!!" if i % 3 else w + "***" for w in words), "en", "big"))
        labels.append((i, 0, 0))
        junk.add(i)
    copies = {}
    for i in range(700, 740):
        of = rng.randrange(500)
        words = docs[of][1].split()
        if i % 2:
            words[len(words) // 2] = "edited"
        docs.append((i, " ".join(words), "en", "big"))
        copies[i] = of
    leaks = set()
    for i in range(740, 770):
        words = text(80).split()
        words[20:20] = rng.choice(items)[1].split()[5:20]
        docs.append((i, " ".join(words), "en", "big"))
        leaks.add(i)
    rng.shuffle(docs)
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, lang, source, len(t)) for i, t, lang, source in docs] + [(900, None, None, None, None), (901, "", "en", "big", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items, junk, copies, leaks


def test_stages_against_plain_versions(spark, corpus, tmp_path):
    folder, items, junk, copies, leaks = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, [{r.doc_id: r for r in docs.collect()}]
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        frames.append(docs.collect())
        if name != "token_files":
            assert docs.columns == columns
    clean, unique, safe, mixed, ids = frames

    kept = {r.doc_id for r in clean}
    assert not kept & junk and kept >= set(range(500)) | leaks | set(copies)

    near = {r.doc_id: set(shingles(r.text, 5)) for r in clean}
    pairs = [(a, b) for a in near for b in near if a < b and (near[a] == near[b] or near[a] and len(near[a] & near[b]) >= 0.8 * len(near[a] | near[b]))]
    assert {r.doc_id for r in unique} == {i for i, root in roots(pairs, near).items() if i == root}

    dirty = {i for i, _, n, _ in plain_hits([(r.doc_id, r.text) for r in unique], items) if n}
    assert dirty >= leaks and {r.doc_id for r in safe} == {r.doc_id for r in unique} - dirty

    words = lambda t: len((t or "").split())
    tokens, spent = Counter(), Counter()
    for r in safe:
        tokens[r.source] += words(r.text)
    for r in mixed:
        spent[r.source] += words(r.text)
    times = Counter(r.doc_id for r in mixed)
    assert set(times) == {r.doc_id for r in safe} and max(times.values()) == 2
    rates = {s: spent[s] / n for s, n in tokens.items() if n}
    assert min(rates.values()) == pytest.approx(1, abs=0.02) and max(rates.values()) == pytest.approx(corpus_pipeline.MAX_REPEAT, abs=0.1)

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.ENCODER))
    want = Counter()
    for r in mixed:
        a = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want[r.doc_id, len(a), zlib.crc32(a.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in ids) == want
    assert sum(r.n_tokens for r in ids) == max(r.start + r.n_tokens for r in ids)


def test_run_gives_the_last_stage(spark, corpus):
    got = corpus_pipeline.run(spark, corpus[0])
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 500


@pytest.mark.parametrize("name", ["op1_mixing", "op2_simhash", "op3_toxicity", "op4_token_files", "op5_decontaminate", "op7_suffix_dedup", "op8_language", "op9_quality", "op10_line_dedup"])
def test_queries_cover_every_document(spark, corpus, name):
    got = queries.queries()[name](spark, corpus[0])
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in spark.read.parquet(f"{corpus[0]}/documents.parquet").select("doc_id").collect())
